"""Operators: tokenising, counting and filtering DataFrames."""

from tokentally.operators.counts import (
    count_by,
    count_text_words,
    keyed_sum,
    word_count,
    word_pairs,
)
from tokentally.operators.filters import any_match, filter_lines, filter_tokens, texts_holding
from tokentally.operators.tokens import alnum_tokens, explode_tokens

__all__ = [
    "alnum_tokens",
    "any_match",
    "count_by",
    "count_text_words",
    "explode_tokens",
    "filter_lines",
    "filter_tokens",
    "keyed_sum",
    "texts_holding",
    "word_count",
    "word_pairs",
]
