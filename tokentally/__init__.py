"""tokentally: word counting over large text collections, on Spark DataFrames.

Read text files or text columns as lines, split lines into tokens under
exact rules, count tokens with a partial and a final aggregate, write the
counts as ``(word,count)`` text and read them back. Everything is built-in
Spark expressions: no Python runs per row.
"""

from tokentally.functions import lines_of, tokenize
from tokentally.operators import (
    alnum_tokens,
    any_match,
    count_by,
    count_text_words,
    explode_tokens,
    filter_lines,
    filter_tokens,
    keyed_sum,
    texts_holding,
    word_count,
    word_pairs,
)
from tokentally.plans.timing import timed_word_count
from tokentally.sinks import format_pairs, write_counts
from tokentally.sources import (
    read_counts,
    read_lines,
    read_table,
    result_manifest,
    split_lines,
)

__all__ = [
    "alnum_tokens",
    "any_match",
    "count_by",
    "count_text_words",
    "explode_tokens",
    "filter_lines",
    "filter_tokens",
    "format_pairs",
    "keyed_sum",
    "lines_of",
    "read_counts",
    "read_lines",
    "read_table",
    "result_manifest",
    "split_lines",
    "texts_holding",
    "timed_word_count",
    "tokenize",
    "word_count",
    "word_pairs",
    "write_counts",
]
