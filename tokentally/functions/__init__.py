"""Built-in column expressions for lines, tokens and ``(word,count)`` text."""

from tokentally.functions.text import (
    LINE_BREAK,
    NON_ALNUM,
    SPACE,
    alnum_pieces,
    empty_strings,
    lines_of,
    pair_count,
    pair_text,
    pair_word,
    tokenize,
)

__all__ = [
    "LINE_BREAK",
    "NON_ALNUM",
    "SPACE",
    "alnum_pieces",
    "empty_strings",
    "lines_of",
    "pair_count",
    "pair_text",
    "pair_word",
    "tokenize",
]
