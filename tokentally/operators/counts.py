"""Counting operators: pair projection (P1), keyed sum (A1) and word count (A2).

Aggregations are plain ``groupBy().agg()``: Spark plans a partial
(map-side) hash aggregate, a hash exchange on the key and a final
aggregate. The partial step is what keeps hot words cheap -- a word
holding a third of all tokens still ships at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.operators.tokens import explode_tokens
from tokentally.sources.text import split_lines


def word_pairs(df: DataFrame, col: str = "word") -> DataFrame:
    """``(word, 1)`` for every token: ``[word string, n int]``."""
    return df.select(F.col(col).alias("word"), F.lit(1).cast("int").alias("n"))


def keyed_sum(
    df: DataFrame,
    keys: str | Sequence[str] = "word",
    value: str = "n",
    out: str = "cnt",
) -> DataFrame:
    """Sum ``value`` per key: ``[keys..., out bigint]``.

    Spark sums integer columns as bigint, so counts above 2,147,483,647 do
    not wrap (the 32-bit sum of the original job would); other numeric types
    keep their own sum type.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def count_by(df: DataFrame, key: str, out: str = "cnt") -> DataFrame:
    """Rows per distinct ``key``: ``[key, out bigint]`` (exact, case-sensitive keys)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Count every single-space token of every line: ``[word, cnt bigint]``.

    Keys are exact and case-sensitive; the empty word is a key like any
    other. Output order is undefined.
    """
    return count_by(explode_tokens(lines, col, with_position=False), "word")


def count_text_words(df: DataFrame, col: str = "text") -> DataFrame:
    """Word count of a text column: its lines (S1b), then ``word_count``."""
    return word_count(split_lines(df, col, with_position=False), "line")
