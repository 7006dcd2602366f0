"""Literal filters and the existence check (R1, R3, R4).

Needles are matched as literal substrings, case-sensitively, with the
built-in ``contains`` -- never as a regular expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def texts_holding(df: DataFrame, needle: str, col: str = "text") -> DataFrame:
    """Keep the texts that hold ``needle``: a pre-filter before line splitting.

    A needle with no line break lies inside some line of a text exactly when
    it lies inside the text, so ``filter_lines(split_lines(texts_holding(df,
    n)), n)`` equals ``filter_lines(split_lines(df), n)`` while only matching
    texts are split; the predicate also reaches the Parquet reader. A needle
    holding a line break can match no line: every text is dropped.
    """
    if "\n" in needle or "\r" in needle:
        return df.where(F.lit(False))
    return df.where(F.col(col).contains(F.lit(needle)))


def filter_lines(df: DataFrame, needle: str, col: str = "line") -> DataFrame:
    """Keep the rows whose ``col`` holds ``needle`` (like ``grep needle``)."""
    return df.where(F.col(col).contains(F.lit(needle)))


def filter_tokens(df: DataFrame, needle: str, col: str = "token") -> DataFrame:
    """Keep the tokens that hold ``needle`` anywhere inside them."""
    return df.where(F.col(col).contains(F.lit(needle)))


def any_match(df: DataFrame, needle: str, col: str = "token") -> DataFrame:
    """One row ``[matched boolean]``: does any ``col`` hold ``needle``?

    Each task stops at its first hit (a limit below the one-row aggregate);
    false, not null, on empty input.
    """
    hit = df.where(F.col(col).contains(F.lit(needle))).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("matched"))
