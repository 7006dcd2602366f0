"""Tokenising operators: single-space tokens (T1/T2) and alphanumeric tokens (R2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.functions.text import alnum_pieces, tokenize


def explode_tokens(
    df: DataFrame,
    col: str = "line",
    keys: Sequence[str] = (),
    *,
    with_position: bool = True,
) -> DataFrame:
    """One row per token of each line: ``[keys..., pos bigint, word string]``.

    A line with no tokens (only spaces) adds no row -- ``explode``, never
    ``explode_outer`` -- while the empty line adds one empty word. ``pos`` is
    0-based; ``with_position=False`` leaves it out.
    """
    key_cols = [F.col(k) for k in keys]
    if not with_position:
        return df.select(*key_cols, F.explode(tokenize(col)).alias("word"))
    exploded = df.select(*key_cols, F.posexplode(tokenize(col)).alias("pos", "word"))
    return exploded.select(*keys, F.col("pos").cast("bigint").alias("pos"), "word")


def alnum_tokens(df: DataFrame, col: str = "line", keys: Sequence[str] = ()) -> DataFrame:
    """Runs of ASCII letters and digits, one row each: ``[keys..., token]``.

    Every other character (punctuation, space, accented letters) separates
    tokens, runs count once, and empty pieces are dropped.
    """
    pieces = df.select(*[F.col(k) for k in keys], F.explode(alnum_pieces(col)).alias("token"))
    return pieces.where(F.col("token") != "")
