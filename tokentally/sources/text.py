"""Text sources: lines of text files (S1) and lines of a text column (S1b)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentally.functions.text import lines_of


def _path_list(paths: str | Sequence[str]) -> list[str]:
    if not isinstance(paths, str):
        return list(paths)
    # A comma-joined string is a list of paths, as for SparkContext.textFile;
    # a comma inside braces, which may be nested, belongs to the glob.
    found, depth = [""], 0
    for c in paths:
        depth = max(0, depth + (c == "{") - (c == "}"))
        if c == "," and not depth:
            found.append("")
        else:
            found[-1] += c
    return [p for p in found if p]


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], *, spread: int | None = None
) -> DataFrame:
    """One row per line of the files, directories or globs: ``[value string]``.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; a UTF-8 byte-order mark at the
    start of a file is dropped by the line reader. Malformed UTF-8 is decoded
    to U+FFFD, so bad spellings of one word become one key; an encoded surrogate
    gives three of them, where a JVM decoder gives one. Folders are read with all
    folders inside them, and a folder named ``key=value`` is no partition column (the
    text source of the RDD API fails on nested folders). Lines come in file
    order. Plain text files are split by size; a compressed file (gzip) is one
    split: ``spread=N`` deals the lines over N tasks (order is then lost), a shuffle
    of all of them. A missing path is an error.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(_path_list(paths))
    if spread:
        raw = raw.repartition(spread)
    return raw.select(F.make_valid_utf8("value").alias("value"))


def split_lines(
    df: DataFrame,
    col: str = "text",
    keys: Sequence[str] = (),
    *,
    with_position: bool = True,
) -> DataFrame:
    """Lines of a text column: ``[keys..., line_no bigint, line string]``.

    The line rule is the one ``read_lines`` applies to files, but a byte-order mark
    in a column is kept as text. ``line_no`` is
    0-based; with ``with_position=False`` it is left out (cheaper when only
    the lines matter). Null or empty texts give no rows.
    """
    key_cols: list[Column] = [F.col(k) for k in keys]
    if not with_position:
        return df.select(*key_cols, F.explode(lines_of(col)).alias("line"))
    exploded = df.select(*key_cols, F.posexplode(lines_of(col)).alias("line_no", "line"))
    return exploded.select(*keys, F.col("line_no").cast("bigint").alias("line_no"), "line")
