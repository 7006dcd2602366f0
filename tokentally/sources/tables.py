"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *cols: str, spread: int | None = None) -> DataFrame:
    """Read a Parquet table with only ``cols`` (pruned at the scan; one that is missing raises).

    ``spread=N`` deals the rows round-robin over N tasks first. That shuffles every
    row read, so it pays only for a table of a few huge row groups (a row group is never
    split); no size is looked at, the caller decides.
    """
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    return df.repartition(spread) if spread else df
