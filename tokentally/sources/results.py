"""Reading a written word count back: the counts (S2) and a per-file manifest (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentally.functions.text import pair_count, pair_word


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Parse every ``(word,count)`` line of a result folder: ``[word, cnt bigint]``.

    The whole folder is read (all part files, however many the job wrote).
    The word is taken as is -- it is not tokenised again -- and may hold
    commas or parentheses. Folders inside are read too. A line that is not a
    pair fails every query that uses a column; a bare ``count()`` uses none and
    only counts lines.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(pair_word("value").alias("word"), pair_count("value").alias("cnt"))


def result_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-empty result file: ``[file_name, file_size, rows]``.

    Built from the file-source ``_metadata`` column, so the listing and the
    row count come from one distributed scan; hidden files such as
    ``_SUCCESS`` and empty part files have no rows and are not listed. Files of
    one name in different folders are different rows.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    files = lines.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    return files.agg(F.count(F.lit(1)).alias("rows")).drop("file_path")
