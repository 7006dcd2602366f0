"""Text sink: ``(word,count)`` lines (F1) written as text files (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokentally.functions.text import pair_text, writable


def format_pairs(df: DataFrame, word: str = "word", cnt: str = "cnt") -> DataFrame:
    """One ``(word,count)`` line per row: ``[value string]``."""
    return df.select(pair_text(word, cnt).alias("value"))


def write_counts(df: DataFrame, path: str, word: str = "word", cnt: str = "cnt") -> None:
    """Write the counts as ``(word,count)`` text lines under ``path``.

    Fails if ``path`` exists. One part file per partition of ``df`` plus
    ``_SUCCESS``, committed by the output committer, so a lost task is
    simply retried; consumers read the folder, not a single part file. A null word
    or one with a line break, which could not be read back, fails the job.
    """
    lines = df.select(pair_text(writable(word), cnt).alias("value"))
    lines.write.mode("errorifexists").text(path)
