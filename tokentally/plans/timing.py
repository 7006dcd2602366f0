"""Timed word count job (M1): count, write, report the elapsed time."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tokentally.functions.text import ELAPSED_LABEL
from tokentally.operators.counts import word_count
from tokentally.sinks.text import write_counts

log = logging.getLogger(__name__)


def timed_word_count(
    spark: SparkSession, lines: DataFrame, path: str, col: str = "value"
) -> DataFrame:
    """Run the word count job on ``lines``, write it to ``path`` and time it.

    The clock covers planning plus the one write action, not session start.
    Returns one row ``[elapsed_ms bigint, rows bigint]``; ``rows`` is observed
    by the write itself; the output is not read again.
    """
    seen = Observation("written")
    start = time.monotonic()
    write_counts(word_count(lines, col).observe(seen, F.count(F.lit(1)).alias("rows")), path)
    elapsed_ms = int((time.monotonic() - start) * 1000)
    log.info("%s%d", ELAPSED_LABEL, elapsed_ms)
    return spark.createDataFrame([(elapsed_ms, seen.get["rows"])], "elapsed_ms bigint, rows bigint")
