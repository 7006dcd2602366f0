"""Command-line word count job.

    spark-submit --py-files tokentally.zip tokentally/__main__.py INPUT [OUTPUT]
    python -m tokentally INPUT [OUTPUT]

Reads the lines of INPUT (files, folders, globs, or a comma-separated list),
counts every single-space token, writes ``(word,count)`` lines to OUTPUT
(which must not exist; by default a new folder under ``spark.checkpoint.dir``)
and prints the elapsed time of the job in milliseconds.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from tokentally.functions.text import ELAPSED_LABEL
from tokentally.operators.counts import word_count
from tokentally.session import fresh_path
from tokentally.sinks.text import write_counts
from tokentally.sources.text import read_lines


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="tokentally", description=__doc__.split("\n\n")[0])
    parser.add_argument("input", help="text files, folders or globs; commas separate several")
    parser.add_argument("output", nargs="?", help="result folder (must not exist)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tokentally").getOrCreate()
    output = args.output or fresh_path(spark, "result")
    start = time.monotonic()
    write_counts(word_count(read_lines(spark, args.input)), output)
    elapsed_ms = int((time.monotonic() - start) * 1000)
    print(f"{ELAPSED_LABEL}{elapsed_ms}")
    print(f"result: {output}")
    return output


if __name__ == "__main__":
    main()
