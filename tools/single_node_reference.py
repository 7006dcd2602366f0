"""Time catalog queries on Spark and, as a single-node reference, their oracle
SQL on DuckDB, interleaved on the same machine and data.

Usage: python tools/single_node_reference.py [sf_dir] [query ...]
Spark runs each query into the ``noop`` sink; DuckDB counts the rows of the
oracle SQL. Prints the median of 5 runs (after one warm-up) per engine.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, ".")

from tokentally.plans.catalog import QUERIES  # noqa: E402
from tokentally.plans.oracle import ORACLE_SQL  # noqa: E402
from tokentally.session import local_session  # noqa: E402

TABLES = ["documents", "conversations", "pages", "part", "benchmark"]
DEFAULT = ["word_count_documents", "tokenize", "word_count_pages", "word_count_conversations"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET threads=8")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):  # a folder of part files, as Spark writes a table
            path = f"{path}/*.parquet"
        elif not os.path.exists(path):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")

    def run_spark(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def run_duck(name: str) -> float:
        start = time.perf_counter()
        con.execute(f"SELECT count(*) FROM ({ORACLE_SQL[name]})").fetchall()
        return time.perf_counter() - start

    print(f"{'query':28s} {'spark_s':>8s} {'duckdb_s':>9s}")
    for name in names:
        run_spark(name), run_duck(name)
        s, d = [], []
        for _ in range(5):
            s.append(run_spark(name))
            d.append(run_duck(name))
        print(f"{name:28s} {statistics.median(s):8.3f} {statistics.median(d):9.3f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
