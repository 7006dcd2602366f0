"""Bench: run the catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full into Spark's ``noop`` sink (every
row is computed, nothing is collected to the driver). One warm-up pass over
all queries, then $BENCH_RUNS interleaved rounds; the median per query. Prints one JSON line;
``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tokentally.plans.catalog import QUERIES  # noqa: E402
from tokentally.session import local_session, remove_scratch  # noqa: E402

# Every registered catalog query: the word count job and every operator around it.
HEADLINE = list(QUERIES)


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, app="tokentally-bench", **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    errors: dict[str, str] = {}
    for name in HEADLINE:  # warm-up: class loading, JIT, file listing caches
        try:
            run_once(spark, name, sf_dir)
        except Exception as exc:  # report the failure, keep benching the rest
            errors[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
    timed = [name for name in HEADLINE if name not in errors]
    samples: dict[str, list[float]] = {name: [] for name in timed}
    for _ in range(runs):  # interleaved rounds, so drift hits every query alike
        for name in timed:
            samples[name].append(run_once(spark, name, sf_dir))
    throughput = {}
    if "word_count_documents" in samples:  # tokens counted once, outside the timing
        tokens = QUERIES["word_count_documents"](spark, sf_dir).agg(F.sum("cnt")).collect()[0][0]
        seconds = statistics.median(samples["word_count_documents"])
        throughput = {"flagship_tokens": tokens, "flagship_tokens_per_sec": round(tokens / seconds)}
    remove_scratch(spark)
    spark.stop()
    times: dict[str, float | None] = {name: None for name in HEADLINE}
    times.update({name: round(statistics.median(ts), 3) for name, ts in samples.items()})
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "catalog_total_median",
                "value": round(sum(t for t in times.values() if t is not None), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
                **throughput,
                **({"errors": errors} if errors else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
