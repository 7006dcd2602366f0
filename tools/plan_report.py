"""Summarise the physical plan of every catalog query.

Usage: python tools/plan_report.py [sf_dir]
Prints a Markdown table: exchanges (kind and key), pushed filters, read
schema, and whether any Python evaluation node appears.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

from tokentally.plans.catalog import QUERIES  # noqa: E402
from tokentally.session import local_session  # noqa: E402


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| Query | Exchanges | Pushed filters | Read schema | Python |")
    print("| --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        plan = explain(fn(spark, sf_dir))
        exchanges = re.findall(r"Arguments: (hashpartitioning\([^,]+|RoundRobinPartitioning\(\d+\)|SinglePartition)", plan)
        exchanges = [
            f"hash({e.split('(', 1)[1].split('#')[0]})" if e.startswith("hash") else e for e in exchanges
        ]
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
        schema = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        python = "yes" if "EvalPython" in plan or "PythonUDF" in plan else "no"
        print(f"| `{name}` | {', '.join(exchanges) or 'none'} | {'; '.join(pushed) or '—'} | "
              f"{', '.join(f'`{s}`' for s in schema)} | {python} |")
    spark.stop()


if __name__ == "__main__":
    main()
