"""A task that fails mid-way is retried and the result stays exact.

Runs in a subprocess: task retries need a ``local[n,maxFailures]`` master,
and one process holds one Spark context. A test-only Python UDF fails the
first attempt of one task after it has processed some rows -- once in the
tokenising stage and once in the stage that writes the text output -- and
drops a marker file so the test knows the failure really happened.
"""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import os, sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from tokentally.operators.counts import word_count
    from tokentally.session import local_session
    from tokentally.sinks.text import write_counts
    from tokentally.sources.results import read_counts
    from tokentally.sources.tables import read_table

    scratch = {scratch!r}
    spark = local_session("4,3", **{{"spark.sql.shuffle.partitions": "4"}})
    spark.sparkContext.setLogLevel("OFF")
    seen = {{}}

    def fail_once(tag):
        @F.udf("boolean")
        def keep(value):
            ctx = TaskContext.get()
            key = (ctx.stageId(), ctx.partitionId(), ctx.attemptNumber())
            seen[key] = seen.get(key, 0) + 1
            if ctx.partitionId() == 0 and ctx.attemptNumber() == 0 and seen[key] == 50:
                open(os.path.join(scratch, tag), "w").close()
                raise RuntimeError("injected task failure: " + tag)
            return True
        # Nondeterministic, so the optimizer keeps each filter where it is
        # written (a filter on the grouping key would move below the aggregate).
        return keep.asNondeterministic()

    docs = read_table(spark, "/root/testdata/sf0.01/documents.parquet", "text")
    lines = docs.select(F.explode(F.split("text", "\\n")).alias("value"))
    expected = {{r.word: r.cnt for r in word_count(lines).collect()}}

    disturbed = word_count(lines.where(fail_once("tokens")("value")))
    disturbed = disturbed.where(fail_once("write")("word"))
    out = os.path.join(scratch, "result")
    write_counts(disturbed, out)
    got = {{r.word: r.cnt for r in read_counts(spark, out).collect()}}
    assert got == expected, (len(got), len(expected))
    print("EXACT", len(got))
    """
)


def test_task_failure_is_retried_and_exact(tmp_path):
    script = SCRIPT.format(repo=REPO, scratch=str(tmp_path))
    proc = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=600
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    assert "EXACT" in proc.stdout
    assert (tmp_path / "tokens").exists() and (tmp_path / "write").exists()
