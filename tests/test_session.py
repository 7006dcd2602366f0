"""Shared paths live under the session's checkpoint folder."""

from __future__ import annotations

from tokentally.session import fresh_path, shared_dir


def test_fresh_path_is_new_and_under_checkpoint_dir(spark):
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = fresh_path(spark, "result"), fresh_path(spark, "result")
    assert a != b
    assert a.startswith(base.rstrip("/") + "/tokentally/") and a.endswith("/result")


def test_cluster_conf_scales_with_cores():
    from tokentally.session import cluster_conf

    small, big = cluster_conf(8), cluster_conf(8000)
    assert small["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "4000"
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.io.compression.codec"] == "zstd"
    assert big["spark.sql.codegen.aggregate.map.twolevel.enabled"] == "false"


def test_word_count_under_cluster_conf(tmp_path):
    """Core settings (the shuffle codec) only apply to a new context: run in a subprocess."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import functions as F\n"
        "from tokentally.session import local_session, cluster_conf\n"
        "from tokentally.plans.catalog import QUERIES\n"
        "spark = local_session(4, **cluster_conf(4))\n"
        "assert spark.sparkContext.getConf().get('spark.io.compression.codec') == 'zstd'\n"
        "df = QUERIES['word_count_documents'](spark, '/root/testdata/sf0.01')\n"
        "row = df.agg(F.count(F.lit(1)).alias('n'), F.sum('cnt').alias('t')).collect()[0]\n"
        "print('TOTALS', row.n, row.t)\n"
    )
    proc = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    assert "TOTALS 93796 390171" in proc.stdout
