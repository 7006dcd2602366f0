"""Session helpers: a local session for tests and the bench, and shared paths.

Library code never picks a machine-local folder on its own. Files that must
outlive one call (written results that a lazy DataFrame reads later) go under
the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.
Where it is not set they raise; ``local_session`` sets it for tests and the bench.
``remove_scratch`` deletes what this application left there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes the word-count shuffle at run time; see README
# "Plan shape and scale" for the settings recommended on a cluster. The
# two-level codegen map cannot hold a string-keyed count anyway ("fast
# hashmap does not support this aggregate"); turning it off made the word
# count 10-13 % faster on 40 M tokens (4.63 s against 5.31 s median).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Session settings for a large word count, to pass to ``SparkSession.builder``.

    * adaptive execution, with the first shuffle cut into 200 to 4,000
      partitions, not more with more cores: the partial counts are bounded by the
      vocabulary, and every partition costs each map task a shuffle block; they
      are then coalesced to about 128 MB
      (``parallelismFirst`` off, so the advisory size is honoured and the
      sink writes ~128 MB files, not many small ones): the partial-aggregate
      output is roughly one row per distinct word per map task, so its size
      is only known at run time;
    * 1 GB input splits: larger map tasks combine more tokens per word
      before the shuffle, and there are fewer of them (a Parquet row group stays the unit of a split);
    * zstd for shuffle blocks: on ten copies of the sf0.1 documents it wrote
      29 MB instead of lz4's 52 MB for the partial-aggregate output (words
      compress well), which is what crosses the network at scale.
    """
    return {
        **SCALE_CONF,
        "spark.io.compression.codec": "zstd",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(min(4000, max(200, 4 * total_cores))),
        "spark.sql.shuffle.partitions": str(min(4000, max(200, 4 * total_cores))),
        "spark.sql.files.maxPartitionBytes": "1g",
    }


def local_session(cores: int | str = "*", app: str = "tokentally", **conf: str) -> SparkSession:
    """A ``local[cores]`` session with the UI off, for tests and the bench."""
    n = cores if cores != "*" else None
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n or 8))
    )
    if "spark.checkpoint.dir" not in conf:
        conf = {**conf, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tokentally-ckpt-")}
    for key, value in {**SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Raises when the setting is missing: a folder of the driver's machine is not
    visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path ``<shared_dir>/tokentally/<application>/<uuid>/<name>``."""
    return f"{_scratch(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tokentally/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch files, through the file system that holds them.

    Results that still read them fail afterwards: call it at the end of a run.
    """
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
