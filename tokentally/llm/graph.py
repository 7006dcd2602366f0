"""Connected components by contraction, with joins of written tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``[node, comp]`` for every node of ``edges [a, b]``; ``comp`` is one node of it.

    Each round hangs every node below its smallest neighbour (a partial
    aggregate), follows the parents to the roots by doubling, and keeps the edges
    between different roots. The graph shrinks round by round; with hashed node
    names the number of rounds is logarithmic. Every join reads written tables, so
    a node of very many edges is split by adaptive execution. Only row counts
    reach the driver. Self loops name a component; an empty table gives none.
    """
    edges = settle(edges.select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node")))
    labels = nodes.distinct().withColumn("comp", F.col("node"))
    while not edges.where("a <> b").isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select("v", "u")).where("u <> v")
        parents = settle(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")),
            "parents",
        )
        while True:
            up = parents.select(F.col("u").alias("p"), F.col("p").alias("q"))
            jumped = settle(
                parents.join(up, "p").select("u", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")),
                "jumped",
            )
            parents = jumped.select("u", "p")
            if jumped.where("moved").isEmpty():
                break
        root = parents.select(F.col("u").alias("comp"), F.col("p").alias("root"))
        labels = settle(
            labels.join(root, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "labels"
        )
        pa = parents.select(F.col("u").alias("a"), F.col("p").alias("ra"))
        pb = parents.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        edges = settle(
            edges.where("a <> b")
            .join(pa, "a")
            .join(pb, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "edges",
        )
    return labels
