"""A corpus pipeline of five operators; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokentally.llm.bytecnn import keep_good
from tokentally.llm.catalog import WORD_BPE
from tokentally.llm.common import settle, table
from tokentally.llm.linefreq import clean_quality
from tokentally.llm.minhash import keep_one
from tokentally.llm.packing import pack_documents
from tokentally.llm.secret_scan import hide_secrets


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hide_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: A trained network, tokenization and packing are beyond SQL; the tests compare ``run`` with brute-force versions of
#: the other stages on the rows that the network keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to ``documents``; each stage's rows are written and read again.

    Documents with a null or empty text have no words, so the quality rules refuse them; a text that the
    classifier or the rules refuse is gone, of a group of near copies the smallest ``doc_id`` stays, rows that
    repeat an id and its text are one, and rows without an id are no copies of any. All other columns are
    carried along, whatever their names, and dropped by the last stage. Without labels the classifier keeps
    all rows. An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
