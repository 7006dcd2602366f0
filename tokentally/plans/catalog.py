"""The query catalog: each operator run over whole driver tables.

Every query is a callable ``(spark, sf_dir) -> DataFrame`` that reads
``{sf_dir}/{table}.parquet`` with only the columns it needs (the scan's
``ReadSchema`` shows the pruning). Queries that write text first
(``text_scan``, ``sink_roundtrip``, ``result_manifest``,
``timed_word_count``) write under the shared checkpoint folder so the
returned lazy DataFrame can still read the files later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentally.operators.counts import count_by, count_text_words, keyed_sum, word_count, word_pairs
from tokentally.operators.filters import any_match, filter_lines, filter_tokens, texts_holding
from tokentally.operators.tokens import alnum_tokens, explode_tokens
from tokentally.plans.timing import timed_word_count
from tokentally.session import fresh_path
from tokentally.sinks.text import format_pairs, write_counts
from tokentally.sources.results import read_counts, result_manifest
from tokentally.sources.tables import read_table
from tokentally.sources.text import read_lines, split_lines

# Fixed value: the literal the line and token filters look for in the tables.
NEEDLE = "icense"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return read_table(spark, path, *cols)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_lines(documents(spark, sf_dir), "text", ["doc_id"])


def q_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(spark, sf_dir)


def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_tokens(document_lines(spark, sf_dir), "line", ["doc_id", "line_no"])


def _words(df: DataFrame, col: str) -> DataFrame:
    lines = split_lines(df, col, with_position=False)
    return explode_tokens(lines, "line", with_position=False)


def q_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pairs(_words(table(spark, sf_dir, "conversations", "text"), "text"))


def q_keyed_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = word_pairs(_words(table(spark, sf_dir, "documents", "text"), "text"))
    return keyed_sum(pairs, "word", "n", "cnt")


def _count_column(name: str, col: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return count_text_words(table(spark, sf_dir, name, col), col)

    query.__name__ = f"q_word_count_{name}"
    return query


q_word_count_documents = _count_column("documents", "text")
q_word_count_pages = _count_column("pages", "html")
q_word_count_parts = _count_column("part", "p_name")
q_word_count_conversations = _count_column("conversations", "text")
q_word_count_benchmark = _count_column("benchmark", "text")


def q_format_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(q_word_count_documents(spark, sf_dir))


def q_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines written as text files, then read back as files (S1).

    As for any text file, a byte-order mark (U+FEFF) that happens to start a
    written part file is dropped by the line reader; the driver tables hold
    no U+FEFF, so the counts equal the documents word count.
    """
    path = fresh_path(spark, "lines")
    lines = split_lines(table(spark, sf_dir, "documents", "text"), "text", with_position=False)
    lines.write.mode("errorifexists").text(path)
    return word_count(read_lines(spark, path), "value")


def q_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "result")
    write_counts(q_word_count_documents(spark, sf_dir), path)
    return read_counts(spark, path)


def q_result_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "result")
    write_counts(q_word_count_documents(spark, sf_dir), path)
    return result_manifest(spark, path)


def q_timed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = split_lines(table(spark, sf_dir, "documents", "text"), "text", with_position=False)
    return timed_word_count(spark, lines, fresh_path(spark, "result"), "line")


def q_result_manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic part of the manifest: rows and bytes over all result files."""
    manifest = q_result_manifest(spark, sf_dir)
    return manifest.agg(F.sum("rows").alias("rows"), F.sum("file_size").alias("file_size"))


def q_timed_word_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic part of the timed job: the rows it wrote."""
    return q_timed_word_count(spark, sf_dir).select("rows")


def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = texts_holding(documents(spark, sf_dir), NEEDLE, "text")
    return filter_lines(split_lines(texts, "text", ["doc_id"]), NEEDLE, "line")


def _license_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alnum_tokens(license_lines(spark, sf_dir).select("line"), "line")


def q_filter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_lines(spark, sf_dir)


def q_alnum_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_license_tokens(spark, sf_dir), "token")


def q_filter_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(filter_tokens(_license_tokens(spark, sf_dir), NEEDLE, "token"), "token")


def q_any_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return any_match(_license_tokens(spark, sf_dir), NEEDLE, "token")


QUERIES: dict[str, Query] = {
    "split_lines": q_split_lines,
    "tokenize": q_tokenize,
    "word_pairs": q_word_pairs,
    "keyed_sum": q_keyed_sum,
    "word_count_documents": q_word_count_documents,
    "word_count_pages": q_word_count_pages,
    "word_count_parts": q_word_count_parts,
    "word_count_conversations": q_word_count_conversations,
    "word_count_benchmark": q_word_count_benchmark,
    "format_pairs": q_format_pairs,
    "text_scan": q_text_scan,
    "sink_roundtrip": q_sink_roundtrip,
    "filter_lines": q_filter_lines,
    "alnum_tokens": q_alnum_tokens,
    "filter_tokens": q_filter_tokens,
    "any_match": q_any_match,
    "result_manifest_rows": q_result_manifest_rows,
    "timed_word_count_rows": q_timed_word_count_rows,
}
