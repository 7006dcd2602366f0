"""One query for each operator: whole tables, production parameters, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentally.llm.bitplane import token_file
from tokentally.llm.bytebpe import round_trip
from tokentally.llm.bytecnn import score_quality
from tokentally.llm.chatlog import digest, format_chats, table_events
from tokentally.llm.common import table
from tokentally.llm.crosspolytope import embedding_duplicates
from tokentally.llm.filteraudit import audit_filters
from tokentally.llm.licenses import scan_licenses
from tokentally.llm.linefreq import line_quality
from tokentally.llm.maxsketch import ranked_search
from tokentally.llm.minhash import near_duplicates
from tokentally.llm.packing import pack_documents
from tokentally.llm.pii import find_personal_data
from tokentally.llm.secret_scan import scan_secrets
from tokentally.session import fresh_path

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def q_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


def q_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    digest = F.sha2(F.col("value"), 256).alias("value_sha256")
    return found.select("doc_id", "start", F.length("value").alias("length"), digest, "score", "secret")


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def q_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file(documents(spark, sf_dir), fresh_path(spark, "token_file"), WORD_BPE)


def q_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir)).drop("host", "content")


def q_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), WORD_BPE)


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle_words=2)


def q_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def q_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("bigint"), "id", role, F.lit("\\### Assistant: </turn> ok"))
    return digest(format_chats(table_events(turns.union(more))))


def q_personal_data_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op1_personal_data`` that SQL can state."""
    return q_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def q_licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op5_licenses`` that SQL can state."""
    return q_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": q_personal_data,
    "op2_embedding_duplicates": q_embedding_duplicates,
    "op3_secrets": q_secrets,
    "op4_byte_bpe": q_byte_bpe,
    "op5_licenses": q_licenses,
    "op6_quality_cnn": q_quality_cnn,
    "op7_token_file": q_token_file,
    "op8_line_quality": q_line_quality,
    "op9_pack_documents": q_pack_documents,
    "op10_near_duplicates": q_near_duplicates,
    "op11_filter_audit": q_filter_audit,
    "op12_ranked_search": q_ranked_search,
    "op13_chat_format": q_chat_format,
    "personal_data_base": q_personal_data_base,
    "licenses_base": q_licenses_base,
}
