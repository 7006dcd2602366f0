"""Literal filters and the existence check (R1, R3, R4), and the text pre-filter."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from tokentally.operators.filters import any_match, filter_lines, filter_tokens, texts_holding
from tokentally.operators.tokens import alnum_tokens
from tokentally.sources.text import split_lines


def test_filter_lines_is_literal_and_case_sensitive(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), ("A.B",), ("xa.by",)], "line string")
    assert sorted(r.line for r in filter_lines(df, "a.b").collect()) == ["a.b", "xa.by"]


def test_filter_tokens_inside_token(spark):
    df = spark.createDataFrame([("Bound",), ("Unbounded",), ("Bounded",), ("bound",)], "token string")
    assert sorted(r.token for r in filter_tokens(df, "Bound").collect()) == ["Bound", "Bounded"]


def test_launcher_pipeline(spark):
    # grep 'data-claim' | tr -cs '[:alnum:]' '\n' | grep 'Bound', then a search for 'Bound'.
    status = spark.createDataFrame(
        [("data-claim   Bound    vol0   1Gi   RWO   standard   5m",), ("other  Pending",)], "line string"
    )
    tokens = alnum_tokens(filter_lines(status, "data-claim"), "line")
    assert sorted(r.token for r in filter_tokens(tokens, "Bound").collect()) == ["Bound"]
    assert any_match(tokens, "Bound").collect()[0].matched is True
    assert any_match(tokens, "Lost").collect()[0].matched is False


def test_any_match_empty_is_false(spark):
    empty = spark.createDataFrame([], "token string")
    out = any_match(empty, "x")
    assert out.schema.simpleString() == "struct<matched:boolean>"
    assert out.collect()[0].matched is False


TEXT = st.text(alphabet=["a", "b", " ", "\n", "\r"], max_size=16)


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=30), st.sampled_from(["a", "ab", "b a", " ", "a\nb"]))
def test_prefilter_keeps_result(spark, texts, needle):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plain = filter_lines(split_lines(df, "text", ["doc_id"]), needle)
    pre = filter_lines(split_lines(texts_holding(df, needle), "text", ["doc_id"]), needle)
    assert sorted(plain.collect()) == sorted(pre.collect())
