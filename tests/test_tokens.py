"""Line and token rules (S1b, T1, T2, R2): fixed edge cases and properties."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import explain_text, java_space_split, text_file_lines
from tokentally.functions.text import lines_of, tokenize
from tokentally.operators.tokens import alnum_tokens, explode_tokens
from tokentally.sources.text import split_lines

# Line -> tokens under Java's String.split(" ").
TOKEN_CASES = [
    ("", [""]),
    (" ", []),
    ("   ", []),
    (" a", ["", "a"]),
    ("a  b", ["a", "", "b"]),
    ("a b  ", ["a", "b"]),
    ("a\tb", ["a\tb"]),
    ("A a, a", ["A", "a,", "a"]),
    ("a\u00a0b\u3000c", ["a\u00a0b\u3000c"]),
    ("a \t", ["a", "\t"]),
]

# Text -> lines, as a text file of these bytes is split into rows.
LINE_CASES = [
    ("", []),
    ("a", ["a"]),
    ("a\n", ["a"]),
    ("a\r", ["a"]),
    ("a\n\n", ["a", ""]),
    ("a\r\n\n", ["a", ""]),
    ("\n", [""]),
    ("\r\n", [""]),
    ("\n\n", ["", ""]),
    ("\n\r", ["", ""]),
    ("a\r\nb\rc\nd", ["a", "b", "c", "d"]),
    ("a\n\rb", ["a", "", "b"]),
    (" \n", [" "]),
    ("a\u0085b c\x0bd\x0ce", ["a\u0085b c\x0bd\x0ce"]),
]


def test_token_cases(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(TOKEN_CASES)], "id bigint, line string")
    got = {r.id: list(r.t) for r in df.select("id", tokenize("line").alias("t")).collect()}
    for i, (line, want) in enumerate(TOKEN_CASES):
        assert got[i] == want, line
        assert java_space_split(line) == want, line


def test_tokenize_edge_rows(spark):
    lines = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(TOKEN_CASES[:8])], "id bigint, line string")
    rows = explode_tokens(lines, "line", ["id"])
    assert rows.schema.simpleString() == "struct<id:bigint,pos:bigint,word:string>"
    got = sorted((r.id, r.pos, r.word) for r in rows.collect())
    want = sorted((i, p, w) for i, (_, ws) in enumerate(TOKEN_CASES[:8]) for p, w in enumerate(ws))
    assert got == want
    assert len(got) == 12


def test_line_cases(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(LINE_CASES)], "id bigint, text string")
    got = {r.id: list(r.a) for r in df.select("id", lines_of("text").alias("a")).collect()}
    for i, (text, want) in enumerate(LINE_CASES):
        assert got[i] == want, repr(text)
        assert text_file_lines(text) == want, repr(text)


def test_split_lines_positions_and_nulls(spark):
    df = spark.createDataFrame([(1, "x\ny z\n"), (2, None), (3, ""), (4, "\n")], "doc_id bigint, text string")
    out = split_lines(df, "text", ["doc_id"])
    assert out.schema.simpleString() == "struct<doc_id:bigint,line_no:bigint,line:string>"
    assert sorted(out.collect()) == [(1, 0, "x"), (1, 1, "y z"), (4, 0, "")]


def test_null_line_has_no_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id bigint, line string")
    assert [tuple(r) for r in explode_tokens(df, "line", ["id"]).collect()] == [(2, 0, "a")]


def test_alnum_tokens(spark):
    df = spark.createDataFrame([("--a-b  c,,",), ("caféx 42",), ("",), ("!!",)], "line string")
    got = sorted(r.token for r in alnum_tokens(df, "line").collect())
    assert got == ["42", "a", "b", "c", "caf", "x"]


ALPHABET = ["a", "é", " ", "\t", ",", "("]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=40))
def test_tokens_match_java_model(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    got = {r.id: list(r.t) for r in df.select("id", tokenize("line").alias("t")).collect()}
    assert all(got[i] == java_space_split(s) for i, s in enumerate(lines))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=["a", " ", "\r", "\n"], max_size=12), min_size=1, max_size=40))
def test_lines_match_reader_model(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {r.id: list(r.a) for r in df.select("id", lines_of("text").alias("a")).collect()}
    assert all(got[i] == text_file_lines(s) for i, s in enumerate(texts))


@pytest.mark.parametrize("text", ["a\nb\n", "a\r\n\r\nb", "\n\n"])
def test_split_lines_equals_file_reader(spark, tmp_path, text):
    path = tmp_path / "f.txt"
    path.write_bytes(text.encode())
    from_file = [r.value for r in spark.read.text(str(path)).collect()]
    df = spark.createDataFrame([(text,)], "text string")
    from_col = [r.line for r in split_lines(df, "text").orderBy("line_no").collect()]
    assert from_file == from_col == text_file_lines(text)


def test_tokens_stay_in_jvm(spark):
    df = spark.createDataFrame([("a b",)], "line string").select(F.explode(tokenize("line")))
    plan = explain_text(df)
    assert "EvalPython" not in plan and "[codegen id" in plan


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=["a", "b", " ", "\n", "\r"], max_size=20), min_size=1, max_size=30))
def test_sum_of_counts_equals_token_rows(spark, texts):
    from tokentally.operators.counts import count_text_words

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    tokens = explode_tokens(split_lines(df, "text", ["doc_id"]), "line", ["doc_id", "line_no"])
    counts = count_text_words(df, "text")
    total = counts.agg(F.sum("cnt")).collect()[0][0] or 0
    assert total == tokens.count()
    model = sum(len(java_space_split(line)) for t in texts for line in text_file_lines(t))
    assert total == model


def test_hot_word_is_combined_before_the_shuffle(spark):
    from tokentally.operators.counts import count_text_words

    # One word holds a third of all tokens, spread over every partition.
    texts = [("the " * 50 + " ".join(f"w{i}_{j}" for j in range(100)),) for i in range(400)]
    df = spark.createDataFrame(texts, "text string").repartition(8)
    counts = count_text_words(df, "text")
    plan = explain_text(counts)
    assert "partial_count(1)" in plan and "hashpartitioning(word" in plan
    got = {r.word: r.cnt for r in counts.collect()}
    assert got["the"] == 400 * 50 and len(got) == 1 + 400 * 100
