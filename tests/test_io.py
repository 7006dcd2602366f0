"""Sources and sinks (S1, K1, S2, S3) and the timed job (M1)."""

from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tokentally.operators.counts import keyed_sum, word_count
from tokentally.plans.timing import timed_word_count
from tokentally.sinks.text import format_pairs, write_counts
from tokentally.sources.results import read_counts, result_manifest
from tokentally.sources.text import read_lines

FILE_CASES = [
    (b"", []),
    (b"a", ["a"]),
    (b"a\n", ["a"]),
    (b"a\r", ["a"]),
    (b"a\n\n", ["a", ""]),
    (b"a\r\n\n", ["a", ""]),
    (b"\n", [""]),
    (b"\r\n", [""]),
    (b"\n\n", ["", ""]),
    (b"\n\r", ["", ""]),
    (b"a\r\nb\rc\nd", ["a", "b", "c", "d"]),
    (b"a\n\rb", ["a", "", "b"]),
    (b" \n", [" "]),
    ("a\u0085b c\x0bd\x0ce".encode(), ["a\u0085b c\x0bd\x0ce"]),
    (b"\xef\xbb\xbfa b\n", ["a b"]),
]


@pytest.mark.parametrize("data,want", FILE_CASES)
def test_read_lines_cases(spark, tmp_path, data, want):
    path = tmp_path / "in.txt"
    path.write_bytes(data)
    assert [r.value for r in read_lines(spark, str(path)).collect()] == want


def test_read_lines_comma_list_and_dir(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.txt").write_bytes(b"x y\n")
    (tmp_path / "2.txt").write_bytes(b"z\n")
    df = read_lines(spark, f"{tmp_path / 'd'},{tmp_path / '2.txt'}")
    assert sorted(r.value for r in df.collect()) == ["x y", "z"]


def test_malformed_utf8_merges(spark, tmp_path):
    path = tmp_path / "bad.txt"
    path.write_bytes(b"caf\xe9 caf\xff\n")
    got = {r.word: r.cnt for r in word_count(read_lines(spark, str(path))).collect()}
    assert got == {"caf�": 2}


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_lines(spark, str(tmp_path / "nope.txt")).collect()


def test_word_count_counts_empty_word(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_bytes(b"to be or\n\nnot  to be\n   \n")
    got = {r.word: r.cnt for r in word_count(read_lines(spark, str(path))).collect()}
    assert got == {"to": 2, "be": 2, "or": 1, "": 2, "not": 1}


def test_keyed_sum_does_not_wrap(spark):
    df = spark.createDataFrame([("w", 2147483647), ("w", 1)], "word string, n int")
    out = keyed_sum(df)
    assert out.schema.simpleString() == "struct<word:string,cnt:bigint>"
    assert out.collect()[0].cnt == 2147483648


def test_keyed_sum_keeps_fractional_values(spark):
    df = spark.createDataFrame([("a", "x", 0.5), ("a", "x", 0.25), ("b", "y", 1.0)], "k1 string, k2 string, v double")
    got = sorted(tuple(r) for r in keyed_sum(df, ["k1", "k2"], "v", "total").collect())
    assert got == [("a", "x", 0.75), ("b", "y", 1.0)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "value string")
    assert word_count(df).count() == 0


def test_format_pairs(spark):
    df = spark.createDataFrame([("", 3), ("a,b", 1), ("(x)", 2)], "word string, cnt bigint")
    assert sorted(r.value for r in format_pairs(df).collect()) == ["((x),2)", "(,3)", "(a,b,1)"]


def test_write_fails_if_output_exists(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "word string, cnt bigint")
    out = str(tmp_path / "result")
    write_counts(df, out)
    assert os.path.exists(os.path.join(out, "_SUCCESS"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS|already exists"):
        write_counts(df, out)


WORD = st.text(alphabet=["a", "é", ",", "(", ")", " ", "\t", "1", "-", "\u0085", "\u2028"], max_size=8)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(WORD, st.integers(min_value=-(2**63), max_value=2**63 - 1), max_size=30))
def test_sink_roundtrip(spark, tmp_path_factory, counts):
    out = str(tmp_path_factory.mktemp("rt") / "result")
    df = spark.createDataFrame(list(counts.items()), "word string, cnt bigint")
    write_counts(df.repartition(3), out)
    back = read_counts(spark, out)
    assert back.schema.simpleString() == "struct<word:string,cnt:bigint>"
    assert {r.word: r.cnt for r in back.collect()} == counts


@pytest.mark.parametrize("bad", ["not a pair", "(abc)", "(a,)", "(a,1.5)", "(a,x)", "a,1)", "(a,1"])
def test_read_counts_rejects_malformed_line(spark, tmp_path, bad):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "part-00000").write_text(f"(a,1)\n{bad}\n")
    with pytest.raises(Exception, match="not a \\(word,count\\) line"):
        read_counts(spark, str(tmp_path / "r")).collect()


def test_read_counts_parses_last_comma(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "part-00000").write_text("(,3)\n(a,b,-2)\n((x),1)\n(é,,9)\n")
    got = sorted(tuple(r) for r in read_counts(spark, str(tmp_path / "r")).collect())
    assert got == [("", 3), ("(x)", 1), ("a,b", -2), ("é,", 9)]


def test_result_manifest(spark, tmp_path):
    out = str(tmp_path / "result")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "word string, cnt bigint")
    write_counts(df.repartition(4), out)
    man = result_manifest(spark, out).collect()
    assert sum(r.rows for r in man) == 2
    for r in man:
        assert r.file_name.startswith("part-") and r.rows > 0
        assert os.path.getsize(os.path.join(out, r.file_name)) == r.file_size
    on_disk = [f for f in os.listdir(out) if f.startswith("part-")]
    non_empty = [f for f in on_disk if os.path.getsize(os.path.join(out, f)) > 0]
    assert sorted(r.file_name for r in man) == sorted(non_empty)


def test_timed_word_count(spark, tmp_path):
    lines = spark.createDataFrame([("a b a",), ("c",)], "value string")
    out = timed_word_count(spark, lines, str(tmp_path / "result"))
    row = out.collect()[0]
    assert out.schema.simpleString() == "struct<elapsed_ms:bigint,rows:bigint>"
    assert row.rows == 3 and row.elapsed_ms >= 0
    assert {r.word: r.cnt for r in read_counts(spark, str(tmp_path / "result")).collect()} == {
        "a": 2, "b": 1, "c": 1}


def test_sum_of_counts_is_token_count(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_bytes(b"x y z\n\n  a\nb  \n")
    lines = read_lines(spark, str(path))
    total = word_count(lines).agg(F.sum("cnt")).collect()[0][0]
    assert total == 3 + 1 + 3 + 1


def test_command_line_job(spark, tmp_path, capsys):
    from tokentally.__main__ import main

    (tmp_path / "in.txt").write_bytes(b"to be or\nnot  to be\n")
    out = main([str(tmp_path / "in.txt"), str(tmp_path / "out")])
    printed = capsys.readouterr().out
    assert "time in ms :" in printed
    assert {r.word: r.cnt for r in read_counts(spark, out).collect()} == {
        "to": 2, "be": 2, "or": 1, "not": 1, "": 1}


def test_gzip_input_is_spread_and_equal(spark, tmp_path):
    import gzip

    from support import explain_text

    text = "".join(f"line {i} a b{i % 7}\n" for i in range(5000)).encode()
    (tmp_path / "plain.txt").write_bytes(text)
    (tmp_path / "packed.txt.gz").write_bytes(gzip.compress(text))
    packed = read_lines(spark, str(tmp_path / "packed.txt.gz"), spread=4)
    assert "RoundRobinPartitioning" in explain_text(packed)
    plain = read_lines(spark, str(tmp_path / "plain.txt"))
    assert sorted(word_count(packed).collect()) == sorted(word_count(plain).collect())


@pytest.mark.parametrize(
    "files", [["top.txt", "sub/in.txt"], ["sub/in.txt"], ["top.txt", "dt=1/in.txt"], ["top.txt", "value=1/in.txt"]]
)
def test_nested_folders_are_read_whole(spark, tmp_path, files):
    for i, name in enumerate(files):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"(w{i},{i})\n")
    assert sorted(r.value for r in read_lines(spark, str(tmp_path)).collect()) == [f"(w{i},{i})" for i in range(len(files))]
    assert read_lines(spark, str(tmp_path)).columns == ["value"]
    assert {r.word: r.cnt for r in read_counts(spark, str(tmp_path)).collect()} == {f"w{i}": i for i in range(len(files))}
    assert result_manifest(spark, str(tmp_path)).count() == len(files)


def test_nested_braces(spark, tmp_path):
    """``{a,{b,c}}`` names three files, alone and in a list."""
    from tokentally.sources.text import _path_list

    for name in "abcd":
        (tmp_path / f"{name}.txt").write_text(f"{name}\n")
    both = f"{tmp_path}/{{a,{{b,c}}}}.txt"
    assert _path_list(f"{both},x,,{{p,q}}") == [both, "x", "{p,q}"]
    assert sorted(r.value for r in read_lines(spark, both).collect()) == ["a", "b", "c"]
    assert sorted(r.value for r in read_lines(spark, f"{both},{tmp_path}/d.txt").collect()) == ["a", "b", "c", "d"]


def test_brace_glob(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.txt").write_text(f"{name}\n")
    df = read_lines(spark, f"{tmp_path}/{{a,b}}.txt,{tmp_path}/c.txt")
    assert sorted(r.value for r in df.collect()) == ["a", "b", "c"]


def test_garbage_line_fails_for_each_column(spark, tmp_path):
    (tmp_path / "part-0").write_text("(a,1)\ngarbage\n")
    for col in ("word", "cnt"):
        with pytest.raises(Exception, match="not a \\(word,count\\) line"):
            read_counts(spark, str(tmp_path)).select(col).collect()


@pytest.mark.parametrize("word", [None, "a\nb", "a\rb"])
def test_unreadable_words_are_not_written(spark, tmp_path, word):
    df = spark.createDataFrame([(word, 1)], "word string, cnt bigint")
    with pytest.raises(Exception, match="a line cannot hold the word"):
        write_counts(df, str(tmp_path / "out"))


def test_equal_file_names_stay_apart(spark, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "part-00000").write_text("(a,1)\n")
    assert [tuple(r) for r in result_manifest(spark, f"{tmp_path}/*").collect()] == [("part-00000", 6, 1)] * 2


def test_read_lines_glob_and_list(spark, tmp_path):
    for name, body in [("a.txt", b"x\n"), ("b.txt", b"y z\n"), ("c.log", b"skip\n")]:
        (tmp_path / name).write_bytes(body)
    by_glob = sorted(r.value for r in read_lines(spark, str(tmp_path / "*.txt")).collect())
    by_list = sorted(r.value for r in read_lines(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]).collect())
    assert by_glob == by_list == ["x", "y z"]
