"""Encoders, the token file and packing against the libraries on whole texts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokentally.llm import bitplane, bytebpe, common, packing, wordbpe
from tokentally.llm.catalog import BYTE_RANKS, WORD_BPE
from tokentally.session import fresh_path

PLAIN = Tokenizer.from_file(WORD_BPE)


def ids_of(text: str) -> list[int]:
    return PLAIN.encode(text, add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def test_arrow_batches_are_bounded_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        common.ship_code(spark)
        assert spark.conf.get(key) == str(common.BATCH_BYTES)
        spark.conf.set(key, "1m")
        common.ship_code(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before or str(common.BATCH_BYTES))


def test_word_parts_equal_whole_texts():
    coder, r = wordbpe.WordEncoder(wordbpe.definition(WORD_BPE), kept_bytes=20_000), random.Random(1)
    bits = list("aAbBéÉßsS'tTrRe .,!?0123٣½ \t\n\x0b\x0c\x1c\x85\xa0　WwǰİıΣσςÅ̧̊ñ漢字한ﬁ😀‍-_\"“”")
    bits += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<|endoftext"] * 3
    for _ in range(8000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(14)))
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == ids_of(text), repr(text)


def test_literals_give_the_librarys_ids():
    coder = wordbpe.WordEncoder(wordbpe.definition(WORD_BPE))
    for text in ("end <|endoftext|> of", "END<|endoftext|>OF <|ENDOFTEXT|>", "<|startoftext|>" * 3):
        for _ in range(2):  # the second time from the store
            assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == ids_of(text)
    assert ids_of("end <|endoftext|> of") == [806, 49407, 539]


def test_windows_of_texts_equal_whole_texts():
    """Through windows that end anywhere: marks, literals, empty texts, texts in several pieces and one long part."""
    coder, r = wordbpe.WordEncoder(wordbpe.definition(WORD_BPE), kept_bytes=20_000), random.Random(5)
    bits = list("aAbBéÉßøÿ÷×sS'tTrRe .,!?0123٣½ \t\n\x0b\x0c\x1c\x85\xa0　WwǰİıΣσςÅ̧̊ñ漢字한ﬁ😀‍-_\"“”|&<=\x00") + ["'s", "'re", ".'", "\u3099", "か"]
    bits += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<|endoftext"] * 3
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(14))) for _ in range(8000)]
    texts += ["", "", " \n", "one,two. Three! " * 60_000, "é" * 1_500_000 + " x", "", "x\u0301 y", "a.b's-c'd" * 9]
    want = [(n, np.array(ids_of(t), "<u4").tobytes()) for n, t in enumerate(texts)]
    for window_bytes in (1, 2_000, wordbpe.WINDOW_BYTES):
        got = list(coder.encode_rows(((n, t.encode()) for n, t in enumerate(texts)), window_bytes))
        assert [texts[n][:100] for n, ids in want if got[n] != (n, ids)] == [] and len(got) == len(want)
        assert coder.held <= 20_000
    assert list(coder.encode_rows(iter(()))) == []


def test_a_window_looks_a_word_up_once(monkeypatch):
    """However often it stands in the texts and whatever marks stand beside it."""
    coder, asked = wordbpe.WordEncoder(wordbpe.definition(WORD_BPE)), Counter()
    letters = coder._letters
    monkeypatch.setattr(coder, "_letters", lambda word: asked.update([word]) or letters(word))
    table = pa.RecordBatch.from_pydict({"doc_id": range(300), "text": ["Zebrafish, (zebrafish) zebrafish!! a.b" for _ in range(300)]})
    monkeypatch.setattr(bitplane, "encoder", lambda _: coder)
    monkeypatch.setattr(bitplane.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda _: 0})())
    (block,) = bitplane._blocks("", 2, "byte", bitplane.BLOCK_IDS)(iter([table]))
    assert block.column(3).to_pylist() == [300 * (len(ids_of(table.column(1)[0].as_py())) + 1)]
    assert asked == {"zebrafish": 1, "a": 1, "b": 1}


def test_the_store_is_bounded_by_bytes():
    coder = wordbpe.WordEncoder(wordbpe.definition(WORD_BPE), kept_bytes=100_000)
    for i in range(200):
        coder.encode(" ".join(f"p{i}q{j}" for j in range(100)).encode())
        assert coder.held <= 200_000 and len(coder.store) * wordbpe.KEEPING <= coder.held
    coder.encode(b"y" * 1_000_000 + b" " + b"z" * 65)
    assert max(map(len, coder.store), default=0) <= wordbpe.LONGEST_KEPT


@pytest.mark.parametrize("kind", ["byte", "bit"])
@settings(max_examples=30, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_planes_round_trip(kind, ids):
    a = np.array(ids, "<u4")
    payload, ends = bitplane.pack_block(a, kind)
    assert bitplane.unpack_block(payload, ends, kind, len(ids)).tolist() == ids


@given(st.lists(st.binary(max_size=40), max_size=6))
def test_checksums_join(parts):
    assert bitplane.crc32_join([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("which", ["edge", "small"])
def test_token_file(spark, request, which):
    docs = request.getfixturevalue(which)
    path = fresh_path(spark, "ids")
    bitplane.write_ids(docs, path, WORD_BPE, block_ids=1000)  # documents cross blocks
    got = sorted(tuple(r) for r in bitplane.read_digest(spark, path).fillna(-1, "doc_id").collect())
    assert bitplane.read_digest(spark, path).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    plain = [(-1 if i is None else i, ids_of(t) + [2]) for i, t in rows_of(docs)]
    assert Counter((i, n, c) for i, _, n, c in got) == Counter((i, len(x), crc(x)) for i, x in plain)
    assert [i for i, *_ in sorted(got, key=lambda r: r[1])] == sorted(i for i, _ in plain)
    ends = np.cumsum([n for _, _, n, _ in sorted(got, key=lambda r: r[1])])
    assert sorted(s for _, s, _, _ in got) == [0, *ends[:-1].tolist()]


def test_the_encoder_gets_small_batches(spark, monkeypatch):
    """Few texts at once stand in an executor's memory; the session's settings are as before afterwards."""
    schema, keys = bitplane._ARROW, (common._BATCH_CONF, common._ROWS_CONF)

    def sizes(*_):
        def run(batches):
            for batch in batches:
                row = [0, 0, 0, batch.nbytes, "byte", [], b"", []]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        return run

    monkeypatch.setattr(bitplane, "_blocks", sizes)
    common.ship_code(spark)
    before = [spark.conf.get(k, None) for k in keys]
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200_000).alias("text"))
    path = fresh_path(spark, "sizes")
    bitplane.write_ids(docs, path, WORD_BPE)
    assert max(r.n_ids for r in spark.read.parquet(path).select("n_ids").collect()) < 4 << 20
    assert [spark.conf.get(k, None) for k in keys] == before


def test_token_file_of_nothing(spark, nothing):
    assert bitplane.token_file(nothing, fresh_path(spark, "ids"), WORD_BPE).count() == 0


@pytest.mark.parametrize("which", ["edge", "small"])
def test_packing(request, which):
    docs = request.getfixturevalue(which)
    got = packing.pack_documents(docs, WORD_BPE, keep_ids=True).collect()
    assert {len(r.ids) // 4 == r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got} == {True}
    want = Counter()
    for i, t in rows_of(docs):
        ids = ids_of(t) + [0]
        want.update((i, p, a, crc(ids[a : a + 2048])) for p, a in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
        assert sum(n for _, n in parts) <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_schema_and_plan(small):
    """The contract's types, and a join that broadcasts no table that grows with the tasks."""
    packed = packing.pack_documents(small, WORD_BPE)
    assert packed.dtypes == [
        ("doc_id", "bigint"),
        ("piece", "int"),
        ("start", "bigint"),
        ("length", "bigint"),
        ("ids_crc32", "bigint"),
        ("sequence_id", "bigint"),
        ("offset", "bigint"),
    ]
    assert "BroadcastExchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing, WORD_BPE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=14), st.integers(0, 20))
def test_fullest_is_the_best_subset(lengths, room):
    counts = np.bincount(lengths, minlength=22)
    chosen = packing.fullest(counts, room)
    best = {0}
    for n in lengths:
        best |= {b + n for b in best}
    assert sum(chosen) == max(b for b in best if b <= room)
    assert not Counter(chosen) - Counter(lengths)


@given(st.lists(st.integers(1, 30), max_size=40))
def test_plan_places_every_piece(lengths):
    counts = np.bincount(lengths, minlength=31)
    placed = Counter()
    for bins, inside in packing.plan(counts):
        assert sum(inside) <= 30
        for n in inside:
            placed[n] += bins
    assert placed == Counter(lengths)


@pytest.mark.parametrize("which", ["edge", "small"])
def test_byte_bpe(request, which):
    docs = request.getfixturevalue(which)
    coder = bytebpe.encoding(bytebpe._ranks(BYTE_RANKS), public_tokenizers.PATTERN)
    got = bytebpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for i, t in rows_of(docs):
        ids = coder.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    back = bytebpe.decode_ids(bytebpe.encode_texts(docs, BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == Counter((i, t.encode()) for i, t in rows_of(docs))


def test_safe_parts_change_no_id():
    coder, r = bytebpe.encoding(bytebpe._ranks(BYTE_RANKS), public_tokenizers.PATTERN), random.Random(2)
    for _ in range(5000):
        text = "".join(r.choice("aAzZ09 \n\t'sé.ß\x1c\xa0　 !漢٣") for _ in range(r.randrange(40)))
        assert bytebpe.encode(coder, text, 3) == coder.encode_ordinary(text), repr(text)


def test_long_runs_of_white_space(spark):
    """The library panics on these; a run of one kind is one match, encoded as one piece."""
    coder = bytebpe.encoding(bytebpe._ranks(BYTE_RANKS), public_tokenizers.PATTERN)
    r = random.Random(4)
    for _ in range(4000):
        text = "".join(r.choice(["a", "0", " ", "  ", "\n", "\t\t", "'s", "é", "\x1c", "\x85", "\xa0", "　"]) for _ in range(r.randrange(30)))
        assert bytebpe.encode(coder, text, 3, 2) == coder.encode_ordinary(text), repr(text)
    texts = ["a" + " " * 10_000_000 + "b", "\t" * 10_000_000, "x\n" + " \t" * 2_000_000 + "\ny", "a" + " " * 200_000 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in bytebpe.round_trip(df, BYTE_RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    ids = coder.encode_ordinary(texts[3])  # short enough for the library
    assert got[3].n_tokens == len(ids) and got[3].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    # ten million alike characters: as many ids a character as in the shorter run, and the last goes with the word
    assert got[0].n_tokens - got[3].n_tokens == (10_000_000 - 200_000) * (got[3].n_tokens - 1) // 200_000


def test_an_unknown_id_fails(spark):
    df = spark.createDataFrame([(1, [5, 99_999_999])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="KeyError"):
        bytebpe.decode_ids(df, BYTE_RANKS, public_tokenizers.PATTERN).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {bytes(r.bytes) for r in bytebpe.decode_ids(none, BYTE_RANKS, public_tokenizers.PATTERN).collect()} == {b""}


def test_byte_bpe_of_nothing(nothing):
    assert bytebpe.round_trip(nothing, BYTE_RANKS, public_tokenizers.PATTERN).count() == 0
