"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut at safe boundaries first: places where one match of the splitting
pattern ends whatever comes after, so that the parts' ids joined are the whole text's.
Such a place stands between a character that is no white space and a space or line
end, and between a basic letter and a digit. A run without such a place stays whole.

A long run of white space is one match that the pattern finds by backtracking over all
of it, which ends in a stack overflow inside the library. Such a run is known beforehand:
all of it at the end of a text, and all but its last character before other text. It is
encoded as one piece, without the pattern.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import ship_code, text_bytes

#: Texts of more characters are cut into parts of about this many.
PART_CHARS = 1 << 16

#: White space runs of so many characters are encoded beside the pattern.
RUN_CHARS = 1 << 14

# The characters that the library's patterns call white space (Unicode White_Space).
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE = re.compile(r"\S(?=[ \n])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """This process's encoding for the lines of a rank file."""
    if ranks not in _encodings:
        _encodings.clear()
        table = {base64.b64decode(token): int(rank) for token, rank in map(str.split, ranks.splitlines())}
        _encodings[ranks] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[ranks]


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    start = 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size - 1)):
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encoded_parts(coder: tiktoken.Encoding, text: str, size: int = PART_CHARS, run: int = RUN_CHARS) -> Iterator[list[int]]:
    """The ids of ``text``, part by part."""
    if len(text) <= min(size, run):
        yield coder.encode_ordinary(text)
        return
    start = 0
    for white in re.finditer(f"[{_WHITE}]{{{run},}}", text):
        end = white.end() - (white.end() < len(text))  # the last one goes with what follows
        yield from map(coder.encode_ordinary, safe_parts(text[start : white.start()], size))
        yield coder._encode_single_piece(text[white.start() : end])
        start = end
    yield from map(coder.encode_ordinary, safe_parts(text[start:], size))


def encode(coder: tiktoken.Encoding, text: str, size: int = PART_CHARS, run: int = RUN_CHARS) -> list[int]:
    return [i for ids in encoded_parts(coder, text, size, run) for i in ids]


def _coded(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            ids = [encode(coder, t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])

    return run


def _decoded(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            out = [coder.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "bytes"])

    return run


def _digests(ranks: str, pattern: str):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            counts, names, backs = [], [], []
            for data in text_bytes(batch.column(1)):
                n, written, back = 0, hashlib.sha256(), hashlib.sha256()
                for ids in filter(None, encoded_parts(coder, data.decode())):
                    written.update(("," * (n > 0) + ",".join(map(str, ids))).encode())
                    back.update(coder.decode_bytes(ids))
                    n += len(ids)
                counts.append(n)
                names.append(written.hexdigest())
                backs.append(back.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(names), pa.array(backs)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _ranks(path: str) -> str:
    with open(path, encoding="ascii") as f:
        return f.read()


def _texts(docs: DataFrame) -> DataFrame:
    ship_code(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))


def encode_texts(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``[doc_id, ids array<int>]`` for each row of ``docs [doc_id, text]``; no special tokens.

    A null or empty text has no ids. Repeated rows and null ids are carried along;
    other columns are ignored.
    """
    return _texts(docs).mapInArrow(_coded(_ranks(rank_path), pattern), "doc_id bigint, ids array<int>")


def decode_ids(coded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``[doc_id, bytes]``: the bytes of each row's ids, which need not end on whole characters.

    Null ids are no ids; an id that the ranks do not hold fails the job (``KeyError``).
    Repeated rows and null ``doc_id`` are carried along; other columns are ignored.
    """
    ship_code(coded.sparkSession)
    run = _decoded(_ranks(rank_path), pattern)
    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``[doc_id, n_tokens, ids_sha256, decoded_sha256]``: encode and decode each row, in one pass."""
    run = _digests(_ranks(rank_path), pattern)
    return _texts(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
