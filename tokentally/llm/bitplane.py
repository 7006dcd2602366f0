"""Token-id files: blocks of ids as bit or byte planes, each compressed with zstandard.

A file of ids is a Parquet table whose rows are blocks of ``BLOCK_IDS`` ids (the last of
a shard may be shorter). The ids of a block are unsigned 32-bit integers; plane p of a
byte block holds byte p of every id, plane p of a bit block bit p, eight ids to a byte,
first id in the lowest bit. Trailing planes that are all zero are left out. The planes
are compressed one by one and joined; ``plane_ends`` is the chunk index: where each
compressed plane ends. ``pieces`` says which documents' ids the block holds. Shards hold
ranges of ``doc_id`` in ascending order, so shard, then block, then place is the order of
all ids. Spark writes and reads the table, so it works on any store that Spark reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokentally.llm.common import settle, ship_code, small_batches, text_bytes
from tokentally.llm.wordbpe import definition, encoder

BLOCK_IDS = 1 << 16
LEVEL = 3

PIECE = "struct<ord:bigint,doc_id:bigint,start:bigint,length:int,last:boolean>"
BLOCK_SCHEMA = (
    f"shard int, block bigint, first bigint, n_ids int, planes string, plane_ends array<int>, payload binary, pieces array<{PIECE}>"
)
_PIECE_ARROW = pa.struct(
    [("ord", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("last", pa.bool_())]
)
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int64()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("planes", pa.string()),
        ("plane_ends", pa.list_(pa.int32())),
        ("payload", pa.binary()),
        ("pieces", pa.list_(_PIECE_ARROW)),
    ]
)


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "byte":
        planes = [p.tobytes() for p in octets]
    else:
        planes = [np.packbits(o >> b & 1, bitorder="little").tobytes() for o in octets for b in range(8)]
    while planes and planes[-1].count(0) == len(planes[-1]):
        planes.pop()
    return planes


def join_planes(planes: list[bytes], kind: str, n: int) -> np.ndarray:
    octets = np.zeros((n, 4), np.uint8)
    for p, plane in enumerate(planes):
        if kind == "byte":
            octets[:, p] = np.frombuffer(plane, np.uint8)
        else:
            bits = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
            octets[:, p // 8] |= bits << (p % 8)
    return octets.reshape(-1).view("<u4")


def pack_block(ids: np.ndarray, kind: str) -> tuple[bytes, list[int]]:
    """The compressed planes and where each ends."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    packed = [press.compress(p) for p in split_planes(ids, kind)]
    return b"".join(packed), np.cumsum([len(p) for p in packed]).tolist()


def unpack_block(payload: bytes, ends: list[int], kind: str, n: int) -> np.ndarray:
    press = zstandard.ZstdDecompressor()
    planes = [press.decompress(payload[a:b]) for a, b in zip([0, *ends], ends)]
    return join_planes(planes, kind, n)


def crc32_join(pieces: list[tuple[int, int]]) -> int:
    """The CRC-32 of joined pieces from each piece's ``(crc, bytes)``.

    The CRC of ``a + b`` is that of ``a`` carried over as many zero bytes as ``b`` has,
    a linear map of 32 bits, combined with that of ``b``.
    """
    total = 0
    for crc, size in pieces:
        total = _over_zeros(total, size) ^ crc
    return total


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for column in matrix:
        if vector & 1:
            out ^= column
        vector >>= 1
    return out


_zeros: list[list[int]] = []


def _over_zeros(crc: int, size: int) -> int:
    """``crc`` carried over ``size`` zero bytes; the maps for powers of two are kept."""
    if not _zeros:
        one_bit = [0xEDB88320] + [1 << k for k in range(31)]  # the reflected polynomial; shifts right
        step = one_bit
        for _ in range(3):  # one byte
            step = [_times(step, c) for c in step]
        for _ in range(63):
            _zeros.append(step)
            step = [_times(step, c) for c in step]
    for k in range(size.bit_length()):
        if size >> k & 1:
            crc = _times(_zeros[k], crc)
    return crc


def _blocks(vocabulary: str, end_id: int, kind: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = encoder(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        waiting, held, pieces, block, first, ord_ = [], 0, [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(waiting)
            payload, ends = pack_block(ids, kind)
            row = [shard, block, first, len(ids), kind, ends, payload, pieces]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))))
        for doc_id, encoded in coder.encode_rows(rows):
            ids, start = np.frombuffer(encoded + end, "<u4"), 0
            while True:
                part = ids[start : start + block_ids - held]
                last = start + len(part) == len(ids)
                waiting.append(part)
                pieces.append({"ord": ord_, "doc_id": doc_id, "start": start, "length": len(part), "last": last})
                held, start = held + len(part), start + len(part)
                if held == block_ids:
                    yield close()
                    waiting, held, pieces, block, first = [], 0, [], block + 1, first + block_ids
                if last:
                    break
            ord_ += 1
        if pieces:
            yield close()

    return run


def write_ids(
    docs: DataFrame, path: str, vocabulary_path: str, *, end_id: int = 2, kind: str = "byte", block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs [doc_id, text]`` and write the ids to ``path`` in ascending ``doc_id`` order.

    The texts are dealt to shards by ranges of ``doc_id`` (and of a text hash, so that
    rows that repeat an id may fill several shards) and encoded there.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    keys = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = docs.repartitionByRange(*keys[:2]).sortWithinPartitions(*keys)
    with small_batches(docs.sparkSession):
        ordered.mapInArrow(_blocks(definition(vocabulary_path), end_id, kind, block_ids), BLOCK_SCHEMA).write.parquet(path)


def _pieces_read(with_ids: bool):
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("ord", pa.int64()),
            ("doc_id", pa.int64()),
            ("place", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("whole", pa.bool_()),
            ("crc", pa.int64()),
            *([("ids", pa.binary())] if with_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = unpack_block(row["payload"], row["plane_ends"], row["planes"], row["n_ids"]).tobytes()
                at, out = 0, []
                for p in row["pieces"]:
                    ids = data[4 * at : 4 * (at + p["length"])]
                    whole = p["last"] and p["start"] == 0
                    piece = (row["shard"], p["ord"], p["doc_id"], row["first"] + at, p["start"], p["length"], whole, zlib.crc32(ids))
                    out.append((*piece, ids) if with_ids else piece)
                    at += p["length"]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def read_pieces(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``[shard, ord, doc_id, place, start, length, whole, crc, (ids)]``: each document's ids in each block.

    ``ord`` numbers the documents of a shard, ``place`` is where the piece stands in
    its shard and ``start`` where in its document; ``whole`` says that the piece is
    all of it.
    """
    ship_code(spark)
    schema = "shard int, ord bigint, doc_id bigint, place bigint, start bigint, length bigint, whole boolean, crc bigint"
    schema += ", ids binary" if with_ids else ""
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInArrow(_pieces_read(with_ids), schema)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """``[doc_id, start, n_tokens, ids_crc32]`` per document, from the written blocks.

    Documents that cross blocks are joined by their pieces' checksums, not by their
    ids. ``start`` adds the sizes of all shards before, a table of one row a shard.
    """
    with small_batches(spark):
        pieces = settle(read_pieces(spark, path, with_ids=False), "pieces")
    shards = spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    whole = pieces.where("whole").select("shard", "doc_id", "place", "length", "crc")
    cut = pieces.where("not whole").groupBy("shard", "ord", "doc_id")
    cut = cut.agg(
        F.min("place").alias("place"),
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("start", "crc", "length"))).alias("parts"),
    ).mapInArrow(_joined, "shard int, doc_id bigint, place bigint, length bigint, crc bigint")
    return whole.union(cut).join(base, "shard").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), F.col("length").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [crc32_join([(p["crc"], 4 * p["length"]) for p in parts]) for parts in batch.column(5).to_pylist()]
        columns = [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "place", "length", "crc"])


def token_file(docs: DataFrame, path: str, vocabulary_path: str, *, end_id: int = 2, kind: str = "byte") -> DataFrame:
    """Encode ``docs [doc_id, text]``, write them to ``path`` and return ``read_digest`` of it.

    A null or empty text has the end id alone. Repeated rows are written as often as
    they come; a null ``doc_id`` sorts first. Other columns are ignored. An empty table
    writes no block and returns no row.
    """
    write_ids(docs, path, vocabulary_path, end_id=end_id, kind=kind)
    return read_digest(docs.sparkSession, path)
