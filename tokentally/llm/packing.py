"""Packing documents into sequences: minimum bin slack over the histogram of lengths.

Documents longer than a sequence are cut into whole sequences and a rest. Then, bin by
bin: the longest length left is placed, and a subset-sum table (one integer whose bit s
says that some lengths left add up to s) finds the fullest feasible filling of what
remains. That filling is removed from the histogram, as many times over as the counts
allow: those bins are alike. The work depends on the number of different lengths,
at most the sequence length, not on the number of documents. Which piece goes where
follows from its rank among the pieces of its length, so no group of pieces is ever
gathered: each task ranks its own, and a table of counts per task and length, which grows
with the tasks and so is joined by sorting and never broadcast, adds the ranks before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokentally.llm.common import settle, ship_code, text_bytes
from tokentally.llm.wordbpe import definition, encoder

SEQUENCE = 2048


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths that fill ``room`` as far as the ``counts`` left allow, longest first.

    Bits of ``sums`` are the reachable fillings; ``steps`` keeps what each length's
    copies, in groups of doubling size, added, to find the lengths of the best one.
    """
    whole, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length in range(room, 0, -1):
        left = min(int(counts[length]), room // length)
        group = 1
        while left:
            take = min(group, left)
            grown = (sums | sums << (take * length)) & whole
            if grown != sums:
                steps.append((length, take, sums))
                sums = grown
            left -= take
            group *= 2
        if sums >> room:
            break
    total, used = sums.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used += [length] * take
            total -= take * length
    return sorted(used, reverse=True)


def plan(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """``(bins, lengths in each)`` that place ``counts[length]`` pieces of every length."""
    size = len(counts) - 1
    left, out = counts.astype(np.int64).copy(), []
    for longest in range(size, 0, -1):
        while left[longest]:
            left[longest] -= 1
            lengths = [longest, *fullest(left, size - longest)]
            left[longest] += 1
            kinds, uses = np.unique(lengths, return_counts=True)
            bins = int((left[kinds] // uses).min())
            left[kinds] -= bins * uses
            out.append((bins, lengths))
    return out


def slots(planned: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Runs of places: ranks ``rank ..`` of ``length`` go to sequences ``sequence ..`` at ``offset``."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for bins, lengths in planned:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset))
            taken[length] = rank + bins
            offset += length
        sequence += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T))


def _cut(vocabulary: str, end_id: int, size: int, keep_ids: bool):
    schema = pa.schema(
        [
            ("task", pa.int32()),
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("rank", pa.int64()),
            ("ids_crc32", pa.int64()),
            *([("ids", pa.binary())] if keep_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, seen = encoder(vocabulary), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                ids = coder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    n = len(part) // 4
                    row = (task, doc_id, piece, at // 4, n, int(seen[n]), zlib.crc32(part))
                    out.append((*row, part) if keep_ids else row)
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _placed(runs: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = runs["length"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            # the run of a piece: the last one of its length that starts at or before its rank
            widest = np.int64(max(int(rank.max(initial=0)), int(runs["rank"].max(initial=0))) + 1)
            at = np.searchsorted(lengths * widest + runs["rank"], length * widest + rank, "right") - 1
            sequence = runs["sequence"][at] + rank - runs["rank"][at]
            kept = batch.drop_columns(["rank", "before", "task"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(runs["offset"][at]))

    return run


def pack_documents(
    docs: DataFrame, vocabulary_path: str, *, size: int = SEQUENCE, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """``[doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset]``, a row for each piece.

    A document is the ids of its whole text and ``end_id``; a null or empty text is the
    end id alone. With ``keep_ids`` each piece carries its ids (little-endian uint32).
    Repeated rows are packed as often as they come; a null ``doc_id`` is carried
    along. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    more = ", ids binary" if keep_ids else ""
    pieces = settle(
        docs.mapInArrow(
            _cut(definition(vocabulary_path), end_id, size, keep_ids),
            f"task int, doc_id bigint, piece int, start bigint, length bigint, rank bigint, ids_crc32 bigint{more}",
        ),
        "pieces",
    )
    by_task = settle(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = np.zeros(size + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator():  # one row a length
        histogram[row["length"]] = row["n"]
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before.hint("merge"), ["task", "length"]).select(*pieces.columns, "before")
    return ranked.mapInArrow(
        _placed(slots(plan(histogram))),
        f"doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint{more}, sequence_id bigint, offset bigint",
    )
