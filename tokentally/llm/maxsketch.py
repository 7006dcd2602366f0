"""Ranked lexical search: hashed max-sketches bound the scores, exact rescoring decides.

A first pass over the texts counts documents, terms, and the documents that hold each query
term. A second one turns each document into a sketch: every term's impact (its part of a
score but for the weight) is folded into one of ``COORDINATES`` places, named by the
term's hash, by maximum. The sum of a query's weights times the sketch's values at its terms'
places is never below the document's score. All queries look up a block of sketches at once;
then, query by query, documents are scored exactly in descending order of their bounds
until the next bound is below the score that a document of the result must reach.

Each task keeps the best ``k`` of its own documents, and the tasks' results are merged, so
the texts are never shuffled. The queries pass in blocks of a bounded number of terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokentally.llm.common import settle, ship_code, text_bytes
from tokentally.llm.hashing import word_hashes

#: Places of a sketch, and the results of a query.
COORDINATES, BEST = 1 << 16, 50
#: Terms and queries of a block; documents and bytes of text whose sketches are held at once.
BLOCK_TERMS, BLOCK_ITEMS = 40_000, 4_000
HELD_DOCUMENTS, HELD_BYTES = 512, 8 << 20
#: Sketch places of a block of documents at most (eight bytes each).
HELD_PLACES = 4 << 20
#: Documents scored between two looks at the threshold.
AT_ONCE = 32

_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def terms_of(data: bytes) -> np.ndarray:
    """The hashes of a text's terms in order; ``bytes.lower`` changes A to Z only."""
    return word_hashes(data.lower(), _APART)


class Queries:
    """A block of items: their terms, and later the weights."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = np.unique(np.concatenate([t for _, t in items] or [np.zeros(0, np.uint64)]))
        self.terms = [np.searchsorted(self.words, t) for _, t in items]
        self.places, self.place_of = np.unique(self.words % np.uint64(COORDINATES), return_inverse=True)
        self.weights = np.zeros(len(self.words), np.int64)
        self.documents = self.length = 0

    def weigh(self, counts: dict[int, int]) -> None:
        self.documents, self.length = counts.get(-2, 0), counts.get(-1, 0)
        for i in range(len(self.words)):
            self.weights[i] = math.floor(1000 * math.log((2 * self.documents + 2) / (2 * counts.get(i, 0) + 1)))


def query_blocks(items: DataFrame) -> Iterator[Queries]:
    """``items [item_id, text]`` in blocks; the driver holds one block at a time."""
    held, terms = [], 0
    for row in items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).toLocalIterator():
        found = np.unique(terms_of((row["text"] or "").encode()))
        if held and (terms + len(found) > BLOCK_TERMS or len(held) == BLOCK_ITEMS):
            yield Queries(held)
            held, terms = [], 0
        held.append((row["item_id"], found))
        terms += len(found)
    if held:
        yield Queries(held)


def _counted(words: np.ndarray):
    """Rows ``[slot, n]`` of a task: documents with a term (-2), terms (-1), documents that hold ``words[slot]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, length, held = 0, 0, np.zeros(len(words), np.int64)
        for batch in batches:
            for data in text_bytes(batch.column(0)):
                h = terms_of(data)
                documents, length = documents + bool(len(h)), length + len(h)
                if len(h) and len(words):
                    at = np.searchsorted(words, h)
                    at[at == len(words)] = 0
                    held[np.unique(at[words[at] == h])] += 1
        some = np.flatnonzero(held)
        slots, n = [-2, -1, *some.tolist()], [documents, length, *held[some].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(n, pa.int64())], names=["slot", "n"])

    return run


class Sketches:
    """The terms of a block of documents with their impacts, and the sketches at the places that ``queries`` look up."""

    def __init__(self, texts: list[bytes], queries: Queries):
        hashes, impacts, sizes = [], [], []
        for data in texts:
            h = terms_of(data)
            m = 50 + (50 * len(h) * queries.documents) // queries.length
            words, tf = np.unique(h, return_counts=True)
            hashes.append(words)
            impacts.append((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            sizes.append(len(words))
        self.hashes, self.impacts = np.concatenate(hashes), np.concatenate(impacts)
        self.ends = np.cumsum([0, *sizes])
        row = np.repeat(np.arange(len(texts)), sizes)
        place = self.hashes % np.uint64(COORDINATES)
        at = np.searchsorted(queries.places, place)
        at[at == len(queries.places)] = 0
        seen = np.flatnonzero(queries.places[at] == place)
        seen = seen[np.argsort(self.impacts[seen], kind="stable")]  # of equal places the last, largest, is kept
        self.maxima = np.zeros((len(queries.places), len(texts)), np.int64)
        self.maxima[at[seen], row[seen]] = self.impacts[seen]

    def bounds(self, queries: Queries, item: int) -> np.ndarray:
        terms = queries.terms[item]
        return queries.weights[terms] @ self.maxima[queries.place_of[terms]]

    def score(self, queries: Queries, item: int, row: int) -> int:
        """The exact score: the item's terms among all terms of the document."""
        words = self.hashes[self.ends[row] : self.ends[row + 1]]
        terms = queries.terms[item]
        asked = queries.words[terms]
        at = np.searchsorted(words, asked)
        at[at == len(words)] = 0
        found = words[at] == asked
        return int((queries.weights[terms[found]] * self.impacts[self.ends[row] + at[found]]).sum())


class Ranking:
    """The best ``k`` of the documents seen: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """The score below which no document can enter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, found: list[tuple[int, int]]) -> None:
        self.rows = sorted([*self.rows, *found], key=lambda r: (-r[0], r[1]))[: self.k]


def search(sketches: Sketches, ids: list[int], queries: Queries, rankings: list[Ranking]) -> int:
    """Bring the block's documents into the rankings; returns how many exact scores that took."""
    scored = 0
    for item, ranking in enumerate(rankings):
        if not len(queries.terms[item]):
            continue
        bounds = sketches.bounds(queries, item)
        order = np.flatnonzero(bounds >= ranking.least)
        order = order[np.argsort(-bounds[order], kind="stable")]
        for start in range(0, len(order), AT_ONCE):
            some = order[start : start + AT_ONCE]
            some = some[bounds[some] >= ranking.least].tolist()
            if not some:
                break
            exact = [(sketches.score(queries, item, row), ids[row]) for row in some]
            scored += len(some)
            ranking.add([e for e in exact if e[0] >= ranking.least])
    return scored


def _searched(queries: Queries, k: int):
    schema = pa.schema([("query", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rankings = [Ranking(k) for _ in queries.ids]
        held, ids, size = [], [], 0
        most = max(1, min(HELD_DOCUMENTS, HELD_PLACES // len(queries.places)))
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                if data:
                    held.append(data)
                    ids.append(doc_id)
                    size += len(data)
                if len(held) >= most or size > HELD_BYTES:
                    search(Sketches(held, queries), ids, queries, rankings)
                    held, ids, size = [], [], 0
        if held:
            search(Sketches(held, queries), ids, queries, rankings)
        for query, ranking in enumerate(rankings):
            rows = [(query, queries.ids[query], doc_id, score) for score, doc_id in ranking.rows]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy("query", *keys).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = BEST) -> DataFrame:
    """``[item_id, rank, doc_id, score]``: the ``k`` documents of highest score above 0 for each row of ``items``.

    ``docs [doc_id, text]``, ``items [item_id, text]``. Equal scores come by ascending ``doc_id``.
    A term is known by its 64-bit hash. A null, empty or termless text has no terms: such a document counts
    nowhere and such an item has no result. Documents without an id count in the statistics but are not
    results; repeated rows are separate documents and separate items. Other columns are ignored; an empty
    table of either kind gives an empty result.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for queries in query_blocks(items):
        counts = texts.select("text").mapInArrow(_counted(queries.words), "slot bigint, n bigint")
        counts = counts.groupBy("slot").agg(F.sum("n").alias("n")).collect()  # one row a query term of the block
        queries.weigh({r["slot"]: r["n"] for r in counts})
        if not queries.length or not len(queries.words):
            continue
        found = texts.where("doc_id is not null").mapInArrow(
            _searched(queries, k), "query int, item_id bigint, doc_id bigint, score bigint"
        )
        # the rows of a query grow with the tasks: first the best of 64 shares of them
        some = _best(found.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(64))), k, "share").drop("rank")
        ranked = settle(_best(some, k).select("item_id", "rank", "doc_id", "score"), "ranked")
        out = ranked if out is None else out.union(ranked)
    if out is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out
