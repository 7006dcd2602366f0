"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, and learned filters slide over the whole text. Overlapping chunks
(``CHUNK`` bytes, a new one every ``STEP``) each keep every filter's largest response;
a document's chunks are combined into their largest, mean and smallest of these, and a
small dense layer turns that, with the text's length, into one probability. All weights,
the filters included, are trained by back-propagation on a bounded sample of labelled
rows. Training and scoring cover every byte of a text alike; for the slope only the windows
are kept that gave a chunk's largest responses.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tokentally.llm.common import every_column, free_name, settle, ship_code, text_bytes

EMBED, WIDTH, FILTERS, HIDDEN = 8, 7, 16, 16
CHUNK, STEP = 1024, 768
#: Bounds of the training sample (rows, and bytes of their texts), training steps whatever its size, and the score
#: from which a text is good.
SAMPLE_ROWS, SAMPLE_BYTES, STEPS, GOOD_FROM = 4000, 64 << 20, 1250, 0.7
#: Bytes of text that training goes through at most, whatever it samples: samples of long texts get fewer steps.
TRAIN_BYTES, LEAST_STEPS = 512 << 20, 100
#: Weight decay.
DECAY = 1e-3
#: Texts are convolved this many chunk steps at a time.
STEPS_AT_ONCE = 64


def chunk_starts(n: int) -> np.ndarray:
    """Where chunks begin: every ``STEP`` bytes until one reaches the end."""
    return np.arange(0, max(1, n - (CHUNK - STEP)), STEP)


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = {
            "embed": r.normal(0, 0.5, (256, EMBED)),
            "taps": r.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH, EMBED, FILTERS)),
            "bias": np.zeros(FILTERS),
            "dense": r.normal(0, 1 / np.sqrt(3 * FILTERS + 2), (3 * FILTERS + 2, HIDDEN)),
            "out": r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN + 1),
        }

    def tables(self) -> np.ndarray:
        """Each tap's contribution for each byte: ``[WIDTH, 256, FILTERS]``."""
        return np.einsum("be,wef->wbf", self.w["embed"], self.w["taps"]).astype(np.float32)

    def responses(self, data: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Filter responses at each place; ``data`` ends with ``WIDTH - 1`` padding bytes."""
        n = len(data) - WIDTH + 1
        out = tables[0][data[:n]]
        for j in range(1, WIDTH):
            out += tables[j][data[j : j + n]]
        return out

    def _blocks(self, text: bytes, tables: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(data, edges, responses)`` of some chunks after another: ``edges`` are their ends among the responses."""
        data = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(WIDTH, np.uint8)])
        n = len(data) - WIDTH + 1
        starts = chunk_starts(n)
        for k in range(0, len(starts), STEPS_AT_ONCE):
            part = starts[k : k + STEPS_AT_ONCE]
            end = min(n, part[-1] + CHUNK)
            piece = data[part[0] : end + WIDTH - 1]
            yield piece, np.stack([part, np.minimum(part + CHUNK, end)], 1) - part[0], self.responses(piece, tables)

    def pooled(self, text: bytes, tables: np.ndarray) -> np.ndarray:
        """The largest responses of each chunk, ``[chunk, FILTERS]``, over the whole text."""
        out = []
        for _, edges, seen in self._blocks(text, tables):
            # reduceat's odd entries are the gaps between a chunk's end and the next one's start
            out.append(np.maximum.reduceat(np.concatenate([seen, seen[-1:]]), edges.ravel(), axis=0)[::2])
        return np.maximum(np.concatenate(out) + self.w["bias"], 0)

    def winners(self, text: bytes, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each chunk's largest responses with the bias, ``[chunk, FILTERS]``, and the windows that gave them, ``[.., WIDTH]``."""
        top, windows = [], []
        for data, edges, seen in self._blocks(text, tables):
            for a, b in edges.tolist():
                at = seen[a:b].argmax(0)
                top.append(seen[a:b][at, np.arange(FILTERS)])
                windows.append(data[a + at[:, None] + np.arange(WIDTH)])
        return np.stack(top) + self.w["bias"], np.stack(windows)

    def combine(self, pooled: np.ndarray, length: int) -> np.ndarray:
        extent = [np.log1p(length) / 8, 1.0]
        return np.concatenate([pooled.max(0), pooled.mean(0), pooled.min(0), extent])

    def probability(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.tanh(vectors @ self.w["dense"])
        return 1 / (1 + np.exp(-np.clip(hidden @ self.w["out"][:-1] + self.w["out"][-1], -30, 30)))

    def gradient(self, text: bytes, label: float, tables: np.ndarray, total: dict) -> None:
        """Add the slope of one document's log loss to ``total``."""
        w = self.w
        raw, bytes_at = self.winners(text, tables)  # [chunk, filter], [chunk, filter, tap]
        chunks = len(raw)
        pooled = np.maximum(raw, 0)
        x = self.combine(pooled, len(text))
        hidden = np.tanh(x @ w["dense"])
        p = 1 / (1 + np.exp(-np.clip(hidden @ w["out"][:-1] + w["out"][-1], -30, 30)))
        slope = p - label
        total["out"] += slope * np.append(hidden, 1)
        back = slope * w["out"][:-1] * (1 - hidden**2)
        total["dense"] += np.outer(x, back)
        dx = w["dense"] @ back
        d = np.repeat(dx[None, FILTERS : 2 * FILTERS] / chunks, chunks, 0)
        f = np.arange(FILTERS)
        d[pooled.argmax(0), f] += dx[:FILTERS]
        d[pooled.argmin(0), f] += dx[2 * FILTERS : 3 * FILTERS]
        d = d * (raw > 0)
        total["bias"] += d.sum(0)
        total["taps"] += np.einsum("cf,cfwe->wef", d, w["embed"][bytes_at])
        np.add.at(total["embed"], bytes_at, d[:, :, None, None] * w["taps"].transpose(2, 0, 1)[None])


def train(rows: list[tuple[bytes, int]], steps: int = STEPS, batch: int = 32, rate: float = 4e-3) -> Network:
    """Fit to ``(text, label)`` by Adam; the same rows give the same weights."""
    mean = sum(len(text) for text, _ in rows) / len(rows) + 1
    steps = min(steps, max(LEAST_STEPS, int(TRAIN_BYTES / (batch * mean))))
    net, r = Network(), np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < batch:
            order += r.permutation(len(rows)).tolist()
        some, order, tables = order[:batch], order[batch:], net.tables()
        total = {k: np.zeros_like(v) for k, v in net.w.items()}
        for i in some:
            net.gradient(*rows[i], tables, total)
        pace = rate * (1 - 0.9 * step / steps)
        for k, v in net.w.items():
            g = total[k] / len(some) + DECAY * v
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            v -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return net


def held_out(doc_id):
    """Whether a row's fold is never learned from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Train on labelled rows outside the held-out fold; ``None`` if there are none.

    The sample is the ``sample_rows`` ids of smallest hash among those with one
    quality label, 0 or 1, or equal ones; ids without a document are passed over. Of these, rows are
    taken, shortest texts first, as long as all texts together have ``sample_bytes`` at most.
    """
    ship_code(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    some = known.where("label = other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select("doc_id", "label")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    texts = texts.join(F.broadcast(some), "doc_id")  # at most sample_rows short rows
    texts = settle(texts.select("label", F.coalesce("text", F.lit("")).alias("text")), "sample")
    sizes = Counter(r["n"] for r in texts.select(F.octet_length("text").alias("n")).toLocalIterator())  # of the sampled rows
    longest, held = -1, 0
    for n in sorted(sizes):
        held += n * sizes[n]
        if held > sample_bytes:
            break
        longest = n
    rows = texts.where(F.octet_length("text") <= longest).collect()
    rows = sorted((r["text"].encode(), r["label"]) for r in rows)
    return train(rows) if rows else None


def _scored(net: Network | None, at: int):
    """Adds the scores of the texts in column ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if net and batch.num_rows:
                texts = text_bytes(batch.column(at))
                scores = net.probability(np.stack([net.combine(net.pooled(t, tables), len(t)) for t in texts]))
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def _with_score(docs: DataFrame, net: Network | None, name: str) -> DataFrame:
    """``docs`` with one more column: the score of the whole ``text``."""
    ship_code(docs.sparkSession)
    carried = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(every_column(docs))])
    kinds = [f.dataType for f in docs.schema] + [DoubleType()]
    schema = StructType([StructField(f"c{i}", kind) for i, kind in enumerate(kinds)])
    at = [c.lower() for c in docs.columns].index("text")
    return carried.mapInArrow(_scored(net, at), schema).toDF(*docs.columns, name)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``[doc_id, held_out, score, predicted]`` for every row of ``docs [doc_id, text]``.

    Learns from ``labels [doc_id, quality]`` (see ``fit``); the score depends on the
    text alone. A null text is scored as the empty one. Without labels every score is 0.5.
    Repeated rows and null ids (never held out) are carried along; other columns are
    ignored; an empty table gives an empty result.
    """
    net = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    rows = _with_score(rows, net, "score")
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier finds good, whole and with all their columns.

    A null text is scored as the empty one. Repeated rows and null ids are judged like any other; an empty
    table stays empty. Without labels nothing is known, and all rows stay.
    """
    net = fit(docs, labels)
    if net is None:
        return docs
    name = free_name(docs.columns, "quality_score")
    return _with_score(docs, net, name).where(F.col(name) >= GOOD_FROM).select(*every_column(docs))
