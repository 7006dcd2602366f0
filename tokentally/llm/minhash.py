"""Near-duplicates: one-permutation hashing with optimal densification.

Each set of word shingles is hashed once; the hash range is cut into
``bands * rows`` bins and a bin keeps its smallest hash. An empty bin borrows from
the first non-empty one in a fixed random order of its own (optimal densification).
Documents of equal sets become one class first. Classes that agree on all rows of a
band share a bucket; a bucket links each member to one centre (a star), never all
pairs. Links are confirmed on the full sets.

A star can miss a link between two members that its centre resembles less. So the
buckets whose members still lie in different components get further centres: four,
then one for each component in the bucket, then four for each, sixteen and so on. Only pairs across components are
compared, until every component but one has had all its members as centres or the
bucket is one component. No pair that shares a
bucket stays untested unless its two classes are connected already. From one centre
for each component on, members meet centres in blocks of bounded size, and only the
pairs of a block that pass a first test become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import settle, ship_code, text_bytes
from tokentally.llm.graph import connected_components
from tokentally.llm.hashing import mix, shingle_set

#: A link at the threshold 0.8 shares a band with probability 1 - (1 - 0.8**7)**40 = 0.99992.
BANDS, ROWS = 40, 7

#: Members and centres of one bucket that meet in one row, about. Each takes 1 KB at most.
MEMBERS_HELD, CENTRES_HELD = 64, 32

#: Bytes of text whose sets a task keeps while it confirms links.
SETS_HELD = 8 << 20

_orders: dict[int, np.ndarray] = {}


def _donor_order(bins: int) -> np.ndarray:
    """For each bin, the rank of every other bin as its donor: fixed random orders."""
    if bins not in _orders:
        _orders[bins] = np.random.default_rng(bins).random((bins, bins)).argsort(1).astype(np.int32)
    return _orders[bins]


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """One minimum for each bin; ``shingles`` are sorted, distinct and not empty."""
    where = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1])
    full = where[first].astype(np.int64)
    values = np.zeros(bins, np.uint64)
    values[full] = shingles[first]
    if len(full) < bins:
        empty = np.setdiff1d(np.arange(bins), full, assume_unique=True)
        donor = full[_donor_order(bins)[np.ix_(empty, full)].argmin(1)]
        values[empty] = values[donor]
    return values


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = signature(shingles, bands * rows).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + values[:, r])
    return key.view(np.int64)


def set_name(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))]
        )
        for batch in batches:
            sets = [shingle_set(t, size) for t in text_bytes(batch.column(1))]
            keys = [band_keys(s, bands, rows).tolist() if len(s) else [] for s in sets]
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_name(s) for s in sets], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _marks(shingles: np.ndarray, bins: int, percent: int) -> tuple[bytes, bytes]:
    """What pairs are tested by first: a long set's signature bytes, a short set's 16-bit values.

    Sets between ``bins`` and the size that a set of ``bins`` members can be linked with have both.
    """
    long, short = len(shingles) > bins, percent * len(shingles) <= 100 * bins
    sketch = signature(shingles, bins).astype(np.uint8).tobytes() if long else b""
    return sketch, np.unique(shingles.astype(np.uint16)).tobytes() if short else b""


def _named(size: int, bins: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size) for t in text_bytes(batch.column(0))]
            marks = [_marks(s, bins, percent) for s in sets]
            columns = [
                pa.array([set_name(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([m[0] for m in marks], pa.binary()),
                pa.array([m[1] for m in marks], pa.binary()),
                batch.column(0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "sketch", "low", "text"])

    return run


def _most_shared(low_a: list[bytes], low_b: list[bytes], na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """For each pair, a bound that the size of its intersection never exceeds.

    The 16-bit values that both sets hold, and as many more as values of the one set
    stand for two of its members.
    """
    rows = np.arange(len(na), dtype=np.int64)
    keys, spare = [], []
    for low, n in ((low_a, na), (low_b, nb)):
        held = np.array([len(v) // 2 for v in low], np.int64)
        keys.append((np.repeat(rows, held) << 16) | np.frombuffer(b"".join(low), np.uint16))
        spare.append(n - held)
    merged = np.sort(np.concatenate(keys), kind="stable")
    both = merged[1:][merged[1:] == merged[:-1]] >> 16
    return np.bincount(both, minlength=len(na)) + np.minimum(*spare)


def _least_agreeing(percent: int, bins: int) -> float:
    """Share of signature bytes that agree in a link of two long sets, less five standard deviations.

    At the threshold each byte agrees with that probability at least; less than one
    link in a million falls short.
    """
    share = percent / 100
    return share - 5 * np.sqrt(share * (1 - share) / bins)


def _likely(percent: int, bins: int):
    """Keeps pairs of sets of sizes that allow a link unless a small test rules the link out.

    Short sets go by a bound of their intersection, so no link is lost. Long ones go by
    the lower bytes of their signatures.
    """
    least = _least_agreeing(percent, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch_a, sketch_b, low_a, low_b = (batch.column(c).to_pylist() for c in range(4, 8))
            na, nb = (batch.column(c).to_numpy() for c in (8, 9))
            keep = np.zeros(batch.num_rows, bool)
            short = np.minimum(na, nb) <= bins
            rows = np.flatnonzero(short)
            if len(rows):
                shared = _most_shared([low_a[i] for i in rows], [low_b[i] for i in rows], na[rows], nb[rows])
                keep[rows] = 100 * shared >= percent * (na[rows] + nb[rows] - shared)
            rows = np.flatnonzero(~short)
            if len(rows):
                a, b = (np.frombuffer(b"".join([s[i] for i in rows]), np.uint8).reshape(-1, bins) for s in (sketch_a, sketch_b))
                keep[rows] = (a == b).mean(1) >= least
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=["a", "b", "ca", "cb"]).filter(pa.array(keep))

    return run


def _shared_low(a: pa.StructArray, b: pa.StructArray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """``_most_shared`` of every member of ``a`` with every one of ``b``, as a matrix."""
    lows = a.field("low").to_pylist() + b.field("low").to_pylist()
    held = np.array([len(v) // 2 for v in lows], np.int64)
    values, code = np.unique(np.frombuffer(b"".join(lows), np.uint16), return_inverse=True)
    has = np.zeros((len(lows), len(values)), np.float32)
    has[np.repeat(np.arange(len(lows)), held), code] = 1
    spare = np.concatenate([na, nb]) - held
    return (has[: len(a)] @ has[len(a) :].T).astype(np.int64) + np.minimum.outer(spare[: len(a)], spare[len(a) :])


def _likely_in_blocks(percent: int, bins: int):
    """The pairs that ``_likely`` would keep of each centre of a block with each member of another component."""
    least = _least_agreeing(percent, bins)

    def sketches(block: pa.StructArray) -> np.ndarray:
        held = [s or bytes(bins) for s in block.field("sketch").to_pylist()]
        return np.frombuffer(b"".join(held), np.uint8).reshape(-1, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                na, nb = (x.field("n").to_numpy() for x in (a, b))
                comps = pa.concat_arrays([a.field("comp"), b.field("comp")]).dictionary_encode().indices.to_numpy()
                smaller, larger = np.minimum.outer(na, nb), np.maximum.outer(na, nb)
                keep = np.not_equal.outer(comps[: len(a)], comps[len(a) :]) & (percent * larger <= 100 * smaller)
                short = smaller <= bins
                if (keep & short).any():
                    shared = _shared_low(a, b, na, nb)
                    keep &= ~short | (100 * shared >= percent * (smaller + larger - shared))
                if (keep & ~short).any():
                    sa, sb = sketches(a), sketches(b)
                    agree = np.stack([(row == sb).mean(1) for row in sa])
                    keep &= short | (agree >= least)
                x, y = (pa.array(k) for k in np.nonzero(keep))
                if len(x):
                    columns = [a.field("node").take(x), b.field("node").take(y), a.field("comp").take(x), b.field("comp").take(y)]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "ca", "cb"])

    return run


def _blocks(rows: DataFrame, marks: DataFrame, held: int, name: str) -> DataFrame:
    """``[bucket, name]``: the ``rows [bucket, node, comp]`` of each bucket with their marks, dealt into arrays of about ``held``."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("in_bucket") / held)).alias("part")
    block = F.collect_list(F.struct("node", "comp", "n", "sketch", "low")).alias(name)
    dealt = rows.join(sizes, "bucket").select("bucket", "node", "comp", part).join(marks, "node")
    return dealt.groupBy("bucket", "part").agg(block).drop("part")


def _links(size: int, percent: int):
    """Components of the pairs of texts whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        held = 0

        def of(text: bytes) -> np.ndarray:
            nonlocal held
            if text not in seen:
                if held > SETS_HELD:
                    seen.clear()
                    held = 0
                seen[text] = shingle_set(text, size)
                held += len(text)
            return seen[text]

        for batch in batches:
            keep = []
            for ta, tb in zip(text_bytes(batch.column(0)), text_bytes(batch.column(1))):
                x, y = of(ta), of(tb)
                if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                    keep.append(False)
                    continue
                merged = np.sort(np.concatenate([x, y]))
                both = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * both >= percent * (len(merged) - both))
            links = pa.RecordBatch.from_arrays([batch.column(2), batch.column(3)], names=["a", "b"])
            yield links.filter(pa.array(keep, pa.bool_()))

    return run


def _few_tasks(joined: DataFrame) -> DataFrame:
    """``joined`` in as many tasks as the session shuffles to, at most.

    Adaptive execution cuts the partitions of a frequent key into many pieces. A Python task
    takes some 50 ms whatever it reads, so pieces are dealt to tasks, neighbours together.
    """
    return joined.coalesce(int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``[doc_id, n_shingles, component_id, kept]`` for every row of ``docs [doc_id, text]``.

    Documents are linked when ``100 * intersection >= percent * union`` of their
    sets. ``component_id`` is the smallest ``doc_id`` reachable by links, itself
    included; ``kept`` says that it is the row's own. A null, empty or blank text
    has the empty set and is linked with nothing. Repeated rows each get a result,
    and rows of one ``doc_id`` and different texts are separate nodes. A null
    ``doc_id`` is linked like any other and is never the smallest unless all are
    null. Other columns are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    sig = settle(
        docs.mapInArrow(
            _signatures(shingle_words, bands, rows), "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>"
        ),
        "signatures",
    )
    own = sig.where("node is not null")
    classes = settle(own.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")), "classes")
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    shared = settle(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared")
    members = settle(placed.join(shared, "bucket").select("bucket", "node"), "members")
    needed = members.select("node").distinct().join(classes.select("node", "doc_id"), "node")
    needed = settle(needed, "needed")
    texts = settle(_needed_texts(docs, needed, shingle_words, bands * rows, percent), "texts")
    comps = _components(members, needed, texts, shingle_words, percent, bands * rows)
    reach = classes.select("node", F.col("doc_id").alias("least")).join(comps, "node", "left")
    reach = settle(reach.select("node", "least", F.coalesce("comp", "node").alias("comp")), "reach")
    smallest = settle(reach.groupBy("comp").agg(F.min("least").alias("component_id")), "smallest")
    named = settle(reach.join(smallest, "comp").select("node", "component_id"), "named")
    linked = own.select("doc_id", "n_shingles", "node").join(named, "node").select("doc_id", "n_shingles", "component_id")
    alone = sig.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _needed_texts(docs: DataFrame, needed: DataFrame, size: int, bins: int, percent: int) -> DataFrame:
    """``[node, n, sketch, low, text]``: one text for each class that shares a bucket with another."""
    ids = needed.where("doc_id is not null").select("doc_id").distinct()
    texts = docs.join(ids, "doc_id", "left_semi").select("text")
    if not needed.where("doc_id is null").isEmpty():  # classes of rows without an id
        texts = texts.union(docs.where("doc_id is null").select("text"))
    named = texts.mapInArrow(_named(size, bins, percent), "node binary, n bigint, sketch binary, low binary, text string")
    return named.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _components(members: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int, bins: int) -> DataFrame:
    """``[node, comp]`` over the classes ``nodes`` that share buckets; stars until nothing is left to test."""
    assigned = nodes.select("node", F.col("node").alias("comp"))
    members = members.withColumn("comp", F.col("node")).withColumn("done", F.lit(False))
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    sa, sb = (
        texts.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("sketch", "low", "n"))) for x in "ab"
    )
    marks = texts.select("node", "n", "sketch", "low")
    possible = F.greatest("n_a", "n_b") * percent <= F.least("n_a", "n_b") * 100
    schedule = [(1, []), (4, [])]  # centres of each bucket, before those of each component in it
    while True:
        wanted, per = schedule.pop(0) if schedule else (int(4 * wanted), ["comp"])
        part = F.pmod(F.xxhash64("node", F.lit(wanted)), F.lit(wanted)).alias("part")
        least = F.min(F.struct("node", "comp")).alias("c")
        centres = settle(
            members.where("not done").groupBy("bucket", *per, part).agg(least).select("bucket", "c.*"), "centres"
        )
        found = "a binary, b binary, ca binary, cb binary"
        if per:
            held = _blocks(members, marks, MEMBERS_HELD, "members").join(_blocks(centres, marks, CENTRES_HELD, "centres"), "bucket")
            held = _few_tasks(held.select("centres", "members"))
            pairs = held.mapInArrow(_likely_in_blocks(percent, bins), found).distinct()
        else:
            star = centres.select("bucket", F.col("node").alias("a"), F.col("comp").alias("ca"))
            pairs = settle(
                members.join(star, "bucket")
                .where("comp <> ca")
                .select("a", F.col("node").alias("b"), "ca", F.col("comp").alias("cb"))
                .distinct(),
                "pairs",
            )
            marked = (
                pairs.join(sb, "b")
                .join(sa, "a")
                .where(possible)
                .select("a", "b", "ca", "cb", "sketch_a", "sketch_b", "low_a", "low_b", "n_a", "n_b")
            )
            pairs = _few_tasks(marked).mapInArrow(_likely(percent, bins), found)
        pairs = settle(pairs, "likely")
        whole = pairs.join(tb, "b").join(ta, "a").select("text_a", "text_b", "ca", "cb")
        links = settle(_few_tasks(whole).mapInArrow(_links(size, percent), "a binary, b binary"), "links")
        now = members.select("bucket", "node", "comp", "done")
        if not links.isEmpty():
            merged = connected_components(links).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
            into = F.coalesce("into", "comp").alias("comp")
            assigned = settle(assigned.join(merged, "comp", "left").select("node", into), "assigned")
            now = now.join(merged, "comp", "left").select("bucket", "node", into, "done")
        served = centres.select("bucket", "node", F.lit(True).alias("served"))
        now = now.join(served, ["bucket", "node"], "left").select(
            "bucket", "node", "comp", (F.col("done") | F.coalesce("served", F.lit(False))).alias("done")
        )
        now = settle(now, "members")
        left = now.where("not done").groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
        # a bucket with one member that was no centre yet has met all its centres
        members = settle(now.join(settle(left.where("x <> y").select("bucket"), "left"), "bucket", "left_semi"), "members")
        if members.isEmpty():
            return assigned
        if not schedule and not per:
            wanted = 0.25


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, whole and with all their columns.

    Of rows that repeat an id and its text one stays. Rows without an id stay, as
    nothing names them.
    """
    found = near_duplicates(docs, **settings)
    ids = settle(found.where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    named = docs.join(ids, docs["doc_id"].cast("bigint") == ids["doc_id"], "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id is null"))
