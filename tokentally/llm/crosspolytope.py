"""Embedding near-duplicates: cross-polytope hashing with fast Hadamard rotations.

A hash rotates the unit vector pseudo-randomly (three rounds of random signs and a
Walsh-Hadamard transform) and names the closest of the ``2 * d`` signed axes. A table
joins ``hashes`` such names into one bucket. Every vector is stored in one bucket of
each table and looks into ``probes`` buckets: its own and those that change one name to
the next-closest axis, in order of the lost projection. Equal vectors of one label are one
class throughout.

Candidate pairs never become rows. The vectors stored in a bucket and those that look
into it meet in blocks of bounded size, twice: first as 128 sign bits each, which leaves out, with
six standard deviations to spare, those that no other vector of the bucket is near; then, of the rest,
a block is verified as one matrix of cosines in double precision. Every vector carries its bucket names, so a block knows which of its
pairs another bucket has first, and counts only the rest: what it returns is one number of links
for each vector with any, and the edges of a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import settle, ship_code
from tokentally.llm.graph import connected_components

TABLES, HASHES, PROBES = 12, 2, 4

#: Stored vectors, and looking ones, of one bucket that meet in one block, about; as many bytes of them at most.
MEMBERS_HELD, BYTES_HELD = 1024, 8 << 20
#: Pairs whose signs are compared at once, about.
PAIRS_AT_ONCE = 1 << 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``x`` (a power of two long), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(d: int, table: int, number: int) -> np.ndarray:
    """The three sign vectors of one hash; fixed by its place."""
    return np.random.default_rng([d, table, number]).choice([-1.0, 1.0], (3, d))


def buckets(unit: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Bucket numbers ``[row, table, probe]``; probe 0 is the vector's own bucket."""
    n, d = unit.shape
    size = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    rows = np.arange(n)
    out = np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        names, losses, others = [], [], []
        for k in range(hashes):
            x = padded
            for signs in rotations(size, t, k):
                x = hadamard(x * signs)
            values = np.concatenate([x, -x], 1)  # name: axis, or size + axis for its negative
            order = np.argpartition(-values, min(probes, 2 * size - 1), axis=1)[:, : probes + 1]
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(values, order, 1), axis=1), 1)
            names.append(order[:, 0])
            others.append(order[:, 1:probes])
            losses.append(values[rows, order[:, 0]][:, None] - np.take_along_axis(values, order[:, 1:probes], 1))
        scale = [(2 * size) ** k for k in range(hashes)]
        own = sum(name * s for name, s in zip(names, scale))
        out[:, t, 0] = own
        moved = np.concatenate([own[:, None] + (o - name[:, None]) * s for o, name, s in zip(others, names, scale)], 1)
        best = np.argsort(np.concatenate(losses, 1), axis=1)[:, : probes - 1]
        out[:, t, 1:] = np.take_along_axis(moved, best, 1)
    return out


def sign_bits(unit: np.ndarray, tables: int) -> np.ndarray:
    """128 signs of two more rotations as two 64-bit numbers a row; near vectors differ in few."""
    n, d = unit.shape
    size = max(64, 1 << (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    out = np.empty((n, 2), np.int64)
    for k in range(2):
        x = padded
        for signs in rotations(size, tables, k):
            x = hadamard(x * signs)
        out[:, k] = np.packbits(x[:, :64] > 0, axis=1).view(np.int64)[:, 0]
    return out


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits 64-bit numbers differ."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def most_bits(threshold: float) -> float:
    """Signs in which two vectors at the threshold differ, and six standard deviations more."""
    share = np.arccos(np.clip(threshold, -1, 1)) / np.pi
    return 128 * share + 6 * np.sqrt(128 * share * (1 - share))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """The rows of ``x`` scaled to length 1, by way of a largest component of 1."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(tables: int, hashes: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(3)).to_numpy()
            for d in np.unique(lengths):
                rows = pa.array(np.flatnonzero(lengths == d))
                x = batch.column(3).take(rows).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)
                unit = unit_rows(x)
                codes = buckets(unit, tables, hashes, probes).reshape(len(rows), tables * probes)
                signs = sign_bits(unit, tables)
                ends = pa.array(np.arange(len(rows) + 1) * tables * probes, pa.int32())
                codes = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
                columns = [c.take(rows) for c in batch.columns]
                columns += [codes, pa.array(signs[:, 0]), pa.array(signs[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "label", "n", "vec", "codes", "s0", "s1"])

    return run


def _likely(most: float):
    """The members of each row's bucket that another of the other side is near by its signs, with the bucket's key."""
    names = ["label", "dim", "tab", "bucket", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in (4, 5):
                lists = batch.column(c)
                members = lists.flatten()
                fields = [members.field(f).to_numpy() for f in ("node", "s0", "s1")]
                sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
                sides.append((fields, sizes, np.cumsum(sizes) - sizes))
            (a, size_a, at_a), (b, size_b, at_b) = sides
            pairs = size_a * size_b
            part = np.cumsum(pairs) // PAIRS_AT_ONCE
            near_a, near_b = np.zeros(len(a[0]), bool), np.zeros(len(b[0]), bool)
            for some in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(part)) + 1):
                row = np.repeat(some, pairs[some])
                place = np.arange(len(row)) - np.repeat(np.cumsum(pairs[some]) - pairs[some], pairs[some])
                i, j = at_a[row] + place // size_b[row], at_b[row] + place % size_b[row]
                apart = differing(a[1][i], b[1][j]) + differing(a[2][i], b[2][j])  # 128 at most
                near = np.flatnonzero((apart <= most) & (a[0][i] != b[0][j]))
                near_a[i[near]] = True
                near_b[j[near]] = True
            rows = np.arange(len(pairs))
            rows = pa.array(np.concatenate([np.repeat(rows, size_a)[near_a], np.repeat(rows, size_b)[near_b]]))
            nodes = pa.array(np.concatenate([a[0][near_a], b[0][near_b]]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(rows) for c in range(4)], nodes], names=names)

    return run


class Block:
    """Vectors of one bucket: nodes, copies, unit vectors and bucket names ``[row, table, probe]``."""

    def __init__(self, members: pa.StructArray, probes: int):
        self.node = members.field("node").to_numpy()
        self.n = members.field("n").to_numpy()
        rows = len(members)
        self.unit = unit_rows(members.field("vec").flatten().to_numpy(zero_copy_only=False).reshape(rows, -1))
        self.codes = members.field("codes").flatten().to_numpy(zero_copy_only=False).reshape(rows, -1, probes)


def _meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the first bucket of each row of ``a [.., probe]`` is among those of ``b``."""
    return (a[..., :1] == b).any(-1)


def owned_links(stored: Block, looking: Block, table: int, bucket: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the links that this block counts: pairs of distinct nodes that no bucket before has.

    The buckets of a pair go by table, then by number; in one bucket a pair of two stored
    nodes goes by the smaller one's place among the stored.
    """
    i, j = np.nonzero(stored.unit @ looking.unit.T >= threshold)
    a, b = stored.node[i], looking.node[j]
    ca, cb = stored.codes[i], looking.codes[j]
    both = cb[:, table, 0] == bucket
    mine = np.where(both, a < b, True) & (a != b)
    mine &= ~(~both & (cb[:, table, 0] < bucket) & _meets(cb[:, table], ca[:, table]))
    if table:
        before_a, before_b = ca[:, :table], cb[:, :table]
        mine &= ~(_meets(before_a, before_b) | _meets(before_b, before_a)).any(1)
    return i[mine], j[mine]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """As few of the edges ``(a, b)`` as connect what all of them connect, each to its tree's root."""
    if not len(a):
        return []
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:  # hang every node below the smallest root among its neighbours', then follow the roots
        least = root.copy()
        np.minimum.at(least, root[x], root[y])
        np.minimum.at(least, root[y], root[x])
        while not np.array_equal(least[least], least):
            least = least[least]
        new = least[root]
        if np.array_equal(new, root):
            break
        root = new
    some = np.flatnonzero(root != np.arange(len(nodes)))
    return list(zip(nodes[some].tolist(), nodes[root[some]].tolist()))


def _linked(threshold: float, probes: int):
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, (table, bucket) in enumerate(zip(tables, numbers)):
                stored, looking = (Block(batch.column(c).slice(row, 1).flatten(), probes) for c in (2, 3))
                i, j = owned_links(stored, looking, table, bucket, threshold)
                if not len(i):
                    continue
                node = np.concatenate([stored.node[i], looking.node[j]])
                links = np.concatenate([looking.n[j], stored.n[i]])
                found, at = np.unique(node, return_inverse=True)
                out = [(int(x), None, int(n)) for x, n in zip(found, np.bincount(at, links).astype(np.int64))]
                out += [(x, y, None) for x, y in forest(stored.node[i], looking.node[j])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


KEY = ["label", "dim", "tab", "bucket"]


def _met(members: DataFrame, bytes_each, *fields: str) -> DataFrame:
    """``[KEY, s, l]``: the stored and the looking ``members [KEY, own, fields]`` of each bucket in blocks that meet.

    A block has about ``MEMBERS_HELD`` members, or as many as ``BYTES_HELD`` allows. Buckets without a pair are left out.
    """
    sizes = members.groupBy(*KEY).agg(F.count(F.lit(1)).alias("looking"), F.count_if("own").alias("stored"))
    busy = members.join(settle(sizes.where("looking > 1 and stored > 0"), "busy"), KEY)
    held = F.greatest(F.lit(1), F.least(F.lit(MEMBERS_HELD), F.floor(F.lit(BYTES_HELD) / bytes_each)))

    def side(rows: DataFrame, size: str, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col(size) / held)).alias("part")
        return rows.groupBy(*KEY, part).agg(F.collect_list(F.struct(*fields)).alias(name)).drop("part")

    return side(busy.where("own"), "stored", "s").join(side(busy, "looking", "l"), KEY)


def embedding_links(classes: DataFrame, *, threshold: float, tables: int, hashes: int, probes: int) -> DataFrame:
    """``[node, other, links]``: what the links of ``classes [node, label, vec, n]`` add up to.

    Rows without ``other`` are numbers of links (copies of linked classes, ``n``) to be summed for each
    node, the others are edges that connect every two linked nodes. Vectors are brought only to buckets where
    another one is near by its signs.
    """
    hashed = classes.select("node", "label", "n", "vec").mapInArrow(
        _hashed(tables, hashes, probes),
        "node bigint, label bigint, n bigint, vec array<double>, codes array<bigint>, s0 bigint, s1 bigint",
    )
    coded = settle(hashed.withColumn("dim", F.size("vec").cast("bigint")), "codes")
    looks = coded.select("label", "dim", "node", "s0", "s1", F.posexplode("codes").alias("at", "bucket"))
    looks = looks.withColumn("tab", F.expr(f"at div {probes}")).withColumn("own", F.expr(f"at % {probes} = 0"))
    signs = _met(looks, F.lit(24), "node", "s0", "s1").select(*KEY, "s", "l")
    likely = signs.mapInArrow(_likely(most_bits(threshold)), "label bigint, dim bigint, tab bigint, bucket bigint, node bigint")
    likely = settle(likely.distinct(), "likely")
    members = likely.join(coded.select("node", "n", "vec", "codes"), "node")
    members = settle(members.withColumn("own", F.expr(f"codes[int(tab * {probes})] = bucket")), "members")
    met = _met(members, 8 * (F.col("dim") + F.size("codes")), "node", "n", "vec", "codes").select("tab", "bucket", "s", "l")
    return settle(met.mapInArrow(_linked(threshold, probes), "node bigint, other bigint, links bigint"), "linked")


def embedding_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = 0.93,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
) -> DataFrame:
    """``[vec_id, n_links, component_id, kept]`` for each row of ``vectors [vec_id, embedding, label]``.

    Only vectors of one label (not null) and one length are compared. A vector that
    is null, empty, all zero, or holds a null or a non-finite component links with
    nothing. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest ``vec_id`` reachable. Equal vectors count as rows but are hashed and
    compared once. Repeated ids are separate rows; a null id is linked but is never
    the smallest unless all are null. Other columns are ignored; an empty table gives
    an empty result.
    """
    ship_code(vectors.sparkSession)
    rows = settle(
        vectors.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("vec"),
        ).withColumn("vec", F.expr("transform(vec, x -> if(x = 0, 0D, x))")),  # -0.0 equals 0.0
        "vectors",
    )
    usable = F.expr(
        "label is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    usable = F.coalesce(usable, F.lit(False))
    classes = rows.where(usable).groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    linked = embedding_links(
        classes.select("node", "label", "vec", "n"), threshold=threshold, tables=tables, hashes=hashes, probes=probes
    )
    comps = connected_components(linked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    others = linked.where("other is null").groupBy("node").agg(F.sum("links").alias("others"))
    reach = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    reach = settle(reach.select("label", "vec", "node", "n", "least", "comp"), "reach")
    smallest = settle(reach.groupBy("comp").agg(F.min("least").alias("component_id")), "smallest")
    known = settle(
        reach.join(smallest, "comp")
        .join(others, "node", "left")
        .select("label", "vec", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"),
        "known",
    )
    out = rows.where(usable).join(known, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
