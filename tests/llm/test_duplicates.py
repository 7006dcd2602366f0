"""Near-duplicates of texts and vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from tokentally.llm import crosspolytope, graph, minhash


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def all_pairs(rows, k):
    """Smallest id over each component, by comparing every two rows."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(
        ((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize("words", [2, 5])
@pytest.mark.parametrize("which", ["edge", "small"])
def test_near_duplicates(request, which, words):
    docs = request.getfixturevalue(which)
    got = minhash.near_duplicates(docs, shingle_words=words)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == all_pairs(rows, words)


def test_chains_are_followed(spark):
    """Each text is near the next one only; the stars' centres are near none of many members."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(50)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle_words=2)
    assert sorted(map(tuple, got.collect()), key=repr) == all_pairs(rows, 2)


def test_pieces_of_a_frequent_key_share_tasks(spark, monkeypatch):
    """A large group of near copies is cut into many pieces; Python steps run in no more tasks than a shuffle has."""
    files, settle = {}, minhash.settle

    def counted(df, name):
        written = settle(df, name)
        files[name] = max(files.get(name, 0), len(written.inputFiles()))
        return written

    monkeypatch.setattr(minhash, "settle", counted)
    adaptive = "spark.sql.adaptive."
    conf = {
        adaptive + "coalescePartitions.enabled": "false",
        adaptive + "advisoryPartitionSizeInBytes": "1k",
        adaptive + "skewJoin.skewedPartitionThresholdInBytes": "1k",
        adaptive + "skewJoin.skewedPartitionFactor": "1.01",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "32k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    words = [f"{i * 7919:x}" for i in range(900)]
    rows = [(i, " ".join([*words, f"own{i}"])) for i in range(300)] + [(300, "another text")]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle_words=2).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: 0 if i < 300 else 300 for i in range(301)}
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert files["likely"] <= shuffled and files["links"] <= shuffled


def test_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


def test_one_row_stays(edge):
    kept = minhash.keep_one(edge, shingle_words=2)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 7, 8, 9, 10, 11]
    assert ids.count(None) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 300)]
    got = {r.node: r.comp for r in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and got[100] == got[200] != got[0]
    assert graph.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    loops = graph.connected_components(spark.createDataFrame([(1, 1), (2, 2)], "a bigint, b bigint"))
    assert sorted(map(tuple, loops.collect())) == [(1, 1), (2, 2)]


def test_components_write_few_tables(spark, monkeypatch):
    """One round of one path: its edges, parents, their roots, the labels and the edges left; no table of nodes without work."""
    names, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, name: (names.append(name), settle(df, name))[1])
    got = graph.connected_components(spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 1)]
    assert names == ["edges", "parents", "jumped", "labels", "edges"]


def vectors():
    r = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            centre = r.normal(size=64)
            for _ in range(4):
                rows.append((n, (centre + r.normal(size=64) * 0.2).tolist(), label))
                n += 1
    rows += [(n + i, v, 0) for i, v in enumerate([None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [1e300] * 64, [1.0] * 64, [-0.0, 1.0], [0.0, 1.0]])]
    return rows + [rows[0], rows[0], (n + 50, rows[0][1], 0)]


def test_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id bigint, embedding array<double>, label int, node int")
    got = crosspolytope.embedding_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    up, links = list(range(len(rows))), [0] * len(rows)

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v) / np.abs(v).max()
        return a / np.linalg.norm(a)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    units = [unit(v) for _, v, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] is not None and rows[i][2] == rows[j][2] and a @ b >= 0.93:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (v, _, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), v), v)
    want = sorted((v, links[i], least[root(i)], v == least[root(i)]) for i, (v, _, _) in enumerate(rows))
    assert sorted(map(tuple, got.collect())) == want
    assert crosspolytope.embedding_duplicates(df.where("false")).count() == 0


def near_pairs(r, d, cosine, n):
    """Pairs of unit vectors at exactly this cosine."""
    a = r.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=(n, d))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize("d", [3, 32, 64, 384])
def test_signs_lose_no_pair_at_the_threshold(d):
    a, b = near_pairs(np.random.default_rng(d), d, 0.93, 3000)
    x, y = crosspolytope.sign_bits(a, 12), crosspolytope.sign_bits(b, 12)
    apart = crosspolytope.differing(x, y).sum(1, dtype=int)
    assert apart.max() <= crosspolytope.most_bits(0.93)
    if d >= 32:
        assert (crosspolytope.differing(x[1:].copy(), y[:-1].copy()).sum(1, dtype=int) <= crosspolytope.most_bits(0.93)).mean() < 0.02


def test_blocks_count_each_pair_once(spark, monkeypatch):
    """A group of near copies dealt into many small blocks; counts are exact, rows are few."""
    monkeypatch.setattr(crosspolytope, "MEMBERS_HELD", 16)
    r = np.random.default_rng(4)
    centre = r.normal(size=64)
    group = centre + r.normal(size=(150, 64)) * 0.25  # some pairs link, some do not
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*group, *r.normal(size=(100, 64))])]
    got = {x.vec_id: x.n_links for x in crosspolytope.embedding_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    units = np.array([np.array(v) / np.linalg.norm(v) for _, v, _ in rows])
    links = (units @ units.T >= 0.93).sum(1) - 1
    assert 0 < links[:150].mean() < 149 and [got[i] for i in range(250)] == links.tolist()


def test_a_forest_connects_what_its_edges_do():
    r = np.random.default_rng(6)
    for n in (2, 10, 200):
        a, b = r.integers(0, n, (2, n // 2 + 1)) * 7
        edges = crosspolytope.forest(a, b)
        assert len(edges) < len(set(a) | set(b))

        def parts(pairs):
            up = {int(x): int(x) for x in [*a, *b]}

            def root(x):
                while up[x] != x:
                    x = up[x]
                return x

            for x, y in pairs:
                x, y = sorted((root(int(x)), root(int(y))))
                up[y] = x
            return {x: root(x) for x in up}

        assert parts(edges) == parts(zip(a, b))


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = crosspolytope.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(crosspolytope.hadamard(y), x)


def test_shared_bound_loses_no_link():
    """The bound of the intersection is never below it, and rarely above it."""
    r = np.random.default_rng(3)
    pool = r.integers(1, 1 << 63, 400, dtype=np.uint64)
    pool[:40] = (pool[:40] >> np.uint64(16) << np.uint64(16)) + pool[40:80] % np.uint64(1 << 16)  # equal low bits
    sets = [np.unique(r.choice(pool, n)) for n in r.integers(1, 300, 60)]
    a, b = sets[:30], sets[30:]
    low = [[minhash._marks(s, 280, 80)[1] for s in x] for x in (a, b)]
    sizes = [np.array([len(s) for s in x]) for x in (a, b)]
    true = np.array([len(np.intersect1d(x, y)) for x, y in zip(a, b)])
    got = minhash._most_shared(*low, *sizes)
    assert (got >= true).all()
    assert (got - true).max() <= 60


@pytest.mark.parametrize("bins", [8, 40])
def test_blocks_keep_the_pairs_that_pairs_alone_keep(bins):
    """Short sets, long ones and both in a block; pairs of one component are left out."""
    import pyarrow as pa

    draw = np.random.default_rng(bins)
    base = draw.integers(1, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: 10 + 5 * (i % 9)], draw.integers(1, 1 << 63, i % 7, dtype=np.uint64)])) for i in range(40)]
    marks = [minhash._marks(s, bins, 80) for s in sets]
    rows = [
        {"node": b"n%d" % i, "comp": b"c%d" % (i % 11), "n": len(s), "sketch": m[0], "low": m[1]}
        for i, (s, m) in enumerate(zip(sets, marks))
    ]
    member = pa.struct([("node", pa.binary()), ("comp", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary()), ("low", pa.binary())])
    blocks = [pa.array([rows[:3], rows[:15]], pa.list_(member)), pa.array([rows[30:], rows[15:]], pa.list_(member))]
    batch = pa.RecordBatch.from_arrays(blocks, names=["centres", "members"])
    got = [tuple(r.values()) for out in minhash._likely_in_blocks(80, bins)([batch]) for r in out.to_pylist()]
    pairs = [(x, y) for a, b in ((rows[:3], rows[30:]), (rows[:15], rows[15:])) for x in a for y in b]
    pairs = [(x, y) for x, y in pairs if x["comp"] != y["comp"] and 80 * max(x["n"], y["n"]) <= 100 * min(x["n"], y["n"])]
    columns = [pa.array([p[k][c] for p in pairs]) for c, k in (
        ("node", 0), ("node", 1), ("comp", 0), ("comp", 1), ("sketch", 0), ("sketch", 1), ("low", 0), ("low", 1), ("n", 0), ("n", 1)
    )]
    alone = pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(10)])
    want = [tuple(r.values()) for out in minhash._likely(80, bins)([alone]) for r in out.to_pylist()]
    assert want and sorted(got) == sorted(want)
