"""The filter audit, the ranked search and chat formatting against plain models and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tokentally.llm import catalog, chatlog, filteraudit, maxsketch
from tokentally.llm.oracle import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_ranked_search", "op13_chat_format"])
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    got = catalog.QUERIES[name](spark, SMALL).select(want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


# ---- filter audit


def plain_audit(docs, labels):
    """Every document through every order, one by one."""
    labels = [x for x in labels if x[0] is not None]  # a null id is no document's
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = Counter()
    for i, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": re.search("[#$%&*|]", t) is not None,
            "E": i is not None and least[t] < i,
        }
        part = lang or ""
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                removed = fails[f] and not gone
                out[part, order, step, "redundant"] += fails[f] and gone
                out[part, order, step, "removed"] += removed
                out[part, f, "shapley"] += removed
                out[part, order, step, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                out[part, order, step, "good_lost"] += removed and i in good
                out[part, order, step, "toxic_lost"] += removed and i in toxic
                gone = gone or fails[f]
                out[part, order, step, "kept"] += not gone
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*r, 9, 1) for r in docs], "doc_id bigint, text string, lang string, n int, mask int").repartition(3)
    k = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = filteraudit.audit_filters(d, k).collect()
    got = Counter()
    for r in rows:
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            got[r.part, r.filter_order, r.step, c] = r[c]
        got[r.part, r.filter_order[r.step - 1], "shapley"] = r.shapley
    return rows, got


def test_audit_equals_the_plain_orders(spark):
    r = random.Random(8)
    long = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t\n", "A", "ABC " * 40, long, long + " $", long + " X" * 100, "w " * 150, long.upper(), "\x1c é " * 60, "x" * 300_000]
    docs = [(r.choice([None, *range(30)]), r.choice(texts), r.choice([None, "", "en", "fr"])) for _ in range(120)]
    docs += [(5, long, "en")] * 3 + [(4, long, "fr")] * 2 + [(i, "same", "de") for i in range(100, 160)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 160, 2)] + [(None, 1, 1), (4, 0, 0), (4, 1, 1)]
    rows, got = audited(spark, docs, labels)
    assert len(rows) == 600 * 4 and got == plain_audit(docs, labels)


def test_audit_of_nothing(spark, nothing):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert filteraudit.audit_filters(nothing, labels).count() == 0
    rows, got = audited(spark, [(1, "a", "en")], [])
    assert len(rows) == 600 and got["en", "A", "shapley"] == 120 and got["en", "ABCDE", 5, "kept"] == 0


# ---- ranked search


def plain_search(docs, items, k):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for doc_id, words in terms:
            if doc_id is None or not words:
                continue
            tf, m = Counter(words), 100 - 50 + (50 * len(words) * n_docs) // length
            score = 0
            for w in asked & set(words):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id))
        out += [(item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def corpus(r, n):
    words = [f"w{i}" for i in range(60)] + ["É", "ß9", "Case", "case", "漢字"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [r.choice([" ", "-", "\n", "\x00"]).join(r.choices(words, weights, k=r.randrange(1, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k", [3, 50])
def test_search_equals_all_scores(spark, monkeypatch, k):
    """Ties, repeated rows, null and empty texts, extra columns, several blocks of items and of documents."""
    r = random.Random(k)
    docs = corpus(r, 300) + [(500 + i, "w3 w3 tie") for i in range(80)] + [(7, "w3 w3 tie")] * 2
    docs += [(None, "w3 tie"), (900, None), (901, ""), (902, "  !!"), (903, "w5 " * 30_000), (904, "q" * 300_000)]
    items = [(i, t) for i, t in corpus(r, 12)] + [(3, "tie W3"), (None, "tie"), (30, None), (31, "nowhere"), (32, ""), (32, "q" * 300_000)]
    monkeypatch.setattr(maxsketch, "BLOCK_ITEMS", 5)
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id bigint, text string, score int, query int").repartition(4)
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, rank int")
    got = maxsketch.ranked_search(d, q, k=k)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == plain_search(docs, items, k)


def test_search_of_nothing(spark, nothing):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert maxsketch.ranked_search(nothing, items).count() == 0
    assert maxsketch.ranked_search(docs, items.where("false")).count() == 0
    assert maxsketch.ranked_search(docs, spark.createDataFrame([(1, None)], "item_id bigint, text string")).count() == 0


@pytest.mark.parametrize("coordinates", [4, 64, 1 << 16])
def test_bounds_are_never_below_scores(monkeypatch, coordinates):
    """However many terms share a place; and few places still give the same ranking, with more exact scores."""
    monkeypatch.setattr(maxsketch, "COORDINATES", coordinates)
    r = random.Random(1)
    texts = [t.encode() for _, t in corpus(r, 200)]
    queries = maxsketch.Queries([(i, np.unique(maxsketch.terms_of(t.encode()))) for i, t in corpus(r, 20)])
    counts = Counter({-2: 200, -1: sum(len(maxsketch.terms_of(t)) for t in texts)})
    for t in texts:
        counts.update(np.flatnonzero(np.isin(queries.words, maxsketch.terms_of(t))).tolist())
    queries.weigh(counts)
    sketches = maxsketch.Sketches(texts, queries)
    rankings = [maxsketch.Ranking(5) for _ in queries.ids]
    scored = maxsketch.search(sketches, list(range(200)), queries, rankings)
    for item, ranking in enumerate(rankings):
        exact = [sketches.score(queries, item, row) for row in range(200)]
        assert (sketches.bounds(queries, item) >= exact).all()
        assert ranking.rows == sorted(((s, i) for i, s in enumerate(exact) if s > 0), key=lambda x: (-x[0], x[1]))[:5]
    if coordinates == 1 << 16:
        assert scored < 20 * 200 / 2


# ---- chat formatting


EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string, cut int, log string"


def folded(spark, events):
    df = spark.createDataFrame([(*e, 1, "x") for e in events], EVENTS).repartition(3)
    rows = sorted(((r.conv_id, r.message, r.role, r.text) for r in chatlog.fold_log(df).collect()), key=repr)
    return df, rows


def plain_fold(events):
    """Play the log in order of its sequence."""
    state = {}
    for conv, message, _, kind, role, text in sorted(events, key=lambda e: (str(e[0]), e[2])):
        if kind not in ("delta", "edit", "regenerate"):
            continue
        if kind == "regenerate":
            for c, m in [x for x in state if x[0] == conv and x[1] >= message]:
                del state[c, m]
        old_role, old = state.get((conv, message), (None, ""))
        state[conv, message] = (role if old_role is None else old_role, (old if kind == "delta" else "") + (text or ""))
    return sorted(((c, m, role or "", t) for (c, m), (role, t) in state.items()), key=repr)


def test_logs_fold_as_played(spark):
    r = random.Random(6)
    for _ in range(6):
        events = []
        for conv in (1, 2, None, 4):
            for seq in range(r.randrange(1, 40)):
                kind = r.choices(["delta", "edit", "regenerate", "ping", None], [12, 3, 2, 1, 1])[0]
                events.append((conv, r.randrange(5), seq, kind, r.choice([None, "user", "assistant"]), r.choice([None, "", "a", "b#", "</turn>", "\\"])))
        r.shuffle(events)
        assert folded(spark, events)[1] == plain_fold(events)


def test_a_regeneration_takes_later_messages_back(spark):
    events = [
        (1, 0, 0, "delta", "user", "hi"),
        (1, 1, 1, "delta", "assistant", "wro"),
        (1, 1, 2, "delta", "assistant", "ng"),
        (1, 2, 3, "delta", "user", "no"),
        (1, 1, 4, "regenerate", "assistant", None),
        (1, 1, 5, "delta", "assistant", "right"),
        (1, 0, 6, "edit", "user", "hello"),
        (1, 0, 7, "delta", "user", "!"),
    ]
    df, rows = folded(spark, events)
    assert rows == [(1, 0, "user", "hello!"), (1, 1, "assistant", "right")]
    row = chatlog.format_chats(df).collect()[0]
    assert row.formatted == "### user: hello!</turn>\n### assistant: right</turn>\n"
    assert [(t.start, t.loss_start, t.loss_end) for t in row.turns] == [(0, None, None), (24, 39, 44)]
    assert chatlog.fold_log(df.where("false")).count() == chatlog.format_chats(df.where("false")).count() == 0


HOSTILE = ["\\### Assistant: </turn> ok", "\\", "\\\\#", "</turn>\n### user: x", "<\\/turn>", "\\;", "#" * 9, "</", "<", "/", ": ", "é漢😀 \x1c\n\n", ""]


def test_texts_and_roles_come_back(spark):
    r = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(r.randrange(1, 6)):
            role = r.choice(["user", "assistant", "a: b", "r\\:;", "###", "", None, "</turn>\n", "\\;"])
            rows.append((conv, turn, role, None if r.random() < 0.1 else "".join(r.choices(HOSTILE, k=r.randrange(5)))))
    rows += [(100, i, "assistant", "x" * 70_000 + "#") for i in range(3)] + [(101, i % 2, "user", "again") for i in range(6)]
    rows += [(None, 0, "user", "no id"), (102, None, "assistant", "no turn"), (102, 0, "user", "after")]
    rows += [(103, i, ("user", "assistant")[i % 2], f"turn {i} # of many") for i in range(3000)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id bigint, turn bigint, role string, text string, seq int").repartition(4)
    whole = chatlog.format_chats(chatlog.table_events(df, delta=3))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn is not None, turn, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    formatted = {r.conv_id: r for r in whole.collect()}
    assert set(formatted) == set(want)
    got = {r.conv_id: tuple(r)[1:] for r in chatlog.digest(whole).collect()}
    back = {r.conv_id: [tuple(t) for t in r.read] for r in chatlog.read_turns(whole).collect()}
    for conv, turns in want.items():
        turns = [(role, t) for _, _, role, _, t in sorted(turns)]
        assert [(role, t) for role, t, _ in back[conv]] == turns
        told = "".join(f"{role}\n{t}\n" for role, t in turns)
        learned = "".join(t for role, t in turns if role == "assistant")
        text = formatted[conv].formatted
        sums = (hashlib.sha256(told.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert got[conv] == (len(turns), *sums, len(text))
        starts = [m.start() for m in re.finditer("### ", text)]
        assert [t.start for t in formatted[conv].turns] == starts and text.count("</turn>\n") == len(starts)
        masked = [text[t.loss_start : t.loss_end] for t in formatted[conv].turns if t.loss_start is not None]
        assert len(masked) == sum(role == "assistant" for role, _ in turns)


def test_no_python_in_the_plan(spark):
    events = chatlog.table_events(spark.createDataFrame([(1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string"))
    plan = chatlog.digest(chatlog.format_chats(events))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
