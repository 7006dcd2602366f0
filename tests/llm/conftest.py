from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"

LONG = ("word%d of the long text. " * 1).join(str(i) for i in range(12_000))
BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, BASE),
    (4, BASE),  # a repeated row
    (5, BASE),  # an exact copy
    (6, BASE + " tail"),  # a near copy
    (7, "one"),
    (8, "x" * 300_000),
    (9, LONG),
    (10, "naïve café  Ünïcode 漢字 W̊ <|endoftext|> don't I'LL 3½ \x1c end."),
    (11, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" mail a.b@c.org or +1 (017) 555-7713 at 10.0.0.256'),
    (None, "a row without an id"),
    (None, BASE + " tail"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge cases, with extra columns whose names operators use themselves."""
    rows = [(i, t, "en", "src", len(t or ""), 1, "x", 0.5, None) for i, t in ROWS]
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "node int, content string, score double, kept boolean"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
