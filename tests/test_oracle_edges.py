"""The catalog queries and their oracle SQL also agree on edge-case texts
(CR, CRLF, blank and padded lines, empty and null texts), which the driver
tables do not contain."""

from __future__ import annotations

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from __spark_entry__ import oracle_sql, queries

EDGE_TEXTS = [
    "",
    None,
    "\n",
    "\r\n",
    "a\r\nb",
    "x\ry\r",
    "a\n\rb",
    " a  b  \n\n   \nc",
    "tab\there\tand there",
    "é ü  ñ",
    "License: MIT\nlicensed under the license\n",
    "  ",
    "trailing newline\n",
    "two trailing\n\n",
    "Unbounded Bound Bounded\r\n(x,y) 1,2",
    "a\u0085b c\u2028d\x0be\x0cf",
    "\u00a0 nbsp\u3000ideographic ",
    "\U0001f600 smile \U0001f600\n",
]

DOC_QUERIES = [
    "split_lines",
    "tokenize",
    "keyed_sum",
    "word_count_documents",
    "format_pairs",
    "text_scan",
    "sink_roundtrip",
    "filter_lines",
    "alnum_tokens",
    "filter_tokens",
    "any_match",
]


@pytest.fixture(scope="module")
def edge_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("edge_sf")
    table = pa.table({
        "doc_id": pa.array(range(len(EDGE_TEXTS)), pa.int64()),
        "text": pa.array(EDGE_TEXTS, pa.string()),
    })
    pq.write_table(table, d / "documents.parquet")
    return str(d)


def _canon(rows):
    return sorted(tuple("\0null" if v is None else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", DOC_QUERIES)
def test_edge_texts_match_oracle(spark, edge_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{edge_dir}/documents.parquet')")
    df = queries()[name](spark, edge_dir)
    rel = con.sql(oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    idx = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _canon(got) == _canon(want)


ALPHABET = ["a", "B", "é", "\U0001f600", " ", " ", "\t", "\n", "\r", "\u00a0", ",", "i", "c", "e", "n", "s", "l"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=40)), min_size=1, max_size=25))
def test_random_texts_match_oracle(spark, tmp_path_factory, texts):
    d = tmp_path_factory.mktemp("random_sf")
    pq.write_table(
        pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}),
        d / "documents.parquet",
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    for name in ["tokenize", "word_count_documents", "filter_lines", "alnum_tokens", "any_match"]:
        df = queries()[name](spark, str(d))
        rel = con.sql(oracle_sql()[name])
        cols = sorted(df.columns)
        got = [tuple(r[c] for c in cols) for r in df.collect()]
        idx = [rel.columns.index(c) for c in cols]
        want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
        assert _canon(got) == _canon(want), name
