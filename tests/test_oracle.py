"""Golden queries: every catalog query with an oracle equals DuckDB at sf0.01
(rows, column names, column types and values, order-insensitive)."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from support import SF001, SF0001
from tokentally.plans.oracle import ORACLE_SQL

TABLES = ["documents", "conversations", "pages", "part", "benchmark"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module", params=[SF001, SF0001], ids=["sf0.01", "sf0.001"])
def duck(request):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{request.param}/{t}.parquet')")
    yield con, request.param
    con.close()


def _canon(rows):
    return sorted(tuple("\0null" if v is None else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    con, sf_dir = duck
    df = queries()[name](spark, sf_dir)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    spark_types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    idx = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() == 27782
    assert df.agg({"cnt": "sum"}).collect()[0][0] == 79047
