"""The driver contract of ``__spark_entry__``."""

from __future__ import annotations

from __spark_entry__ import entry, oracle_sql, queries


def test_oracle_keys_are_registered_queries():
    assert set(oracle_sql()) <= set(queries())
    from tokentally.plans.catalog import QUERIES

    assert set(QUERIES) <= set(oracle_sql())
    assert all(callable(fn) for fn in queries().values())


def test_entry_schema_is_stable(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.schema.simpleString() == "struct<word:string,cnt:bigint>"
