"""Physical plan shape of the catalog queries: pruned scans, partial
aggregates before the exchange, no Python evaluation, one plan at every size."""

from __future__ import annotations

import pytest
from support import SF001, explain_text
from pyspark.errors import AnalysisException
from tokentally.plans.catalog import QUERIES
from tokentally.sources.tables import read_table


def test_word_count_plan(spark):
    plan = explain_text(QUERIES["word_count_documents"](spark, SF001))
    assert "ReadSchema: struct<text:string>" in plan
    assert "partial_count(1)" in plan
    assert "hashpartitioning(word" in plan
    assert "EvalPython" not in plan


def test_every_query_plan_is_jvm_only(spark):
    skip = {"text_scan", "sink_roundtrip", "result_manifest_rows", "timed_word_count_rows"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        plan = explain_text(fn(spark, SF001))
        assert "EvalPython" not in plan, name
        assert "ReadSchema: struct<" in plan, name


def test_filter_lines_prunes_columns(spark):
    plan = explain_text(QUERIES["filter_lines"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_one_plan_at_every_size_and_core_count(spark, tmp_path):
    import re

    def shape(sf_dir):
        plan = explain_text(QUERIES["word_count_documents"](spark, sf_dir), "simple")
        return re.sub(r"#\d+L?|plan_id=\d+|file:\S+|Location.*", "", plan).split("FileScan")[0]

    wide = tmp_path / "documents.parquet"
    spark.read.parquet(f"{SF001}/documents.parquet").repartition(16).write.parquet(str(wide))
    shapes = {shape(d) for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.1", str(tmp_path))}
    assert len(shapes) == 1
    assert "RoundRobinPartitioning" not in shapes.pop()


def test_spread_is_the_callers_choice(spark):
    path = f"{SF001}/documents.parquet"
    assert "Exchange" not in explain_text(read_table(spark, path, "text"))
    assert "RoundRobinPartitioning(3)" in explain_text(read_table(spark, path, "text", spread=3))


def test_missing_column_raises(spark, tmp_path):
    spark.createDataFrame([("a",)], "body string").write.parquet(str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        read_table(spark, str(tmp_path / "t"), "text")


def test_any_match_stops_early(spark):
    assert "LocalLimit 1" in explain_text(QUERIES["any_match"](spark, SF001), "simple")


def test_tokens_and_partial_aggregate_share_one_codegen_stage(spark):
    import re

    df = QUERIES["word_count_documents"](spark, SF001)
    df.collect()  # the final adaptive plan, with codegen stage ids, exists after execution
    final = explain_text(df, "simple").split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    generates = re.findall(r"\*\((\d+)\) Generate explode", final)
    partials = re.findall(r"\*\((\d+)\) HashAggregate\(keys=\[word#\d+\], functions=\[partial_count", final)
    assert len(generates) == 2 and len(partials) == 1
    assert len(set(generates) | set(partials)) == 1  # one codegen stage id for all three
