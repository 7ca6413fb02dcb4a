"""What the physical plans may and may not contain."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F

import __spark_entry__ as contract
from stratum.operators import flatten_structs, freshness_plan, unique_by
from stratum.queries import QUERIES
from stratum.sources.documents import infer_documents, records, scan_documents
from stratum.sources.tables import parquet_table

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# These end in the same table scan as bronze_by_batch.
WHOLE_RUNS = {"bronze_by_file", "object_or_scalar", "schema_widening", "quarantine_bad_json"}


# The rule is that of the ingestion's own operators; those for training data may run Python and windows.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - WHOLE_RUNS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|Pandas|MapInArrow|CartesianProduct|BroadcastNestedLoop", text)
    assert "Window" not in text


def test_flagship_parses_once_without_shuffle(spark):
    text = plan(contract.entry(spark))
    assert text.count("FileScan json") == 1
    assert "Exchange" not in text and "Sort" not in text
    assert "ReadSchema: struct<id:bigint,props:struct<k:bigint>,type:struct<name:string>,user:struct<id:bigint>>" in text


def test_columns_are_pruned_at_the_line_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":{"b":1,"c":"x"},"d":[1],"e":2}\n')
    schema = infer_documents(spark, [str(tmp_path)], lines=True)
    scan = records(scan_documents(spark, [str(tmp_path)], schema, lines=True))
    assert "ReadSchema: struct<a:struct<b:bigint,c:string>,__corrupt:string>" in plan(scan.select("a_b"))


def test_parquet_pruning_and_pushdown(spark):
    df = parquet_table(spark, f"{SF}/orders.parquet", ["o_orderkey", "o_orderstatus"]).where("o_orderstatus = 'F'")
    text = plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    assert "EqualTo(o_orderstatus,F)" in text
    nested = spark.createDataFrame([((1, 2),)], "s struct<a:bigint,b:bigint>")
    assert flatten_structs(nested).columns == ["s.a", "s.b"]


def test_distinct_reduces_before_the_shuffle(spark):
    lines = parquet_table(spark, f"{SF}/lineitem.parquet", ["l_orderkey", "l_suppkey", "l_linenumber"])
    text = plan(unique_by(lines, ["l_orderkey", "l_suppkey"]))
    assert text.count("Exchange") == 1
    assert "partial_min" in text[text.index("Exchange"):]


def test_ordering_with_limit_keeps_rows_in_the_tasks(spark):
    for name in ("sort_head", "filter_tail"):
        text = plan(contract.queries()[name](spark, SF))
        assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_freshness_is_one_equi_join(spark):
    src = spark.range(10).select(F.col("id").alias("file_key"), F.current_timestamp().alias("src_mtime"))
    out = spark.range(10).select(F.col("id").alias("file_key"), F.current_timestamp().alias("out_mtime"))
    text = plan(freshness_plan(src, out))
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin) .*FullOuter", text)


def test_ingest_write_has_no_shuffle(spark, make_landing):
    """The rows of a file are in one task already, in both layouts."""
    landing = make_landing()
    landing.put("a.json", [{"a": {"b": 1}}])
    path = str(landing.root / "in" / "a.json")
    scan = scan_documents(spark, [path], infer_documents(spark, [path]))
    counted = scan.observe(Observation(), F.count(F.lit(1)).alias("n"))
    text = plan(records(counted))
    assert "Exchange" not in text and text.count("FileScan json") == 1
