import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.sources.files import create_text
from salesmart.sources.footers import footer_table
from salesmart.streaming.schema_history import SchemaConflict, SchemaHistory, merged, wider

ddl = T._parse_datatype_string


@pytest.mark.parametrize("a, b, both", [
    ("int", "int", "int"), ("int", "long", "bigint"), ("byte", "short", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
    ("decimal(3,2)", "decimal(7,2)", "decimal(7,2)"), ("decimal(5,0)", "decimal(4,3)", "decimal(8,3)"), ("int", "decimal(4,2)", "decimal(12,2)"),
    ("long", "decimal(12,2)", "decimal(22,2)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "string", "string")])
def test_wider_types_hold_both_and_are_read_so(spark, tmp_root, a, b, both):
    assert wider(ddl(a), ddl(b)).simpleString() == both == wider(ddl(b), ddl(a)).simpleString()
    text = "2026-10-13" if "timestamp" in both or a == "date" else "7"
    for k, kind in enumerate((a, b)):
        spark.range(1).select(F.lit(text).cast(kind).alias("v")).write.parquet(f"{tmp_root}/t/p={k}")
    rows = spark.read.schema(f"v {both}, p int").parquet(f"{tmp_root}/t").collect()
    assert len(rows) == 2 and len({str(r.v) for r in rows}) == 1 and rows[0].v is not None


@pytest.mark.parametrize("a, b", [("string", "int"), ("long", "double"), ("boolean", "int"), ("decimal(38,0)", "decimal(38,10)"), ("date", "string")])
def test_changes_that_lose_values_are_refused(a, b):
    with pytest.raises(SchemaConflict):
        wider(ddl(a), ddl(b))


def test_merge_keeps_the_first_order_and_compares_names_without_case():
    got = merged([ddl("a int, b string"), ddl("B string, c date, A long"), ddl("d double, c timestamp_ntz")])
    assert got.simpleString() == "struct<a:bigint,b:string,c:timestamp_ntz,d:double>"


def test_history_records_each_schema_once(spark, tmp_root):
    history = SchemaHistory(spark, f"{tmp_root}/h")
    assert history.record("a int").simpleString() == "struct<a:int>"
    assert history.record("a long, b string").simpleString() == "struct<a:bigint,b:string>"
    assert history.record("a int").simpleString() == "struct<a:bigint,b:string>" == history.read_schema().simpleString()
    with pytest.raises(SchemaConflict, match="column b"):
        history.record("a int, b double")
    create_text(spark, f"{tmp_root}/h/000003.json", '{"fields": [')          # a driver lost while it wrote
    history.record("c date")
    assert [len(v.fields) for v in history.versions()] == [1, 2, 1] and len(history.read_schema().fields) == 3


def test_counts_and_bounds_come_from_the_footers(spark, tmp_root):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("_lote"), F.date_add(F.lit("2026-01-05"), (F.col("id") % 40).cast("int")).alias("d"))
    df.write.partitionBy("_lote").parquet(f"{tmp_root}/t")
    t = footer_table(spark, f"{tmp_root}/t", "id long, d date, _lote string")
    by_batch, bounds = t.groupBy("_lote").count(), t.agg(F.min("d"), F.max("d"), F.count("id"))
    for q, pushed in ((by_batch, "COUNT(*)"), (bounds, "MIN(d)")):
        text = q._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [" in text and pushed in text
    assert {r._lote: r["count"] for r in by_batch.collect()} == {"0": 334, "1": 333, "2": 333}
    assert [str(x) for x in bounds.first()] == ["2026-01-05", "2026-02-13", "1000"]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
