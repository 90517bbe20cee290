"""Plan properties that must hold at scale (checked on the smallest test tables)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from salesmart.operators.quality import orphan_keys
from salesmart.operators import versions
from salesmart.operators.versions import latest_snapshot, latest_version, newest_batches
from salesmart.plans import event_feed
from salesmart.plans.queries import QUERIES
from salesmart.streaming.bronze import read_bronze

SF = "/root/testdata/sf0.001"
# queries whose builders write (landing, versions): their final plans read written data
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for node in FORBIDDEN:
        assert node not in text, f"{name} plans {node}"


def _hot(spark, n=3000):
    """One key holds a third of the rows (many versions of one record)."""
    rows = [("01", 1, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i), f"L{i:05d}") for i in range(n // 3)]
    rows += [("01", 100 + i, dt.datetime(2026, 1, 1), "L00000") for i in range(2 * n // 3)]
    return spark.createDataFrame(rows, "cod_empresa string, num_recno long, dat_stamp timestamp, _lote string")


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = latest_version(_hot(spark).repartition(4))
    text = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    before_exchange = text.split("Exchange hashpartitioning")[-1]
    assert "WindowGroupLimit" in before_exchange
    got = {r.num_recno: r._lote for r in df.collect()}
    assert got[1] == f"L{999:05d}" and len(got) == 1 + 2000


def test_snapshot_combines_map_side_and_reads_literals(spark, monkeypatch):
    df = _hot(spark).withColumn("cod_empresa", F.lit("01"))
    leaf_side = newest_batches(df)._jdf.queryExecution().sparkPlan().toString().split("Exchange hashpartitioning")[-1]
    assert "HashAggregate" in leaf_side and "Sort [" not in leaf_side
    snap = latest_snapshot(df)
    text = plan(snap)
    assert "Exchange" not in text and "L00999" in text and snap.count() == 1
    monkeypatch.setattr(versions, "SNAPSHOT_LITERALS", 0)         # many companies: a semi join with the pairs
    assert "LeftSemi" in plan(latest_snapshot(df)) and latest_snapshot(df).count() == 1


def test_snapshot_by_index_prunes_bronze_partitions(spark):
    feed = event_feed.run_full(spark, SF)
    newest = feed.index.newest()
    assert newest["error"] == event_feed.FIRST_BATCH and set(newest.values()) == {event_feed.FIRST_BATCH, event_feed.SECOND_BATCH}
    only = {c: b for c, b in newest.items() if c != "error"}
    snap = latest_snapshot(read_bronze(spark, f"{feed.root}/bronze/events", event_feed.LANDING_SCHEMA), "_empresa", "_lote", newest=only)
    text = plan(snap)
    assert "Exchange" not in text
    assert re.search(r"PartitionFilters: \[[^\]]*_lote#\d+ = " + event_feed.SECOND_BATCH, text)
    files = {r[0] for r in snap.select(F.input_file_name()).distinct().collect()}
    assert files and all(event_feed.SECOND_BATCH in f for f in files)


def test_orphans_reduce_fact_keys_before_the_join(spark):
    fact = _hot(spark).select("cod_empresa", F.col("num_recno").cast("string").alias("k"))
    dim = spark.createDataFrame([("01", "1")], "cod_empresa string, k string")
    df = orphan_keys(fact, dim, ["cod_empresa", "k"])
    text = df._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in text
    assert df.count() == 2000


def test_incremental_predicates_reach_the_scan(spark):
    df = entry.queries()["incremental_events"](spark, SF)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan(df)


def test_scans_read_only_needed_columns(spark):
    df = entry.queries()["value_sold"](spark, SF)
    text = plan(df)
    line_scan = [ln for ln in text.splitlines() if "lineitem.parquet" in ln][0]
    assert "l_tax" not in line_scan and "l_linestatus" not in line_scan


def test_stored_order_fact_joins_without_an_exchange(spark):
    text = plan(entry.queries()["order_fact_stored"](spark, SF))
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text


def test_the_integrity_gate_scans_the_fact_once(spark, tmp_root):
    from salesmart.operators.quality import integrity_gate
    rows = spark.range(2000).selectExpr("string(id % 50) as a", "string(id % 7) as b", "if(id % 11 = 0, null, string(id % 3)) as c")
    rows.write.parquet(f"{tmp_root}/fact")
    keys = {"x": ["a"], "y": ["b", "c"], "z": ["c"]}
    dims = {"x": rows.select("a").where("a < '4'"), "y": rows.select("b", "c").where("b <> '2'"), "z": rows.select("c")}
    gate = integrity_gate(spark.read.parquet(f"{tmp_root}/fact"), dims, keys)
    assert plan(gate).count(f"{tmp_root}/fact") == 1
    got = {r.objeto.partition("->")[2]: r.qtd_falhas for r in gate.collect()}
    want = {name: orphan_keys(rows, dims[name], k).count() for name, k in keys.items()}
    assert got == want and want["y"] > want["z"] == 1
    none = integrity_gate(rows.limit(0), dims, keys).collect()
    assert len(none) == 3 and all(r.qtd_falhas == 0 for r in none)


def test_bounds_of_all_items_reach_the_scan(spark):
    from salesmart.operators.watermark import extract_items
    events = spark.read.parquet(f"{SF}/events.parquet")
    items = [{"empresa": "click", "tipo_carga": "INCREMENTAL", "ultimo_watermark": dt.datetime(2024, 1, 20)},
             {"empresa": "error", "tipo_carga": "INCREMENTAL", "ultimo_watermark": dt.datetime(2024, 1, 10)}]
    df = extract_items(events, items, "event_type", stamp="ts")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,2024-01-09T23:50\)", plan(df))
    want = events.where("(event_type = 'click' and ts > '2024-01-19 23:50:00') or (event_type = 'error' and ts > '2024-01-09 23:50:00')")
    assert df.count() == want.count() > 0
    full = [*items[:1], {"empresa": "error", "tipo_carga": "FULL", "ultimo_watermark": None}]
    assert extract_items(events, full, "event_type", stamp="ts").where("event_type = 'error'").count() == events.where("event_type = 'error'").count()
    assert extract_items(events, [], "event_type", stamp="ts").count() == 0
