import datetime as dt

from pyspark.sql import functions as F

from salesmart.sources.landing import batch_dir, read_manifests, write_batch, write_manifest
from salesmart.sources.files import create_text
from salesmart.streaming.batch_index import BatchIndex
from salesmart.streaming.bronze import load_once, read_bronze, register_bronze

SCHEMA = "r_e_c_n_o_ long, s_t_a_m_p_ timestamp, c5_num string, _lote string"


def _land(spark, root, company, batch, rows):
    df = spark.createDataFrame(rows, "r_e_c_n_o_ long, s_t_a_m_p_ timestamp, c5_num string")
    return write_batch(df, root, "sc5", company, batch, stamp="s_t_a_m_p_")


def test_load_each_file_once(spark, tmp_root):
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/ckpt/sc5"
    t = dt.datetime(2026, 10, 13, 9)
    n, newest, path = _land(spark, land, "01", "20261013T090000Z", [(1, t, "000001")])
    assert n == 1 and newest == t and path == batch_dir(land, "sc5", "01", "20261013T090000Z")
    _land(spark, land, "08", "20261013T090000Z", [(2, t, "000002")])
    assert load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA) == 2
    assert load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA) == 0          # rerun loads nothing
    rows = read_bronze(spark, bronze).orderBy("r_e_c_n_o_").collect()
    assert [(r._empresa, r._lote) for r in rows] == [("01", "20261013T090000Z"), ("08", "20261013T090000Z")]
    assert rows[0]._arquivo.endswith(".parquet") and "empresa=01" in rows[0]._arquivo
    assert rows[0]._dt_ingestao is not None
    _land(spark, land, "01", "20261014T090000Z", [(1, t, "000001b")])
    assert load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA) == 1
    assert read_bronze(spark, bronze).count() == 3


def test_empty_batch_writes_nothing(spark, tmp_root):
    land = f"{tmp_root}/landing"
    n, newest, path = _land(spark, land, "05", "20261013T090000Z", [])
    assert (n, newest, path) == (0, None, None)
    import os
    assert not os.path.exists(batch_dir(land, "sc5", "05", "20261013T090000Z"))


def test_decimal_precision_differs_per_file(spark, tmp_root):
    """Landing files typed decimal(3,2) and decimal(7,2) load with the canonical schema."""
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc6", f"{tmp_root}/ckpt/sc6"
    for company, value, prec in (("01", "7.00", 3), ("05", "12345.67", 7)):
        df = spark.createDataFrame([(1,)], "r_e_c_n_o_ long").select(
            "r_e_c_n_o_", F.lit(value).cast(f"decimal({prec},2)").alias("c6_valor"))
        write_batch(df, land, "sc6", company, "20261013T090000Z")
    schema = "r_e_c_n_o_ long, c6_valor decimal(14,2), _lote string"
    assert load_once(spark, f"{land}/sc6", bronze, ckpt, schema) == 2
    got = sorted(str(r.c6_valor) for r in read_bronze(spark, bronze).collect())
    assert got == ["12345.67", "7.00"]


def test_schema_evolution_on_restart(spark, tmp_root):
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/ckpt/sc5"
    t = dt.datetime(2026, 10, 13, 9)
    _land(spark, land, "01", "L1", [(1, t, "a")])
    load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA)
    wider = spark.createDataFrame([(2, t, "b", "x")], "r_e_c_n_o_ long, s_t_a_m_p_ timestamp, c5_num string, "
                                                      "c5_novo string")
    write_batch(wider, land, "sc5", "01", "L2")
    assert load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA.replace("_lote", "c5_novo string, _lote")) == 1
    rows = {r.r_e_c_n_o_: r.c5_novo for r in read_bronze(spark, bronze).collect()}
    assert rows == {1: None, 2: "x"}


def test_manifest_round_trip(spark, tmp_root):
    items = [{"tabela": "sc5", "empresa": "01", "tipo_carga": "INCREMENTAL", "registros": 3, "arquivo": "a"},
             {"tabela": "sa1", "empresa": "01", "tipo_carga": "FULL", "registros": 0, "arquivo": None}]
    write_manifest(spark, tmp_root, "20261013T090000Z", items)
    write_manifest(spark, tmp_root, "20261001T090000Z", items[:1])
    got = read_manifests(spark, tmp_root, since="20261010T000000Z").collect()
    assert sorted((r.tabela, r.registros) for r in got) == [("sa1", 0), ("sc5", 3)]


def test_register_bronze_with_comment(spark, tmp_root):
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/ckpt/sc5"
    _land(spark, land, "01", "L1", [(1, dt.datetime(2026, 1, 1), "a")])
    load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_bronze LOCATION '{tmp_root}/db'")
    register_bronze(spark, "t_bronze.sc5", bronze, "Bronze: espelho da tabela sc5")
    assert spark.catalog.getTable("t_bronze.sc5").description == "Bronze: espelho da tabela sc5"
    assert [(r._empresa, r._lote) for r in spark.table("t_bronze.sc5").collect()] == [("01", "L1")]


def test_cutoff():
    from salesmart.sources.landing import cutoff
    assert cutoff(7, dt.datetime(2026, 10, 13, 9, 0, 0)) == "20261006T090000Z"


def test_extraction_isolates_failing_items(spark, tmp_root):
    import pytest
    from salesmart.operators import control as ctl
    from salesmart.sources.extract import ExtractionFailed, run_extraction
    t = dt.datetime(2026, 10, 13, 9)
    src = spark.createDataFrame([(1, t, "01"), (2, t, "05")], "r_e_c_n_o_ long, s_t_a_m_p_ timestamp, empresa string")
    items = spark.createDataFrame([("sc5", "01", "INCREMENTAL", True), ("sc5", "05", "INCREMENTAL", True),
                                   ("sc6", "01", "INCREMENTAL", True)], ctl.CONFIG_SCHEMA)
    control = ctl.sync(ctl.empty_control(spark), items)
    with pytest.raises(ExtractionFailed) as err:
        run_extraction(spark, control, {"sc5": src}, tmp_root, batch="20261013T090000Z")   # no sc6 source
    summary = err.value.summary
    assert [(f["tabela"], f["empresa"]) for f in summary.failures] == [("sc6", "01")]
    assert sorted((i["empresa"], i["registros"]) for i in summary.items) == [("01", 1), ("05", 1)]
    rows = {(r.tabela, r.empresa): r for r in summary.control.collect()}
    assert rows[("sc6", "01")].status_ultima_carga == "FALHA" and rows[("sc6", "01")].ultimo_watermark is None
    assert rows[("sc5", "01")].status_ultima_carga == "SUCESSO" and rows[("sc5", "01")].ultimo_watermark == t
    got = sorted((r.tabela, r.empresa, r.registros) for r in read_manifests(spark, tmp_root).collect())
    assert got == [("sc5", "01", 1), ("sc5", "05", 1)]          # manifest written despite the failure


def test_per_table_extraction_lands_the_same_batches(spark, tmp_root):
    from pyspark.sql import functions as F
    from salesmart.operators import control as ctl
    from salesmart.sources.extract import run_extraction
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("ts", "s_t_a_m_p_")
    items = ev.select(F.lit("events").alias("tabela"), F.col("event_type").alias("empresa"),
                      F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(True).alias("ativo")).distinct()
    cut = F.col("s_t_a_m_p_") < F.lit("2024-01-15").cast("timestamp_ntz")
    got = {}
    for mode in (False, True):
        root = f"{tmp_root}/{'table' if mode else 'item'}"
        first = run_extraction(spark, ctl.sync(ctl.empty_control(spark), items), {"events": ev.filter(cut)}, root,
                               company_col="event_type", batch="B1", per_table=mode)
        second = run_extraction(spark, first.control, {"events": ev}, root, company_col="event_type",
                                batch="B2", per_table=mode)
        manifest = sorted((r.lote, r.empresa, r.registros) for r in read_manifests(spark, root).collect())
        n = load_once(spark, f"{root}/events", f"{root}/bronze", f"{root}/ckpt",
                      "event_id long, s_t_a_m_p_ timestamp_ntz, event_type string, _lote string",
                      company_pattern="empresa=([^/]+)")
        rows = sorted((r.event_id, r._lote, r._empresa) for r in read_bronze(spark, f"{root}/bronze").collect())
        wms = sorted((r.empresa, r.ultimo_watermark) for r in second.control.collect())
        got[mode] = (manifest, n, rows, wms)
    assert got[False] == got[True]
    assert got[True][1] > 0


def test_files_outside_company_folders_are_ignored(spark, tmp_root):
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/ckpt/sc5"
    t = dt.datetime(2031, 1, 2)
    for k in range(5):
        _land(spark, land, f"{k:02d}", "L1", [(k, t, "x")])
    spark.createDataFrame([(9, t, "stray", "L1")], SCHEMA).write.parquet(f"{land}/sc5/other/lote=L1")
    assert load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA, max_files_per_trigger=1) == 5
    assert {r._empresa for r in read_bronze(spark, bronze).collect()} == {f"{k:02d}" for k in range(5)}


def test_batch_index_follows_loads_late_files_and_lost_drivers(spark, tmp_root):
    land, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/ckpt/sc5"
    index = BatchIndex(spark, f"{tmp_root}/index")
    t = dt.datetime(2026, 10, 13, 9)

    def load(*batches, with_index=True):
        for company, batch in batches:
            _land(spark, land, company, batch, [(1, t, "x")])
        return load_once(spark, f"{land}/sc5", bronze, ckpt, SCHEMA, index=index if with_index else None)

    assert index.newest() == {}
    assert load(("01", "B3"), ("05", "B3")) == 2
    assert index.newest() == {"01": "B3", "05": "B3"}
    assert load() == 0 and index.newest() == {"01": "B3", "05": "B3"}
    load(("01", "B2"), ("08", "B1"))                       # late files: only the company that had none is set
    assert index.newest() == {"01": "B3", "05": "B3", "08": "B1"}
    load(("05", "B4"), with_index=False)                   # the driver is lost after the sink's commit
    load(("01", "B5"))
    assert index.newest() == {"01": "B5", "05": "B4", "08": "B1"}
    create_text(spark, f"{index.path}/99.json", '{"newest": [{"comp')        # cut off while it was written
    assert index.newest() == {"01": "B5", "05": "B4", "08": "B1"}


def test_load_by_manifest_reads_only_what_new_manifests_name(spark, tmp_root):
    import os

    from salesmart.streaming.manifest_load import load_listed, new_batches, read_listed
    land, bronze, marks = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", f"{tmp_root}/marks"
    t = dt.datetime(2026, 10, 13, 9)

    def run(batch, *companies):
        items = []
        for c in companies:
            n, _, path = _land(spark, land, c, batch, [(int(c), t, batch)])
            items.append({"tabela": "sc5", "empresa": c, "tipo_carga": "FULL", "registros": n, "arquivo": path})
        items.append({"tabela": "sa1", "empresa": "01", "tipo_carga": "FULL", "registros": 9, "arquivo": f"{land}/sa1/gone"})
        items.append({"tabela": "sc5", "empresa": "99", "tipo_carga": "FULL", "registros": 0, "arquivo": None})
        write_manifest(spark, land, batch, items)

    def load():
        return load_listed(spark, land, "sc5", bronze, marks, SCHEMA)

    def rows():
        return sorted((r._empresa, r._lote) for r in read_listed(spark, bronze, SCHEMA).collect())

    run("B1", "01", "05")
    assert load() == 2 and load() == 0 and rows() == [("01", "B1"), ("05", "B1")]
    # folders that no manifest names are never opened: this one could not be read
    os.makedirs(f"{land}/sc5/empresa=07/lote=B0")
    with open(f"{land}/sc5/empresa=07/lote=B0/part-0.parquet", "w") as f:
        f.write("no parquet")
    run("B2", "01")
    run("B3", "08")
    assert new_batches(spark, land, marks) == ["B2", "B3"]
    assert load() == 2 and rows() == [("01", "B1"), ("01", "B2"), ("05", "B1"), ("08", "B3")]
    os.remove(f"{marks}/B3.json")                      # the driver was lost between the load and its mark
    assert load() == 2 and rows() == [("01", "B1"), ("01", "B2"), ("05", "B1"), ("08", "B3")]
    run("B4")
    assert load() == 0 and new_batches(spark, land, marks) == []


def test_the_next_run_completes_the_manifest_of_a_lost_driver(spark, tmp_root, monkeypatch):
    import pytest

    from salesmart.operators import control as ctl
    from salesmart.sources import extract
    source = {"sc5": spark.createDataFrame([("01", 1, dt.datetime(2026, 1, 1)), ("05", 2, dt.datetime(2026, 1, 2))],
                                           "empresa string, r_e_c_n_o_ long, s_t_a_m_p_ timestamp")}
    control = spark.createDataFrame([("sc5", c, "INCREMENTAL", True, None, None, None, None) for c in ("01", "05")], ctl.CONTROL_SCHEMA)

    def lost(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(extract, "write_manifest", lost)
        with pytest.raises(KeyboardInterrupt):
            extract.run_extraction(spark, control, source, tmp_root, batch="B1")
    assert extract.load_control(spark, tmp_root).where("ultimo_watermark is not null").count() == 2     # saved before the manifest
    extract.run_extraction(spark, extract.load_control(spark, tmp_root), source, tmp_root, batch="B2", overlap_minutes=0)
    got = {(r.lote, r.empresa, r.registros) for r in read_manifests(spark, tmp_root).collect()}
    assert got == {("B1", "01", 1), ("B1", "05", 1), ("B2", "01", 0), ("B2", "05", 0)}
    assert extract.complete_manifest(spark, tmp_root) is None


def test_a_load_writes_its_batches_without_sorting(spark, tmp_root, monkeypatch):
    from pyspark.sql.streaming import StreamingQuery

    name, seen, base = "spark.sql.maxConcurrentOutputFileWriters", [], StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda q, *a: seen.append(spark.conf.get(name, None)) or base(q, *a))
    before = spark.conf.get(name, None)
    land, bronze, t = f"{tmp_root}/landing", f"{tmp_root}/bronze/sc5", dt.datetime(2026, 10, 13, 9)
    batches = [f"2026101{k}T090000Z" for k in range(7)]                # more than a task keeps open
    for k, batch in enumerate(batches):
        _land(spark, land, "01", batch, [(k, t, "000001"), (k + 100, t, "000002")])
    assert load_once(spark, f"{land}/sc5", bronze, f"{tmp_root}/ckpt", SCHEMA) == 14
    rows = read_bronze(spark, bronze, SCHEMA).collect()
    assert sorted((r.r_e_c_n_o_, r._lote) for r in rows) == sorted((k + x, b) for k, b in enumerate(batches) for x in (0, 100))
    assert seen == ["4"] and spark.conf.get(name, None) == before
