import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.operators import control as ctl
from salesmart.operators import watermark as wm

W = dt.datetime(2026, 10, 13, 6, 0)


def test_lower_bound_and_extract(spark):
    assert wm.lower_bound(W, 10) == dt.datetime(2026, 10, 13, 5, 50)
    assert wm.lower_bound(None, 10) is None
    df = spark.createDataFrame([(dt.datetime(2026, 10, 13, 5, 50),), (dt.datetime(2026, 10, 13, 5, 51),), (None,)],
                               "s_t_a_m_p_ timestamp")
    assert wm.extract(df, "INCREMENTAL", W, 10).count() == 1        # strict >, NULL never matches
    assert wm.extract(df, "INCREMENTAL", None, 10).count() == 3     # first load reads all
    assert wm.extract(df, "FULL", W, 10).count() == 3
    with pytest.raises(ValueError):
        wm.extract(df, "DELTA", W, 10)


def test_incremental_filter_is_pushed_down(spark, tmp_root):
    path = f"{tmp_root}/src"
    spark.createDataFrame([(dt.datetime(2026, 10, 13, 7),)], "s_t_a_m_p_ timestamp").write.parquet(path)
    plan = wm.extract(spark.read.parquet(path), "INCREMENTAL", W, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(s_t_a_m_p_), GreaterThan(s_t_a_m_p_" in plan


def test_next_watermark_scalar():
    days = [dt.datetime(2031, 5, d) for d in range(1, 8)]
    for old in (None, days[3]):
        for found in ([], [None], days[:2], [*days, None], [days[3]], [None, days[6]]):
            known = [s for s in [old, *found] if s is not None]
            assert wm.next_watermark_value(old, found) == (sorted(known)[-1] if known else None)


def test_next_watermark_frame(spark):
    b = dt.datetime(2026, 10, 13)
    control = spark.createDataFrame([("sc5", "01", b), ("sc5", "05", b), ("sc5", "08", b), ("sc5", "13", None)],
                                    "tabela string, empresa string, ultimo_watermark timestamp")
    ext = spark.createDataFrame([("sc5", "01", dt.datetime(2026, 10, 14)), ("sc5", "01", None),
                                 ("sc5", "05", dt.datetime(2026, 10, 12))],
                                "tabela string, empresa string, s_t_a_m_p_ timestamp")
    got = {r.empresa: r.ultimo_watermark for r in wm.next_watermark(control, ext).collect()}
    assert got == {"01": dt.datetime(2026, 10, 14), "05": b, "08": b, "13": None}


def test_control_sync_active_and_results(spark):
    previous = spark.createDataFrame(
        [("sc5", "01 ", "INCREMENTAL", True, W, "SUCESSO", W, 5),
         ("sc9", "01", "FULL", True, None, None, None, None)], ctl.CONTROL_SCHEMA)
    cfg = spark.createDataFrame([("sc5", "INCREMENTAL", ["01", "05"])],
                                "tabela string, tipo_carga string, empresas array<string>")
    items = ctl.config_items(cfg)
    synced = {(r.tabela, r.empresa): r for r in ctl.sync(previous, items).collect()}
    assert synced[("sc5", "01")].ultimo_watermark == W and synced[("sc5", "01")].ativo
    assert synced[("sc5", "05")].ultimo_watermark is None and synced[("sc5", "05")].ativo
    assert synced[("sc9", "01")].ativo is False
    control = ctl.sync(previous, items)
    active = [(r.tabela, r.empresa) for r in ctl.active_items(control).collect()]
    assert active == [("sc5", "01"), ("sc5", "05")]
    later = dt.datetime(2026, 10, 14)
    res = spark.createDataFrame([("sc5", "01", "SUCESSO", later, 3), ("sc5", "05", "FALHA", None, None)],
                                ctl.RESULT_SCHEMA)
    now = dt.datetime(2026, 10, 14, 9)
    out = {r.empresa: r for r in ctl.record_results(control, res, now=now).collect() if r.tabela == "sc5"}
    assert out["01"].ultimo_watermark == later and out["01"].qtd_ultima_carga == 3
    assert out["05"].status_ultima_carga == "FALHA" and out["05"].ultimo_watermark is None
    assert out["05"].data_ultima_execucao == now
    off = ctl.set_active(control, "sc5", "05", False)
    assert [r.empresa for r in ctl.active_items(off).collect()] == ["01"]
    rew = ctl.rewind_watermark(control, "sc5", None, None)
    assert all(r.ultimo_watermark is None for r in rew.filter(F.col("tabela") == "sc5").collect())


def test_read_config(spark, tmp_root):
    import json
    from salesmart.config import EXTRACTION_CONFIG
    p = f"{tmp_root}/ingestao.json"
    cfg = json.loads(json.dumps(EXTRACTION_CONFIG))
    del cfg["tabelas"][0]["ativo"]          # defaults to true
    cfg["tabelas"][1]["ativo"] = False
    with open(p, "w") as f:
        json.dump(cfg, f, indent=2)
    items = ctl.read_config(spark, p)
    assert items.count() == 20
    assert items.filter("ativo").count() == 16


def test_physical_names():
    from salesmart.sources.erp import physical_name
    assert [physical_name(a, c) for a, c in (("ab1", "00"), ("xyz", "42"))] == ["ab1000", "xyz420"]
    for alias, company in (("ab", "100"), ("abcd", "1"), ("a b", "01"), ("ab1", "1"), ("ab1", "x1"), ("", ""), (None, "01"), ("ab1", "01;--"), ("AB1", "01")):
        with pytest.raises(ValueError):
            physical_name(alias, company)


def test_company_tables_prune_by_company(spark, tmp_root):
    from salesmart.sources.erp import company_tables, parquet_reader
    for company, n in (("01", 3), ("05", 2)):
        spark.range(n).selectExpr("id AS r_e_c_n_o_", "current_timestamp() AS s_t_a_m_p_") \
            .write.parquet(f"{tmp_root}/sc5{company}0")
    src = company_tables(spark, parquet_reader(tmp_root), "sc5", ["01", "05"])
    assert src.count() == 5
    one = src.filter(F.col("empresa") == "05")
    assert one.count() == 2
    text = one._jdf.queryExecution().optimizedPlan().toString()
    assert "sc5010" not in text          # the other company's relation is pruned away
