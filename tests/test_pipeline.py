"""End to end on a small ERP: extract (3 runs around changes) -> Bronze -> Silver -> Gold -> gates."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.config import EXTRACTION_CONFIG
from salesmart.operators import control as ctl
import dataclasses

import pytest

from salesmart.operators.upsert import Bucketing, read_bucketed
from salesmart.plans.marts import SalesStar
from salesmart.plans.measures import MeasureStore
from salesmart.plans.pipeline import ERP_DOMAIN, extract_and_load, landing_schema
from salesmart.plans.tables import VersionedCatalog

COMPANIES = ["01", "05", "08", "13"]
UNITS = {"01": ["01"], "05": ["01"], "08": ["01", "02"], "13": ["01"]}
T0 = dt.datetime(2026, 10, 10, 12)

SCHEMAS = {
    "sc5": "empresa string, c5_filial string, c5_num string, c5_tipo string, c5_cliente string, c5_lojacli string, "
           "c5_vend1 string, c5_emissao string, c5_nota string, d_e_l_e_t_ string, r_e_c_n_o_ long, "
           "s_t_a_m_p_ timestamp",
    "sc6": "empresa string, c6_filial string, c6_num string, c6_item string, c6_produto string, "
           "c6_qtdven decimal(12,2), c6_prcven decimal(14,2), c6_valor decimal(14,2), c6_qtdent decimal(12,2), "
           "c6_nota string, d_e_l_e_t_ string, r_e_c_n_o_ long, s_t_a_m_p_ timestamp",
    "sa1": "empresa string, a1_filial string, a1_cod string, a1_loja string, a1_nome string, a1_nreduz string, "
           "a1_est string, a1_mun string, a1_vend string, a1_msblql string, a1_cgc string, d_e_l_e_t_ string, "
           "r_e_c_n_o_ long, s_t_a_m_p_ timestamp",
    "sa3": "empresa string, a3_filial string, a3_cod string, a3_nome string, d_e_l_e_t_ string, r_e_c_n_o_ long, "
           "s_t_a_m_p_ timestamp",
    "sb1": "empresa string, b1_filial string, b1_cod string, b1_desc string, b1_tipo string, b1_um string, "
           "b1_grupo string, b1_prv1 decimal(12,2), d_e_l_e_t_ string, r_e_c_n_o_ long, s_t_a_m_p_ timestamp",
}


def make_erp(seed=42):
    rng = random.Random(seed)
    t = {k: [] for k in SCHEMAS}
    recno = 0

    def rid():
        nonlocal recno
        recno += 1
        return recno

    for e in COMPANIES:
        for c in range(1, 6):
            t["sa1"].append([e, "  ", f"{c:06d}", "01", f"Cliente {c}", f"C{c}", "SP", "Sao Paulo", "000001",
                             "2", "11222333000182", " ", rid(), T0])
        for v in range(1, 3):
            t["sa3"].append([e, "  ", f"{v:06d}", f"Vendedor {v}", " ", rid(), T0])
        for p in range(1, 7):
            t["sb1"].append([e, "  ", f"P{p:05d}", f"Produto {p}", "PA", "UN", "0001", Decimal("9.90"), " ",
                             rid(), T0])
        n = 0
        for day in range(3):
            for f in UNITS[e]:
                for _ in range(rng.randint(1, 3)):
                    n += 1
                    stamp = T0 - dt.timedelta(days=3 - day)
                    t["sc5"].append([e, f, f"{n:06d}", "N", f"{rng.randint(1, 5):06d}", "01",
                                     f"{rng.randint(1, 2):06d}", stamp.strftime("%Y%m%d"), " " * 9, " ", rid(), stamp])
                    for i in range(1, rng.randint(1, 5) + 1):
                        q = Decimal(rng.randint(1, 9))
                        price = Decimal(rng.randint(100, 999)) / 100
                        t["sc6"].append([e, f, f"{n:06d}", f"{i:02d}", f"P{rng.randint(1, 6):05d}", q, price,
                                         (q * price).quantize(Decimal("0.01")), Decimal(0), " " * 9, " ", rid(), stamp])
    return t


def frames(spark, data):
    return {k: spark.createDataFrame([tuple(r) for r in v], SCHEMAS[k]) for k, v in data.items()}


def assert_measures(spark, store, lake, env):
    """The maintained measures equal the full dashboard join over the committed snapshot."""
    g = VersionedCatalog(spark, lake, f"{env}_gold").snapshot()
    star = SalesStar(g["fato_pedido_venda"], g["dim_unidade"], g["dim_produto"], g["dim_vendedor"], g["dim_cliente"])
    want = {("valor_vendido", None, star.value_sold().first()[0]), ("valor_em_carteira", None, star.open_value().first()[0])}
    want |= {("vendas_por_mes", str(r[0]), r[1]) for r in star.sales_by_month().collect()}
    want |= {("vendas_por_unidade", *r) for r in star.sales_by_unit().collect()}
    want |= {("carteira_por_vendedor", *r) for r in star.open_by_seller().collect()}
    assert {tuple(r) for r in store.measures(g["dim_unidade"], g["dim_vendedor"]).collect()} == want


BUCKETED = dataclasses.replace(ERP_DOMAIN, tables={
    **ERP_DOMAIN.tables,
    "sc5": dataclasses.replace(ERP_DOMAIN.tables["sc5"], buckets=8),
    "sc6": dataclasses.replace(ERP_DOMAIN.tables["sc6"], buckets=Bucketing(range_col="num_recno", width=50)),
})


CLUSTERED = dataclasses.replace(ERP_DOMAIN, order_buckets=4)


@pytest.mark.parametrize("domain", [ERP_DOMAIN, BUCKETED, CLUSTERED], ids=["versioned", "bucketed", "clustered"])
def test_extract_and_load_end_to_end(spark, tmp_root, domain):
    data = make_erp()
    landing, lake = f"{tmp_root}/landing", f"{tmp_root}/lake"
    cfg = spark.createDataFrame([(x["tabela"], x["tipo_carga"], x["empresas"]) for x in EXTRACTION_CONFIG["tabelas"]],
                                "tabela string, tipo_carga string, empresas array<string>")
    items = ctl.config_items(cfg)
    src = frames(spark, data)
    schemas = {k: landing_schema(v) for k, v in src.items()}
    env = {id(ERP_DOMAIN): "dev", id(BUCKETED): "bkt", id(CLUSTERED): "clu"}[id(domain)]
    store = MeasureStore(spark, f"{tmp_root}/measures")
    kw = dict(landing_root=landing, lake_root=lake, schemas=schemas, today="2026-10-13", overlap_minutes=0, env=env,
              loaded_at="2026-10-13 09:00:00", measures=store)

    # run 1: first load = every source row
    control, rep1 = extract_and_load(spark, domain, ctl.empty_control(spark), items, src,
                                     batch="20261013T060000Z", now=dt.datetime(2026, 10, 13, 6), **kw)
    assert rep1.published
    assert_measures(spark, store, lake, env)
    bronze6 = spark.read.parquet(f"{lake}/{env}_bronze/sc6")
    assert bronze6.count() == len(data["sc6"])
    fact = spark.table(f"{env}_gold.fato_pedido_venda")
    assert fact.count() == len(data["sc6"])
    assert spark.catalog.getTable(f"{env}_gold.fato_pedido_venda").description

    # run 2: nothing changed -> incremental tables land 0 rows, FULL tables land again
    assert spark.catalog.getTable(f"{env}_bronze.sc6").description
    assert spark.table(f"{env}_bronze.sc6").count() == len(data["sc6"])
    control, rep2 = extract_and_load(spark, domain, None, items, src,      # the stored control
                                     batch="20261013T070000Z", now=dt.datetime(2026, 10, 13, 7), **kw)
    b2 = spark.read.parquet(f"{lake}/{env}_bronze/sc5").filter(F.col("_lote") == "20261013T070000Z").count()
    assert b2 == 0
    assert spark.read.parquet(f"{lake}/{env}_bronze/sa1").filter(F.col("_lote") == "20261013T070000Z").count() > 0

    # run 3: one header changed, one item deleted, one new item
    later = dt.datetime(2026, 10, 14, 5)
    sc5 = data["sc5"]
    sc5[0] = sc5[0][:4] + ["000005"] + sc5[0][5:11] + [later]
    sc6 = data["sc6"]
    sc6[0] = sc6[0][:10] + ["*"] + [sc6[0][11], later]
    new_item = list(sc6[1])
    new_item[3], new_item[11], new_item[12] = "99", 10_000, later
    sc6.append(new_item)
    control, rep3 = extract_and_load(spark, domain, control, items, frames(spark, data),
                                     batch="20261014T060000Z", now=dt.datetime(2026, 10, 14, 6), **kw)
    assert rep3.published
    assert_measures(spark, store, lake, env)
    live = store._live()
    assert len(live) == 3                     # run 3 followed by its changed orders, not by a full computation
    b3 = spark.read.parquet(f"{lake}/{env}_bronze/sc6").filter(F.col("_lote") == "20261014T060000Z")
    assert b3.count() == 2
    silver6 = (spark.table(f"{env}_silver.sc6") if domain is not BUCKETED
               else read_bucketed(spark, f"{lake}/bkt_silver/sc6/bucketed").drop("key_bucket"))
    assert silver6.count() == len(sc6)
    assert silver6.groupBy("cod_empresa", "num_recno").count().filter("count > 1").count() == 0
    fact = spark.table(f"{env}_gold.fato_pedido_venda")
    assert fact.count() == len(sc6) - 1
    assert fact.filter((F.col("cod_pedido") == sc5[0][2]) & (F.col("cod_empresa") == sc5[0][0])) \
        .select("cod_cliente").distinct().first()[0] == "000005"
    assert "a1_cgc" not in spark.table(f"{env}_silver.sa1").columns
    if domain is CLUSTERED:                   # also after upserts, the order join needs no exchange
        joined = spark.table("clu_silver.sc5").join(spark.table("clu_silver.sc6"), list(domain.fact_keys))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    if domain is BUCKETED:
        assert 0 < rep3.silver["sc6"]["buckets_rewritten"] <= 2
        assert 0 < rep3.silver["sc5"]["buckets_rewritten"] <= 1
    ctl_rows = {(r.tabela, r.empresa): r for r in control.collect()}
    assert ctl_rows[("sc6", "01")].ultimo_watermark == later
    assert ctl_rows[("sa1", "01")].status_ultima_carga == "SUCESSO"
    gates = {(g["gate"], g["objeto"]): g["qtd_falhas"] for g in rep3.gates}
    assert all(v == 0 for v in gates.values())


def test_a_source_that_never_landed_is_left_out(spark, tmp_root):
    src = frames(spark, make_erp())
    del src["sa3"]
    landed = [x for x in EXTRACTION_CONFIG["tabelas"] if x["tabela"] != "sa3"]
    cfg = spark.createDataFrame([(x["tabela"], x["tipo_carga"], x["empresas"]) for x in landed],
                                "tabela string, tipo_carga string, empresas array<string>")
    _, report = extract_and_load(spark, ERP_DOMAIN, None, ctl.config_items(cfg), src, f"{tmp_root}/landing",
                                 f"{tmp_root}/lake", {k: landing_schema(v) for k, v in src.items()}, today="2026-10-13",
                                 env="part", per_table=True)
    assert report.published and "dim_vendedor" not in report.gold and "fato_pedido_venda" in report.gold


def test_stored_control_folds_results_logged_by_an_interrupted_run(spark, tmp_root):
    from salesmart.sources.extract import load_control, persist_control, record_outcomes
    assert load_control(spark, tmp_root).count() == 0
    rows = [("a", "01", "INCREMENTAL", True, T0, "SUCESSO", T0, 5), ("a", "02", "INCREMENTAL", True, T0, "SUCESSO", T0, 6)]
    persist_control(spark, spark.createDataFrame(rows, ctl.CONTROL_SCHEMA), tmp_root)
    later = T0 + dt.timedelta(days=1)
    record_outcomes(spark, tmp_root, [{"tabela": "a", "empresa": "01", "status": ctl.SUCCESS, "novo_watermark": later,
                                       "registros": 7}], later)
    record_outcomes(spark, tmp_root, [{"tabela": "a", "empresa": "02", "status": ctl.FAILURE, "erro": "x"}], later)
    got = {r.empresa: r for r in load_control(spark, tmp_root).collect()}
    assert (got["01"].ultimo_watermark, got["01"].qtd_ultima_carga, got["01"].data_ultima_execucao) == (later, 7, later)
    assert (got["02"].ultimo_watermark, got["02"].qtd_ultima_carga, got["02"].status_ultima_carga) == (T0, 6, "FALHA")
