from pyspark.sql import functions as F

from salesmart.config import GOLD_COMMENTS
from salesmart.plans.tables import VersionedCatalog, comment_statements


def test_comment_statements_escape():
    stmts = comment_statements("g.dim_unidade", "dim_unidade", {"dim_unidade": ("it's \\ ok", {"c": "x'y"})})
    assert stmts == ["COMMENT ON TABLE g.dim_unidade IS 'it\\'s \\\\ ok'",
                     "ALTER TABLE g.dim_unidade ALTER COLUMN c COMMENT 'x\\'y'"]


def test_publish_restore_and_comments(spark, tmp_root):
    cat = VersionedCatalog(spark, tmp_root, "t_gold")
    a = spark.createDataFrame([("01", "01", "Matriz")] * 3, "cod_empresa string, cod_filial string, des_unidade string")
    first = cat.publish(a, "dim_unidade", version="v1")
    assert first["rows"] == 3 and cat.table("dim_unidade").count() == 3
    cat.publish(a.union(a), "dim_unidade", version="v2")
    assert cat.table("dim_unidade").count() == 6
    desc, cols = cat.describe("dim_unidade")
    assert desc == GOLD_COMMENTS["dim_unidade"][0] and cols["des_unidade"] == "Nome da unidade"
    assert cat.versions("dim_unidade") == ["v1", "v2"]
    cat.restore("dim_unidade", "v1")
    assert cat.table("dim_unidade").count() == 3
    assert cat.describe("dim_unidade")[0] == GOLD_COMMENTS["dim_unidade"][0]


def test_upsert_reads_version_n_while_writing_n_plus_1(spark, tmp_root):
    from salesmart.operators.upsert import upsert
    import datetime as dt
    cat = VersionedCatalog(spark, tmp_root, "t_silver")
    schema = "cod_empresa string, num_recno long, dat_stamp timestamp, v string"
    t1 = dt.datetime(2026, 1, 1)
    cat.publish(spark.createDataFrame([("01", 1, t1, "a")], schema), "sc5")
    changes = spark.createDataFrame([("01", 1, dt.datetime(2026, 1, 2), "b"), ("01", 2, t1, "c")], schema)
    cat.publish(upsert(cat.table("sc5"), changes), "sc5")
    assert sorted((r.num_recno, r.v) for r in cat.table("sc5").collect()) == [(1, "b"), (2, "c")]


def test_schema_change_recreates_table(spark, tmp_root):
    cat = VersionedCatalog(spark, tmp_root, "t_gold2")
    cat.publish(spark.createDataFrame([(1,)], "a int"), "x")
    cat.publish(spark.createDataFrame([(1, "b")], "a int, b string"), "x")
    assert cat.table("x").columns == ["a", "b"]


def test_documentation_gate_flags_undescribed_tables(spark, tmp_root):
    from salesmart.operators.quality import documentation_gate
    cat = VersionedCatalog(spark, tmp_root, "t_doc")
    cat.publish(spark.createDataFrame([("01", "01", "x")], "cod_empresa string, cod_filial string, "
                                      "des_unidade string"), "dim_unidade")      # described by the dictionary
    cat.publish(spark.createDataFrame([(1,)], "a int"), "sem_descricao")           # not in the dictionary
    rows = documentation_gate(spark, "t_doc").collect()
    assert [r.objeto for r in rows] == ["t_doc.sem_descricao"]


def test_failing_gates_keep_gold_unpublished(spark, tmp_root):
    import pytest
    from salesmart.operators.quality import GateFailure
    from salesmart.plans.pipeline import daily_load
    from salesmart.plans.queries import tpch_bronze, tpch_domain
    d = "/root/testdata/sf0.01"        # six suppliers are deleted there, so facts are orphaned
    with pytest.raises(GateFailure, match="dim_vendedor"):
        daily_load(spark, tpch_domain(d), tpch_bronze(spark, d), tmp_root, env="gated", today="2001-08-01")
    assert not spark.catalog.tableExists("gated_gold.fato_pedido_venda")
    assert spark.catalog.tableExists("gated_silver.lineitem")


def test_build_silver_first_load_upsert_and_reprocess(spark, tmp_root):
    import datetime as dt
    from salesmart.plans.pipeline import SourceTable, build_silver
    schema = ("c5_num string, d_e_l_e_t_ string, r_e_c_n_o_ long, s_t_a_m_p_ timestamp, _empresa string, "
              "_lote string")
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    spec = SourceTable("sc5", {"c5_num": ("cod_pedido", "texto")}, "INCREMENTAL")
    cat = VersionedCatalog(spark, tmp_root, "t_silver_s10")
    b1 = spark.createDataFrame([("A", " ", 1, t1, "01", "L1"), ("B", " ", 2, t1, "01", "L1")], schema)
    build_silver(spark, spec, b1, cat)                                   # S10 first load
    assert sorted(r.cod_pedido for r in cat.table("sc5").collect()) == ["A", "B"]
    b2 = b1.union(spark.createDataFrame([("A2", " ", 1, t2, "01", "L2"), ("old", " ", 2, t1, "01", "L0")],
                                        schema))
    build_silver(spark, spec, b2, cat)                                   # S8: only batches after L1
    assert sorted(r.cod_pedido for r in cat.table("sc5").collect()) == ["A2", "B"]
    build_silver(spark, spec, b2, cat, reprocess=True)                   # S10: everything again
    assert sorted((r.num_recno, r.cod_pedido) for r in cat.table("sc5").collect()) == [(1, "A2"), (2, "B")]
    assert len(cat.versions("sc5")) == 3


def test_optional_fact_grain_and_calendar_gates(spark, tmp_root):
    from salesmart.plans.pipeline import daily_load
    from salesmart.plans.queries import tpch_bronze, tpch_domain
    d = "/root/testdata/sf0.001"
    rep = daily_load(spark, tpch_domain(d), tpch_bronze(spark, d), tmp_root, env="opt", today="2001-08-01",
                     check_fact_grain=True, check_calendar=True, keep_versions=1)
    gates = {(g["gate"], g["objeto"]): g["qtd_falhas"] for g in rep.gates}
    assert gates[("integridade", "fato_pedido_venda->dim_calendario")] == 0
    assert gates[("chave_duplicada", "gold.fato_pedido_venda")] == 0
    assert rep.published


def test_prune_versions_keeps_newest_and_current(spark, tmp_root):
    cat = VersionedCatalog(spark, tmp_root, "t_prune")
    df = spark.createDataFrame([(1,)], "a int")
    for v in ["v1", "v2", "v3", "v4"]:
        cat.publish(df, "x", version=v)
    cat.restore("x", "v1")                                  # the table reads an old version
    assert cat.prune_versions("x", keep=2) == ["v2"]        # v1 is current, v3/v4 are the newest two
    assert cat.versions("x") == ["v1", "v3", "v4"]
    assert cat.table("x").count() == 1


def test_newest_batch_recorded_at_publish_and_cleared_on_restore(spark, tmp_root):
    cat = VersionedCatalog(spark, tmp_root, "t_newest")
    df = spark.createDataFrame([(1, "L1"), (2, "L3"), (3, "L2")], "a int, _lote string")
    cat.publish(df, "x", version="v1")
    assert cat.newest_batch("x") == "L3"
    cat.publish(df.union(spark.createDataFrame([(4, "L9")], df.schema)), "x", version="v2")
    assert cat.newest_batch("x") == "L9"
    fresh = VersionedCatalog(spark, tmp_root, "t_newest")        # another driver: nothing observed
    fresh.restore("x", "v1")
    assert fresh.newest_batch("x") is None
    cat.publish(spark.createDataFrame([(1,)], "a int"), "y")
    assert cat.newest_batch("y") is None


def test_one_commit_changes_all_tables_for_snapshot_readers(spark, tmp_root):
    import pytest

    from salesmart.plans.tables import ConcurrentCommit
    from salesmart.sources.files import create_text

    cat = VersionedCatalog(spark, tmp_root, "pointer_db")
    assert cat.committed() == (0, {}) and cat.snapshot() == {}

    def write(load, tables=("a", "b", "c")):
        return {t: cat.write_version(spark.range(2).withColumn("load", F.lit(load)), t, f"{load}")[0] for t in tables}

    def seen():
        return {t: df.first().load for t, df in cat.snapshot().items()}

    cat.commit(write(1), 0)
    assert seen() == dict.fromkeys("abc", 1)
    base = cat.committed()[0]
    new = write(2, ("a", "c"))
    assert seen() == dict.fromkeys("abc", 1)          # written, not committed
    held = cat.snapshot()
    cat.commit(new, base)
    assert seen() == {"a": 2, "b": 1, "c": 2} and {df.first().load for df in held.values()} == {1}
    with pytest.raises(ConcurrentCommit):
        cat.commit(write(3), base)                     # somebody has committed after base
    create_text(spark, f"{tmp_root}/pointer_db/_current/{3:012d}.json", '{"tab')     # a driver lost while it wrote
    assert seen() == {"a": 2, "b": 1, "c": 2}
    cat.commit(write(4), cat.committed()[0])
    assert seen() == dict.fromkeys("abc", 4)
    for load in (5, 6):
        write(load, ("a",))
    assert "4" not in cat.prune_versions("a", keep=1) and seen()["a"] == 4          # the committed version stays
