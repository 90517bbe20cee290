import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.plans.measures import MeasureStore, changed_orders, partial_sums, retractions
from salesmart.sources.files import create_text

FACT = ("cod_empresa string, cod_filial string, cod_pedido string, cod_vendedor string, dat_emissao date, "
        "vlr_total decimal(14,2), vlr_saldo decimal(14,2)")
KEYS = ["cod_empresa", "cod_pedido"]


def fact(spark, rows):
    return spark.createDataFrame([("01", f, p, v, dt.date(2026, m, 3), t and Decimal(t), s and Decimal(s)) for f, p, v, m, t, s in rows], FACT)


def state(store):
    return sorted((r.cod_filial or "", r.cod_vendedor or "", r.mes.month, r.linhas, r.vlr_total, r.n_vlr_saldo) for r in store.state().collect())


def full(df):
    return sorted((r.cod_filial or "", r.cod_vendedor or "", r.mes.month, r.linhas, r.vlr_total, r.n_vlr_saldo) for r in partial_sums(df).collect())


ONE = [("a", "1", "x", 1, "5.00", "1.00"), ("a", "2", "x", 1, "7.50", None), ("b", "3", None, 2, "1.00", "1.00"), (None, "4", "y", 2, None, None)]
TWO = [("a", "1", "x", 1, "6.00", "0.00"), ("c", "3", "y", 3, "1.00", "1.00"), (None, "4", "y", 2, None, None), ("a", "5", "x", 1, "-2.00", "1.00")]


def test_retractions_equal_a_full_computation_and_count_once(spark, tmp_root):
    store = MeasureStore(spark, tmp_root)
    assert store.state().count() == 0 and store.newest() is None
    one, two = fact(spark, ONE), fact(spark, TWO)
    assert store.add("1", retractions(None, one)) and not store.add("1", retractions(None, two))
    assert state(store) == full(one)
    store.add("2", retractions(one, two))
    assert state(store) == full(two)          # groups whose rows are all gone vanish, NULL sums stay uncounted
    store.compact()
    assert state(store) == full(two) and len(store._live()) == 1 and store.newest() == "2"
    store.add("3", retractions(two, two.limit(0)))
    assert store.state().count() == 0
    create_text(spark, f"{tmp_root}/_marks/4.json", '{"part": "x')          # a driver lost while it wrote
    assert store.state().count() == 0


def test_following_the_load_by_notes(spark, tmp_root):
    store = MeasureStore(spark, tmp_root)
    facts = [fact(spark, ONE), fact(spark, TWO), fact(spark, TWO[:2])]
    orders = [facts[k].select(*KEYS).unionAll(facts[k + 1].select(*KEYS)).distinct() for k in range(2)]
    store.follow("v1", facts[0], None, None, {"i": "s1"}, KEYS)
    assert state(store) == full(facts[0])
    # run 2 fails its gates: Silver moves on, nothing is published; run 3 publishes both runs' changes
    store.note({"i": "s1"}, {"i": "s2"}, orders[0])
    store.note({"i": "s2"}, {"i": "s3"}, orders[1])
    store.follow("v3", facts[2], "v1", facts[0], {"i": "s3"}, KEYS)
    assert state(store) == full(facts[2]) and len(store._live()) == 2
    store.follow("v3", facts[0], "v1", facts[0], {"i": "s3"}, KEYS)             # a repeated publish
    assert state(store) == full(facts[2])
    # a gap in the notes, unknown changes, or another fact than the counted one: the new fact replaces the state
    store.follow("v4", facts[1], "v3", facts[2], {"i": "s5"}, KEYS)
    assert state(store) == full(facts[1]) and len(store._live()) == 1
    store.note({"i": "s5"}, {"i": "s6"}, None)
    store.follow("v5", facts[0], "v4", facts[1], {"i": "s6"}, KEYS)
    assert state(store) == full(facts[0])
    store.note({"i": "s6"}, {"i": "s7"}, orders[0].limit(0))
    store.follow("v7", facts[1], "v6", facts[0], {"i": "s7"}, KEYS)
    assert state(store) == full(facts[1])


def test_changed_orders_hold_the_old_order_of_a_moved_record(spark):
    rows = "cod_empresa string, num_recno long, cod_pedido string"
    before = spark.createDataFrame([("01", 1, "A"), ("01", 2, "B"), ("01", 3, "C")], rows)
    changes = spark.createDataFrame([("01", 1, "Z"), ("01", 9, "N")], rows)
    got = {r.cod_pedido for r in changed_orders([changes], [before], KEYS).collect()}
    assert got == {"A", "Z", "N"}


def test_unchanged_rows_cancel_before_the_groups_are_dealt_out(spark):
    one, two = (fact(spark, rows).repartition(4, *KEYS) for rows in (ONE, TWO))
    got = retractions(one, two)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 3      # by order twice, by group once
    rows = {(r.cod_filial, r.cod_vendedor, r.mes.month): (r.linhas, r.vlr_total, r.n_vlr_total, r.vlr_saldo, r.n_vlr_saldo) for r in got.collect()}
    d = Decimal
    assert rows == {("a", "x", 1): (0, d("-8.50"), 0, d("0.00"), 1), ("b", None, 2): (-1, d("-1.00"), -1, d("-1.00"), -1),
                    ("c", "y", 3): (1, d("1.00"), 1, d("1.00"), 1)}


def test_the_maintained_measures_read_the_headers_once(spark, tmp_root, monkeypatch):
    from salesmart.plans import queries
    rows = spark.range(600).selectExpr(
        "id % 90 as l_orderkey", "cast(id % 7 + 1 as int) as l_linenumber", "id % 11 as l_partkey", "id % 5 as l_suppkey",
        "double(id % 9) as l_quantity", "double(id) as l_extendedprice", "0.05d as l_discount", "'A' as l_returnflag",
        "timestamp_ntz'1995-01-01' + make_dt_interval(cast(id * 4 as int)) as l_shipdate")
    tables = {
        "lineitem": rows,
        "orders": spark.range(90).selectExpr("id as o_orderkey", "'1' as o_orderpriority", "id % 4 as o_custkey", "if(id % 5 = 0, 'F', 'O') as o_orderstatus",
                                             "timestamp_ntz'1995-01-01' + make_dt_interval(cast(id as int)) as o_orderdate"),
        "customer": spark.range(4).selectExpr("id as c_custkey", "cast(id as int) as c_nationkey"),
        "supplier": spark.range(5).selectExpr("id as s_suppkey", "string(id) as s_name", "1d as s_acctbal"),
        "nation": spark.range(4).selectExpr("cast(id as int) as n_nationkey", "0 as n_regionkey", "string(id) as n_name"),
        "region": spark.range(1).selectExpr("0 as r_regionkey", "'r' as r_name"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_root}/{name}.parquet")
    calls, base = [], queries.silver_orders
    monkeypatch.setattr(queries, "silver_orders", lambda *a: calls.append(1) or base(*a))
    got = {(r.medida, r.chave): r.valor for r in queries.q_maintained_measures(spark, tmp_root).collect()}
    assert len(calls) == 1
    whole = queries.gold_fact(spark, tmp_root)
    assert (got[("valor_vendido", None)], got[("valor_em_carteira", None)]) == tuple(whole.agg(F.sum("vlr_total"), F.sum("vlr_saldo")).first())
    assert {k[1]: v for k, v in got.items() if k[0] == "carteira_por_vendedor"} == \
        {r[0]: r[1] for r in whole.groupBy("cod_vendedor").agg(F.sum("vlr_saldo")).collect()}


def test_the_measures_read_each_part_once(spark, tmp_root):
    store = MeasureStore(spark, tmp_root)
    one, two = fact(spark, ONE), fact(spark, TWO)
    units = spark.createDataFrame([("01", "a", "A"), ("01", "c", "C"), ("01", "c", "C again")], "cod_empresa string, cod_filial string, des_unidade string")
    sellers = spark.createDataFrame([("01", "x", "X")], "cod_empresa string, cod_vendedor string, des_nome string")
    d = Decimal

    def read():
        return sorted((r.medida, r.chave or "", r.valor) for r in store.measures(units, sellers).collect())

    assert read() == [("valor_em_carteira", "", None), ("valor_vendido", "", None)]         # nothing counted yet
    store.add("1", retractions(None, one))
    store.add("2", retractions(one, two))
    # order 3 moved to unit c, which has two names, and to seller y, who has none; unit b and month 2 are gone
    assert read() == [
        ("carteira_por_vendedor", "", d("2.00")), ("carteira_por_vendedor", "X", d("1.00")), ("valor_em_carteira", "", d("3.00")),
        ("valor_vendido", "", d("6.00")), ("vendas_por_mes", "2026-01-01", d("4.00")), ("vendas_por_mes", "2026-03-01", d("2.00")),
        ("vendas_por_unidade", "A", d("4.00")), ("vendas_por_unidade", "C", d("1.00")), ("vendas_por_unidade", "C again", d("1.00"))]
    plan = store.measures(units, sellers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_equal_rows_cancel_by_number(spark):
    row = ("a", "1", "x", 1, "5.00", None)
    got = retractions(fact(spark, [row, row, row]), fact(spark, [row, ("a", "1", "x", 1, "5.00", "2.00")]))
    assert [tuple(r)[4:] for r in got.select(*got.columns).collect()] == [(-1, Decimal("-5.00"), -1, Decimal("2.00"), 1)]
    lowest = got._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[-1]
    assert lowest.startswith("cod_pedido") and "sum(linhas" in lowest and "sum(vlr_" not in lowest      # no value is added up before


def test_staged_rows_are_written_without_dictionaries(spark, tmp_root):
    import glob

    import pyarrow.parquet as pq

    from salesmart.session import materialize
    rows = materialize(spark.range(5000).selectExpr("string(id) as k"), "stage")
    meta = pq.ParquetFile(glob.glob(rows.inputFiles()[0].removeprefix("file://"))[0]).metadata
    assert rows.count() == 5000 and not any("DICTIONARY" in e for e in meta.row_group(0).column(0).encodings)
