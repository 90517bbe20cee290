"""Queries over the test tables, one per operator group of the inventory.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables.  The role mapping is in ``sources.testdata``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audits, control, quality, watermark
from ..operators import dimensions as dims
from ..operators import fact as fact_ops
from ..operators.standardise import standardise
from ..operators.upsert import (BUCKET, bucket_key_counts, read_bucketed, read_newest_batch, upsert, upsert_touched_buckets,
                                write_latest)
from ..operators.versions import batches_after, latest_snapshot, latest_version, newest_batch, version_method
from ..sources import testdata as td
from ..sources.extract import persist_control, run_extraction
from ..sources.footers import footer_table
from ..sources.landing import cutoff, read_manifests, write_batch
from ..streaming.bronze import bronze_schema, load_once, read_bronze, register_bronze
from ..streaming.manifest_load import load_listed, read_listed
from ..streaming.schema_history import SchemaHistory
from ..session import materialize, scratch_path
from . import event_feed
from .marts import TOTAL, SalesStar
from .measures import MeasureStore, changed_orders, of_orders, retractions
from .pipeline import Domain, SourceTable, daily_load, extract_and_load, landing_schema
from .tables import VersionedCatalog

# Fixed parameters of the test queries.
UPSERT_SPLIT = "1999-01-01"                         # target = versions shipped before, source = the rest
EVENT_WATERMARK = _dt.datetime(2024, 1, 20)         # previous high-water mark of the event stream
RUN_AT = _dt.datetime(2024, 1, 31, 9, 0)            # "now" of a simulated extraction run
UPSERT_BUCKETS = 32                                 # key buckets of the bucketed Silver layout
ORDER_BUCKETS = 8                                   # buckets of stored Silver clustered by the order key
# A fixed load timestamp keeps results reproducible (G6 takes it as a parameter).
LOAD_TS = "2001-08-02 06:00:00"
# "Today" for the calendar bounds (G12), fixed for the same reason.
TODAY = "2001-08-01"


def silver_orders(spark: SparkSession, d: str) -> DataFrame:
    # o_orderkey is unique, so each header has one version: standardising is enough.
    return standardise(td.bronze_orders(spark, d), td.ORDER_MAP)


def silver_lines(spark: SparkSession, d: str) -> DataFrame:
    return latest_version(standardise(td.bronze_lines(spark, d), td.LINE_MAP), order=td.LINE_VERSION_ORDER)


def silver_customers(spark: SparkSession, d: str) -> DataFrame:
    return standardise(td.bronze_customers(spark, d), td.CUSTOMER_MAP)


def silver_sellers(spark: SparkSession, d: str) -> DataFrame:
    return standardise(td.bronze_sellers(spark, d), td.SELLER_MAP)


def silver_products(spark: SparkSession, d: str) -> DataFrame:
    return standardise(td.bronze_products(spark, d), td.PRODUCT_MAP)


def gold_fact(spark: SparkSession, d: str) -> DataFrame:
    return fact_ops.order_fact(silver_orders(spark, d), silver_lines(spark, d), keys=td.FACT_KEYS,
                               header_columns=td.FACT_HEADER_COLUMNS, loaded_at=LOAD_TS)


def star(spark: SparkSession, d: str) -> SalesStar:
    return SalesStar(
        fact=gold_fact(spark, d),
        unit=td.units(spark, d),
        product=dims.dim_product(silver_products(spark, d)),
        seller=dims.dim_seller(silver_sellers(spark, d)),
        customer=dims.dim_customer(silver_customers(spark, d)),
    )


# --- registered queries ----------------------------------------------------

def q_standardise_orders(spark, d):
    return silver_orders(spark, d)


def q_latest_line_version(spark, d):
    return silver_lines(spark, d)


def q_latest_event_snapshot(spark, d):
    """Events of the newest day of each event type."""
    return latest_snapshot(td.events_stream(spark, d), company="_empresa", batch="_lote")


def q_snapshot_by_index(spark, d):
    """S7 + S11 on Bronze by the load's batch index; the 'error' company is absent from the newest batch."""
    feed = event_feed.run_full(spark, d)
    return latest_snapshot(feed.bronze, "_empresa", "_lote", newest=feed.index.newest()).select(
        "event_id", "s_t_a_m_p_", "user_id", "event_type", "value", "props", "_lote", "_empresa")


def q_upsert_lines(spark, d):
    """S6 + S8 + S9: target = latest versions shipped before the split; the source is
    every batch newer than the target's newest batch, deduplicated, then upserted."""
    std = standardise(td.bronze_lines(spark, d), td.LINE_MAP)
    target = latest_version(std.filter(F.col("dat_stamp") < F.lit(UPSERT_SPLIT).cast("timestamp")),
                            order=td.LINE_VERSION_ORDER)
    last = newest_batch(target)
    source = latest_version(batches_after(std, last), order=td.LINE_VERSION_ORDER)
    return upsert(target, source)


def q_upsert_lines_bucketed(spark, d):
    """S9 at scale: the target is stored by key bucket and only touched buckets are rewritten."""
    std = standardise(td.bronze_lines(spark, d), td.LINE_MAP)
    target = std.filter(F.col("dat_stamp") < F.lit(UPSERT_SPLIT).cast("timestamp"))
    root = scratch_path(spark, "silver_lines")
    write_latest(target, f"{root}/table", order=td.LINE_VERSION_ORDER, buckets=UPSERT_BUCKETS)
    stored = read_bucketed(spark, f"{root}/table")
    source = latest_version(batches_after(std, newest_batch(stored)), order=td.LINE_VERSION_ORDER)
    upsert_touched_buckets(f"{root}/table", source, f"{root}/staging", buckets=UPSERT_BUCKETS)
    return read_bucketed(spark, f"{root}/table").drop(BUCKET)


def q_key_gate_incremental(spark, d):
    """Q9 from the counts kept with each bucket version, after three loads; the last brings every line with item
    number 7 twice.  Only buckets that a load touched are grouped."""
    std = standardise(td.bronze_lines(spark, d), td.LINE_MAP)
    root = scratch_path(spark, "silver_lines")
    for load, cut in enumerate(MEASURE_CUTS):
        known = std if cut is None else std.filter(F.col("dat_stamp") < F.lit(cut).cast("timestamp"))
        if load == 0:
            write_latest(known, f"{root}/table", order=td.LINE_VERSION_ORDER, buckets=UPSERT_BUCKETS)
            continue
        changes = latest_version(batches_after(known, read_newest_batch(spark, f"{root}/table")), order=td.LINE_VERSION_ORDER)
        if cut is None:
            changes = changes.unionByName(changes.filter(F.col("cod_item") == "7"))
        upsert_touched_buckets(f"{root}/table", changes, f"{root}/staging{load}", buckets=UPSERT_BUCKETS)
    return quality.key_gate_rows(bucket_key_counts(spark, f"{root}/table"), "silver.lines")


def q_reprocess_lines_bucketed(spark, d):
    """S10 on the bucketed layout: a table of all latest versions is reprocessed from the earlier
    versions alone (fewer rows, another bucket count)."""
    std = standardise(td.bronze_lines(spark, d), td.LINE_MAP)
    path = scratch_path(spark, "silver_lines")
    write_latest(std, path, order=td.LINE_VERSION_ORDER, buckets=UPSERT_BUCKETS)
    earlier = std.filter(F.col("dat_stamp") < F.lit(UPSERT_SPLIT).cast("timestamp"))
    write_latest(earlier, path, order=td.LINE_VERSION_ORDER, buckets=UPSERT_BUCKETS // 4)
    return read_bucketed(spark, path).drop(BUCKET)


def q_upsert_conditions(spark, d):
    """S9 case by case, told by the item number: 1 target only, 2 older source, 3 equal stamp, 4 newer source
    (NULL stamp for invoice note A), 5 NULL key on both sides, 6 NULL target stamp, 7 source only."""
    lines = silver_lines(spark, d)
    item = F.col("cod_item")
    company = F.when(item != "5", F.col("cod_empresa")).alias("cod_empresa")
    day = F.expr("INTERVAL 1 DAY")
    stamp = F.col("dat_stamp")
    target = lines.filter(item != "7").select(
        company, "num_recno", F.when(item != "6", stamp).alias("dat_stamp"), "cod_item", F.lit("destino").alias("origem"))
    source = lines.filter(item != "1").select(
        company, "num_recno",
        F.when(item == "2", stamp - day).when((item == "4") & (F.col("num_nota") == "A"), F.lit(None))
        .when(item == "4", stamp + day).otherwise(stamp).alias("dat_stamp"),
        "cod_item", F.lit("origem").alias("origem"))
    return upsert(target, source)


def q_date_texts(spark, d):
    """S3 on text dates: yyyyMMdd, and blanks for deleted headers."""
    bronze = td.bronze_orders(spark, d)
    text = F.when(F.col("d_e_l_e_t_") == "*", F.lit("        ")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return standardise(bronze.withColumn("o_orderdate", text), td.ORDER_MAP)


def _event_items(spark, d):
    ev = td.events_stream(spark, d)
    return ev.select("*", F.lit("events").alias("tabela"), F.col("event_type").alias("empresa"))


def _previous_event_control(spark, d):
    """Control rows of the event stream as a previous run left them (watermark = EVENT_WATERMARK)."""
    ev = _event_items(spark, d)
    return (ev.select("tabela", "empresa").distinct()
            .select("tabela", "empresa", F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(True).alias("ativo"),
                    F.lit(EVENT_WATERMARK).cast("timestamp").alias("ultimo_watermark"),
                    F.lit("SUCESSO").alias("status_ultima_carga"),
                    F.lit(EVENT_WATERMARK).cast("timestamp").alias("data_ultima_execucao"),
                    F.lit(None).cast("long").alias("qtd_ultima_carga")))


def q_incremental_events(spark, d):
    """Rows stamped after the watermark minus the 10-minute overlap."""
    return watermark.extract(td.read(spark, d, "events"), watermark.INCREMENTAL, EVENT_WATERMARK, stamp="ts")


def q_next_watermark(spark, d):
    """X2 + X5 + X13 for every (table, company) item at once."""
    ev = _event_items(spark, d)
    ctl = persist_control(spark, _previous_event_control(spark, d), scratch_path(spark, "control"))
    items = [r.asDict() for r in control.active_items(ctl).collect()]        # one row per table and company
    extracted = watermark.extract_items(ev, items, "empresa", stamp="ts")
    advanced = watermark.next_watermark(ctl, extracted, stamp="ts", counted="qtd")
    results = advanced.select("tabela", "empresa", F.lit(control.SUCCESS).alias("status"),
                              F.col("ultimo_watermark").alias("novo_watermark"), "qtd")
    return control.record_results(ctl, results, now=RUN_AT)


def _sync_inputs(spark, d):
    """Configuration: the event stream by type and the orders by priority; the previous
    control table also holds the line items by return flag, which the config dropped."""
    ev_items = _event_items(spark, d).select("tabela", "empresa").distinct()
    orders = td.read(spark, d, "orders").select(F.lit("orders").alias("tabela"),
                                                F.col("o_orderpriority").alias("empresa")).distinct()
    items = (ev_items.select("*", F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(True).alias("ativo"))
             .unionByName(orders.select("*", F.lit("FULL").alias("tipo_carga"), F.lit(True).alias("ativo"))))
    li = (td.read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("empresa"))
          .agg(F.max("l_shipdate").cast("timestamp").alias("ultimo_watermark"),
               F.count(F.lit(1)).alias("qtd_ultima_carga"))
          .select(F.lit("lineitem").alias("tabela"), F.concat(F.col("empresa"), F.lit(" ")).alias("empresa"),
                  F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(True).alias("ativo"), "ultimo_watermark",
                  F.lit("SUCESSO").alias("status_ultima_carga"),
                  F.lit(RUN_AT).cast("timestamp").alias("data_ultima_execucao"), "qtd_ultima_carga"))
    previous = _previous_event_control(spark, d).unionByName(li)
    return previous, items


def q_control_sync(spark, d):
    """X11: configured items upserted, watermarks kept, unconfigured rows deactivated."""
    previous, items = _sync_inputs(spark, d)
    return control.sync(previous, items)


def q_control_active(spark, d):
    """Active items in extraction order."""
    previous, items = _sync_inputs(spark, d)
    return control.active_items(control.sync(previous, items))


def q_control_failure(spark, d):
    """X13 + X14: the items of type 'error' fail and keep watermark and count, the others advance."""
    ctl = _previous_event_control(spark, d)
    failed = F.col("empresa") == "error"
    results = (_event_items(spark, d).groupBy("tabela", "empresa")
               .agg(F.max("ts").cast("timestamp").alias("novo_watermark"), F.count(F.lit(1)).alias("qtd"))
               .withColumn("status", F.when(failed, control.FAILURE).otherwise(control.SUCCESS)))
    return control.record_results(ctl, results, now=RUN_AT)


def q_config_items(spark, d):
    """A configuration file made from the tables (one entry without ``ativo``), read into items."""
    listed = _event_items(spark, d).groupBy("tabela").agg(F.collect_set("empresa").alias("empresas")).select(
        "tabela", F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(False).alias("ativo"), "empresas")
    orders = td.read(spark, d, "orders").agg(F.collect_set("o_orderpriority").alias("empresas")).select(
        F.lit("orders").alias("tabela"), F.lit("FULL").alias("tipo_carga"), F.lit(None).cast("boolean").alias("ativo"),
        "empresas")
    path = scratch_path(spark, "config")
    entries = listed.unionByName(orders)
    (entries.agg(F.collect_list(F.struct(*entries.columns)).alias("tabelas"))
     .select(F.lit("erp").alias("sistema"), "tabelas").coalesce(1).write.json(path))
    return control.read_config(spark, path)


def q_control_switches(spark, d):
    """One item off, one table off, one watermark rewound, one table set to a full reload."""
    previous, items = _sync_inputs(spark, d)
    synced = control.sync(previous, items)
    switched = control.set_active(control.set_active(synced, "events", "error", False), "orders", None, False)
    rewound = control.rewind_watermark(switched, "lineitem", "A", EVENT_WATERMARK)
    return control.rewind_watermark(rewound, "events", None, None)


def q_order_fact(spark, d):
    return gold_fact(spark, d)


def stored_silver(spark, d) -> VersionedCatalog:
    """Headers and lines as stored Silver tables, clustered by the order key."""
    cat = VersionedCatalog(spark, scratch_path(spark, "silver"), f"silver_{uuid.uuid4().hex[:8]}")
    for name, df in (("orders", silver_orders(spark, d)), ("lineitem", silver_lines(spark, d))):
        cat.publish(df, name, clustered=(ORDER_BUCKETS, td.FACT_KEYS))
    return cat


def q_order_fact_stored(spark, d):
    """G2-G6 over stored Silver clustered by the order key: joined without an exchange."""
    cat = stored_silver(spark, d)
    return fact_ops.order_fact(cat.table("orders"), cat.table("lineitem"), keys=td.FACT_KEYS,
                               header_columns=td.FACT_HEADER_COLUMNS, loaded_at=LOAD_TS)


def q_dim_customer(spark, d):
    return dims.dim_customer(silver_customers(spark, d))


def q_dim_seller(spark, d):
    return dims.dim_seller(silver_sellers(spark, d))


def q_dim_product(spark, d):
    return dims.dim_product(silver_products(spark, d))


def q_dim_unit(spark, d):
    return td.units(spark, d)


def q_calendar(spark, d):
    return dims.calendar_for_fact(gold_fact(spark, d), today=TODAY)


def q_sales_dataset(spark, d):
    return star(spark, d).dataset()


def q_last_refresh(spark, d):
    return star(spark, d).last_refresh()


def q_value_sold(spark, d):
    return star(spark, d).value_sold()


def q_open_value(spark, d):
    return star(spark, d).open_value()


def q_sales_by_month(spark, d):
    return star(spark, d).sales_by_month()


def q_sales_by_unit(spark, d):
    return star(spark, d).sales_by_unit()


def q_open_by_seller(spark, d):
    return star(spark, d).open_by_seller()


MEASURE_CUTS = ["1996-01-01", "1999-01-01", None]    # the loads: line versions shipped before


def headers_at(headers: DataFrame, load: int) -> DataFrame:
    """Headers as of a load (1-3): deletions arrive with loads 2 and 3 (odd and even orders), and every third
    order is moved from branch 00 to its own with load 3."""
    number = F.col("cod_pedido").cast("long")
    deleted = F.col("flg_deletado") & {1: F.lit(False), 2: number % 2 == 1, 3: F.lit(True)}[load]
    branch = F.when((number % 3 == 0) & F.lit(load < 3), F.lit("00")).otherwise(F.col("cod_filial"))
    return headers.withColumns({"flg_deletado": deleted, "cod_filial": branch})


def q_maintained_measures(spark, d):
    """V3-V7 maintained over three loads with new line versions, deleted orders and moved orders.

    Headers and changes are stored before they are used more than once, with the columns that reach the sums."""
    store = MeasureStore(spark, scratch_path(spark, "measures"))
    std = standardise(td.bronze_lines(spark, d), td.LINE_MAP).drop("num_nota")
    method = version_method(std)
    stored = materialize(silver_orders(spark, d).select(*td.FACT_KEYS, *td.FACT_HEADER_COLUMNS, "flg_deletado", "num_recno"), "headers")
    changed = [*td.FACT_KEYS, "num_recno"]
    before = (None, None)
    for load, cut in enumerate(MEASURE_CUTS, 1):
        known = std if cut is None else std.filter(F.col("dat_stamp") < F.lit(cut).cast("timestamp"))
        items, headers = materialize(latest_version(known, order=td.LINE_VERSION_ORDER, method=method), "items"), headers_at(stored, load)
        orders = None
        if load > 1:
            changes = [latest_version(batches_after(known, newest_batch(before[0])), order=td.LINE_VERSION_ORDER, method=method),
                       headers.exceptAll(before[1])]
            changes = [materialize(c.select(*changed), "changes") for c in changes]
            orders = materialize(changed_orders(changes, before, td.FACT_KEYS), "changed_orders")
        facts = [None if h is None else fact_ops.order_fact(
            h if orders is None else of_orders(h, orders, td.FACT_KEYS), i if orders is None else of_orders(i, orders, td.FACT_KEYS),
            td.FACT_KEYS, td.FACT_HEADER_COLUMNS, LOAD_TS) for i, h in (before, (items, headers))]
        store.add(f"load{load}", retractions(facts[0], facts[1]))
        store.add(f"load{load}", retractions(None, facts[1]))     # a repeated load counts once
        before = (items, headers)
        if load == 2:
            store.compact()
    return store.measures(td.units(spark, d), dims.dim_seller(silver_sellers(spark, d)))


def q_gate_duplicates(spark, d):
    """Q1 on the raw line versions: repeated (company, record) keys."""
    return quality.duplicate_keys_df(standardise(td.bronze_lines(spark, d), td.LINE_MAP), ["cod_empresa", "num_recno"])


def q_gate_nulls(spark, d):
    """Q2 on the dashboard dataset: rows missing a product, seller or customer description."""
    return quality.null_rows_df(star(spark, d).dataset(), ["des_produto", "des_vendedor", "des_cliente"])


def q_gate_orphans(spark, d):
    """Q3: seller keys of the fact missing from the seller dimension (deleted sellers)."""
    s = star(spark, d)
    return quality.orphans_df(s.fact, s.seller, ["cod_empresa", "cod_vendedor"])


def q_gate_negatives(spark, d):
    """Q4 over customer balances and nation keys in one scan."""
    return quality.negatives_df(td.read(spark, d, "customer"), ["c_acctbal", "c_nationkey"])


def q_gate_reconcile(spark, d):
    """Q5 + Q8: per-(day, type) counts declared for the event stream against the counts
    that landed; the landing lost the 'error' file of the last day."""
    ev = td.events_stream(spark, d)
    declared = ev.groupBy(F.col("_lote").alias("lote"), F.col("_empresa").alias("empresa")).agg(
        F.count(F.lit(1)).alias("registros")).withColumn("tabela", F.lit("events"))
    last_day = newest_batch(ev)
    landed = ev.filter(~((F.col("_empresa") == "error") & (F.col("_lote") == F.lit(last_day))))
    counts = quality.batch_counts(landed, "events")
    return quality.reconcile(declared, counts)


def q_gate_reconcile_null_keys(spark, d):
    """Q5 where one company is NULL on both sides: its items match no landed count, however many rows landed."""
    ev = td.events_stream(spark, d).withColumn("_empresa", F.nullif(F.col("_empresa"), F.lit("error")))
    counts = quality.batch_counts(ev, "events")
    return quality.reconcile(counts.withColumnRenamed("qtd_bronze", "registros"), counts)


def gate_report_df(spark, d) -> DataFrame:
    # The Silver lines feed a key gate and the fact, and the fact feeds five gates:
    # each is written once under the shared folder and read back (lineage cut there).
    lines = materialize(silver_lines(spark, d), "silver_lines")
    orders = silver_orders(spark, d)
    s = star(spark, d)
    s.fact = fact_ops.order_fact(orders, lines, keys=td.FACT_KEYS, header_columns=td.FACT_HEADER_COLUMNS,
                                 loaded_at=LOAD_TS)
    s.fact = materialize(s.fact, "fact")
    silver = {
        "silver.orders": orders,
        "silver.lines": lines,
        "silver.customers": silver_customers(spark, d),
        "silver.sellers": silver_sellers(spark, d),
        "silver.products": silver_products(spark, d),
    }
    parts = [quality.key_gate(df, name, ["cod_empresa", "num_recno"]) for name, df in silver.items()]
    dims_by_name = {"dim_cliente": s.customer, "dim_vendedor": s.seller, "dim_produto": s.product,
                    "dim_unidade": s.unit}
    parts.append(quality.integrity_gate(s.fact, dims_by_name, {
        "dim_cliente": ["cod_empresa", "cod_cliente", "cod_loja"],
        "dim_vendedor": ["cod_empresa", "cod_vendedor"],
        "dim_produto": ["cod_empresa", "cod_produto"],
        "dim_unidade": ["cod_empresa", "cod_filial"],
    }))
    parts.append(quality.value_gate(s.fact, ["qtd_vendida", "vlr_unitario", "vlr_total"]))
    return quality.gate_report(parts)


def q_gate_report(spark, d):
    """Q9 + Q10 + Q12 + Q13: every gate as (gate, object, failures, detail)."""
    return gate_report_df(spark, d)


def q_item_value_audit(spark, d):
    """R1 over the latest line versions."""
    return audits.item_value_audit(silver_lines(spark, d))


def q_tax_id_audit(spark, d):
    """R2: 14-digit ids built from customer and nation keys, checked in one scan."""
    c = td.read(spark, d, "customer")
    docs = c.select(F.concat(F.lpad(F.col("c_custkey").cast("string"), 12, "0"),
                             F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("documento"))
    return audits.tax_id_audit(docs, "documento")


def q_bronze_load_once(spark, d):
    """B1-B4 + X2/X7/X9: raw Bronze after two extraction runs and a rerun of the load; rows inside the
    overlap land twice, a file outside the landing pattern never."""
    feed = event_feed.run(spark, d)
    return feed.bronze.select(
        "event_id", "s_t_a_m_p_", "user_id", "event_type", "value", "props", "_lote", "_empresa",
        F.regexp_extract("_arquivo", event_feed.COMPANY_PATTERN, 1).alias("empresa_arquivo"),
        F.col("_dt_ingestao").isNotNull().alias("tem_ingestao"), F.lit(feed.loaded_rerun).cast("long").alias("recarga"))


def q_bronze_load_listed(spark, d):
    """B1-B4 by manifest: the feed's two batches, the first loaded a second time after its mark was lost, then a rerun."""
    root = event_feed.run(spark, d, per_table=True).root
    bronze, marks = f"{root}/listed/events", [f"{root}/listed/marks{k}" for k in range(2)]
    pattern = event_feed.COMPANY_PATTERN
    for m in marks:                                  # marks of their own: the second load repeats the first
        load_listed(spark, root, "events", bronze, m, event_feed.LANDING_SCHEMA, pattern)
    rerun = load_listed(spark, root, "events", bronze, marks[1], event_feed.LANDING_SCHEMA, pattern)
    return read_listed(spark, bronze, event_feed.LANDING_SCHEMA).select(
        "event_id", "s_t_a_m_p_", "user_id", "event_type", "value", "props", "_lote", "_empresa",
        F.regexp_extract("_arquivo", pattern, 1).alias("empresa_arquivo"),
        F.col("_dt_ingestao").isNotNull().alias("tem_ingestao"), F.lit(rerun).cast("long").alias("recarga"))


def q_manifest_items(spark, d):
    """X8 + Q6: manifest items written by the two extraction runs (one scan per table)."""
    return event_feed.run(spark, d, per_table=True).manifests


def q_manifests_since(spark, d):
    """Q7: manifest items of the last seven days before the second run."""
    root = event_feed.run(spark, d, per_table=True).root
    return read_manifests(spark, root, since=cutoff(7, RUN_AT))


def q_bronze_reconcile(spark, d):
    """Q5 + Q6 + Q8 on the real landing: declared and loaded counts of every batch, and whether the gate
    reports it; extraction with one scan per table."""
    feed = event_feed.run(spark, d, per_table=True)
    counts = quality.batch_counts(feed.bronze, "events")
    key = ["lote", "tabela", "empresa"]
    differing = quality.reconcile(feed.manifests, counts).select(*key, F.lit(True).alias("divergente"))
    return (feed.manifests.join(counts, key, "full_outer").join(differing, key, "left")
            .withColumn("divergente", F.coalesce("divergente", F.lit(False))))


def tpch_domain(d: str) -> Domain:
    """The test tables as a pipeline domain (roles as in ``sources.testdata``)."""
    return Domain(
        tables={
            "orders": SourceTable("orders", td.ORDER_MAP, "INCREMENTAL"),
            "lineitem": SourceTable("lineitem", td.LINE_MAP, "INCREMENTAL", order=td.LINE_VERSION_ORDER),
            "customer": SourceTable("customer", td.CUSTOMER_MAP, "FULL"),
            "supplier": SourceTable("supplier", td.SELLER_MAP, "FULL"),
            "part": SourceTable("part", td.PRODUCT_MAP, "FULL"),
        },
        header="orders", item="lineitem", customer="customer", seller="supplier", product="part",
        units=lambda spark: td.units(spark, d), fact_keys=td.FACT_KEYS, fact_header_columns=td.FACT_HEADER_COLUMNS)


def tpch_bronze(spark, d) -> dict[str, DataFrame]:
    return {"orders": td.bronze_orders(spark, d), "lineitem": td.bronze_lines(spark, d),
            "customer": td.bronze_customers(spark, d), "supplier": td.bronze_sellers(spark, d),
            "part": td.bronze_products(spark, d)}


def q_daily_load(spark, d):
    """C7 end to end on the test tables: Silver and Gold versions, then the gate report.
    Deleted sellers leave orphan fact rows, so the new Gold is not published."""
    report = daily_load(spark, tpch_domain(d), tpch_bronze(spark, d), scratch_path(spark, "lake"),
                        env=f"t{uuid.uuid4().hex[:8]}", today=TODAY, loaded_at=LOAD_TS, raise_on_failure=False)
    rows = [(g["gate"], g["objeto"], g["qtd_falhas"], g["detalhe"]) for g in report.gates]
    return spark.createDataFrame(rows, quality.GATE_SCHEMA)


def q_extract_and_load(spark, d):
    """C8 + C7 + G13: two runs of the whole chain (sync, extract, load once, Silver, Gold, gates, publish) over all
    tables; the first sees the line versions shipped before the split.  No seller is deleted, so
    both publish; the maintained measures follow.  Read from the committed snapshot."""
    sources = {name: df.drop("_lote").withColumnRenamed("_empresa", "empresa") for name, df in tpch_bronze(spark, d).items()}
    sources["supplier"] = sources["supplier"].withColumn("d_e_l_e_t_", F.lit(" "))
    domain, root, env = tpch_domain(d), scratch_path(spark, "chain"), f"x{uuid.uuid4().hex[:8]}"
    items = spark.createDataFrame([(t, td.COMPANY, s.load_type, True) for t, s in domain.tables.items()], control.CONFIG_SCHEMA)
    schemas = {n: landing_schema(df) for n, df in sources.items()}
    store = MeasureStore(spark, f"{root}/measures")
    early = sources["lineitem"].filter(F.col("s_t_a_m_p_") < F.lit(UPSERT_SPLIT).cast("timestamp"))
    for batch, lines in (("20010731T000000Z", early), (td.SNAPSHOT_BATCH, sources["lineitem"])):
        extract_and_load(spark, domain, None, items, {**sources, "lineitem": lines}, f"{root}/landing", f"{root}/lake", schemas,
                         env=env, batch=batch, now=_dt.datetime.strptime(batch, "%Y%m%dT%H%M%SZ"), per_table=True,
                         today=TODAY, loaded_at=LOAD_TS, measures=store)
    gold = VersionedCatalog(spark, f"{root}/lake", f"{env}_gold").snapshot()
    sales = SalesStar(gold["fato_pedido_venda"], gold["dim_unidade"], gold["dim_produto"], gold["dim_vendedor"], gold["dim_cliente"])
    by_seller = store.measures(gold["dim_unidade"], gold["dim_vendedor"]).where("medida = 'carteira_por_vendedor'")
    return (sales.dataset(["des_vendedor", "vlr_total", "vlr_saldo"]).groupBy("des_vendedor")
            .agg(F.count(F.lit(1)).alias("itens"), F.sum("vlr_total").cast(TOTAL).alias("vlr_vendido"), F.sum("vlr_saldo").cast(TOTAL).alias("vlr_carteira"))
            .join(by_seller.select(F.col("chave").alias("des_vendedor"), F.col("valor").alias("vlr_carteira_mantida")), "des_vendedor", "left"))


def q_extract_isolated(spark, d):
    """X9 + X14: the extraction of the 'error' item fails; the others land and advance, it keeps its watermark.
    The control rows after the run, with what landed."""
    source = td.read(spark, d, "events").withColumnRenamed("ts", "s_t_a_m_p_")
    broken = source.withColumn("value", F.when(F.col("event_type") == "error", F.raise_error(F.lit("source gone")).cast("double"))
                               .otherwise(F.col("value")))
    root = scratch_path(spark, "isolated")
    run = run_extraction(spark, _previous_event_control(spark, d), {"events": broken}, root, company_col="event_type",
                         batch=event_feed.SECOND_BATCH, now=RUN_AT, raise_on_failure=False)
    landed = (spark.read.schema(event_feed.LANDING_SCHEMA).parquet(f"{root}/events").groupBy(F.col("event_type").alias("empresa"))
              .agg(F.count(F.lit(1)).alias("qtd_pouso")))
    declared = read_manifests(spark, root).select("empresa", F.col("registros").alias("qtd_manifesto"))
    return run.control.join(landed, "empresa", "left").join(declared, "empresa", "left")


def q_bronze_table(spark, d):
    """The Bronze table in the catalog, created once with its description; its rows by company and batch."""
    feed = event_feed.run(spark, d, per_table=True)
    name = f"bronze_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'bronze')}'")
    for _ in range(2):
        register_bronze(spark, f"{name}.events", f"{feed.root}/bronze/events", "Events as received: it's append-only")
    about = spark.catalog.getTable(f"{name}.events").description
    return spark.table(f"{name}.events").groupBy("_empresa", "_lote").agg(
        F.count(F.lit(1)).alias("registros"), F.count("value").alias("com_valor")).withColumn("descricao", F.lit(about))


SCHEMA_CUTS = ["2024-01-11", "2024-01-21", None]      # the loads: events before
EVENT_SCHEMAS = [["int event_id", "timestamp_ntz s_t_a_m_p_", "string event_type", "float value"],
                 ["long event_id", "timestamp_ntz s_t_a_m_p_", "int user_id", "string event_type", "float value"],
                 ["long event_id", "timestamp_ntz s_t_a_m_p_", "long user_id", "string event_type", "double value", "string props"]]


def q_bronze_schema_history(spark, d):
    """Three loads, each with a schema of its own (columns added, types widened), read by their merged schema."""
    root = scratch_path(spark, "schema_history")
    history, bronze_dir = SchemaHistory(spark, f"{root}/schemas"), f"{root}/bronze/events"
    events = td.read(spark, d, "events").withColumnRenamed("ts", "s_t_a_m_p_")
    at, since = F.col("s_t_a_m_p_"), None
    for k, (cut, columns) in enumerate(zip(SCHEMA_CUTS, EVENT_SCHEMAS, strict=True), 1):
        rows = events if since is None else events.filter(at >= F.lit(since).cast("timestamp_ntz"))
        rows = rows if cut is None else rows.filter(at < F.lit(cut).cast("timestamp_ntz"))
        since = cut
        shaped = rows.select(*[F.col(name).cast(kind).alias(name) for kind, name in (c.split() for c in columns)])
        write_batch(shaped, f"{root}/landing", "events", "01", f"{k}")
        schema = history.record(landing_schema(shaped))
        load_once(spark, f"{root}/landing/events", bronze_dir, f"{root}/_checkpoint", schema)
    return read_bronze(spark, bronze_dir, history.read_schema()).drop("_arquivo", "_dt_ingestao").withColumn(
        "versoes", F.lit(len(history.versions())))


def q_footer_counts(spark, d):
    """Q8 + G12 from Parquet footers: rows of each batch of Bronze, and the first emission date of a stored fact."""
    feed = event_feed.run(spark, d, per_table=True)
    bronze = footer_table(spark, f"{feed.root}/bronze/events", bronze_schema(event_feed.LANDING_SCHEMA))
    counts = bronze.groupBy(F.col("_lote").alias("lote")).agg(F.count(F.lit(1)).alias("linhas")).withColumn("tabela", F.lit("events"))
    path = scratch_path(spark, "fact")
    gold_fact(spark, d).write.parquet(path)
    first = footer_table(spark, path).agg(F.min("dat_emissao").alias("dat_inicio"), F.count(F.lit(1)).alias("linhas"))
    return counts.withColumn("dat_inicio", F.lit(None).cast("date")).unionByName(
        first.select("dat_inicio", "linhas", F.lit("fato_pedido_venda").alias("tabela"), F.lit(None).cast("string").alias("lote")))


def q_comment_coverage(spark, d):
    """G13 + G14 + Q11: publish the Gold tables as versions with their descriptions and
    report, from the catalog, which tables and columns are described."""
    cat = VersionedCatalog(spark, scratch_path(spark, "gold"), f"gold_{uuid.uuid4().hex[:8]}")
    s = star(spark, d)
    tables = {"fato_pedido_venda": s.fact, "dim_cliente": s.customer, "dim_vendedor": s.seller,
              "dim_produto": s.product, "dim_unidade": s.unit}
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:      # independent writes run together
        written = {name: pool.submit(cat.write_version, df, name) for name, df in tables.items()}
        written = {name: f.result() for name, f in written.items()}
    published = {}
    for name, (path, rows) in written.items():                      # catalog changes one at a time
        cat.point_to(name, path)
        published[name] = rows
    # the calendar reads the fact version just published instead of recomputing it
    calendar = dims.calendar_for_fact(cat.table("fato_pedido_venda"), today=TODAY)
    published["dim_calendario"] = cat.publish(calendar, "dim_calendario")["rows"]
    rows = []
    for t in spark.catalog.listTables(cat.database):
        desc, cols = cat.describe(t.name)
        rows.append((t.name, bool(desc and desc.strip()), len(cols), sum(1 for v in cols.values() if v),
                     published.get(t.name)))
    return spark.createDataFrame(
        rows, "tabela string, com_descricao boolean, colunas int, colunas_descritas int, registros long")


def q_restored_version(spark, d):
    """A second version doubles the prices, then the first is restored."""
    cat = VersionedCatalog(spark, scratch_path(spark, "gold"), f"restore_{uuid.uuid4().hex[:8]}")
    products = dims.dim_product(silver_products(spark, d))
    cat.publish(products, "dim_produto", "1")
    cat.publish(cat.table("dim_produto").withColumn(
        "vlr_preco_venda", (F.col("vlr_preco_venda") * 2).cast(products.schema["vlr_preco_venda"].dataType)),
        "dim_produto", "2")
    cat.restore("dim_produto", "1")
    return cat.table("dim_produto")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "standardise_orders": q_standardise_orders,
    "latest_line_version": q_latest_line_version,
    "latest_event_snapshot": q_latest_event_snapshot,
    "snapshot_by_index": q_snapshot_by_index,
    "upsert_lines": q_upsert_lines,
    "upsert_lines_bucketed": q_upsert_lines_bucketed,
    "key_gate_incremental": q_key_gate_incremental,
    "reprocess_lines_bucketed": q_reprocess_lines_bucketed,
    "upsert_conditions": q_upsert_conditions,
    "date_texts": q_date_texts,
    "incremental_events": q_incremental_events,
    "next_watermark": q_next_watermark,
    "control_sync": q_control_sync,
    "control_active": q_control_active,
    "control_failure": q_control_failure,
    "config_items": q_config_items,
    "control_switches": q_control_switches,
    "order_fact": q_order_fact,
    "order_fact_stored": q_order_fact_stored,
    "dim_customer": q_dim_customer,
    "dim_seller": q_dim_seller,
    "dim_product": q_dim_product,
    "dim_unit": q_dim_unit,
    "calendar": q_calendar,
    "sales_dataset": q_sales_dataset,
    "last_refresh": q_last_refresh,
    "value_sold": q_value_sold,
    "open_value": q_open_value,
    "sales_by_month": q_sales_by_month,
    "sales_by_unit": q_sales_by_unit,
    "open_by_seller": q_open_by_seller,
    "maintained_measures": q_maintained_measures,
    "gate_duplicates": q_gate_duplicates,
    "gate_nulls": q_gate_nulls,
    "gate_orphans": q_gate_orphans,
    "gate_negatives": q_gate_negatives,
    "gate_reconcile": q_gate_reconcile,
    "gate_reconcile_null_keys": q_gate_reconcile_null_keys,
    "gate_report": q_gate_report,
    "bronze_load_once": q_bronze_load_once,
    "bronze_load_listed": q_bronze_load_listed,
    "manifest_items": q_manifest_items,
    "manifests_since": q_manifests_since,
    "bronze_reconcile": q_bronze_reconcile,
    "restored_version": q_restored_version,
    "daily_load": q_daily_load,
    "extract_and_load": q_extract_and_load,
    "extract_isolated": q_extract_isolated,
    "bronze_table": q_bronze_table,
    "bronze_schema_history": q_bronze_schema_history,
    "footer_counts": q_footer_counts,
    "comment_coverage": q_comment_coverage,
    "item_value_audit": q_item_value_audit,
    "tax_id_audit": q_tax_id_audit,
}
