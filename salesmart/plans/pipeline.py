"""The daily load job and the extract-and-load chain.

Stages run in dependency order on one session:
Bronze (load-once streams) -> Silver (five tables, concurrently) -> Gold
dimensions, fact and calendar as *new versions* -> quality gates on those
versions, the documentation gate included -> only if every gate passes are they committed by
one pointer and the Gold tables re-pointed at them (bad data never reaches the dashboard).  A source table that
never landed is left out with the Gold tables that need it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import (DEFAULT_OVERLAP_MINUTES, DEFAULT_RECONCILE_DAYS, ERP_MAPPINGS, FACT_HEADER_COLUMNS,
                      FACT_KEYS, FACT_NON_NEGATIVE, FACT_RELATIONS, LOAD_TYPES, SILVER_KEYS,
                      VERSION_ORDER)
from ..operators import dimensions as dims
from ..operators import quality
from ..operators.control import sync
from ..operators.fact import order_fact
from ..operators.standardise import conversion_rejects, standardise
from ..operators.upsert import (BUCKET, Bucketing, bucket_key_counts, committed_versions, prune_bucketed, read_bucketed,
                                read_newest_batch, upsert, upsert_touched_buckets, write_latest)
from ..operators.versions import batches_after, latest_snapshot, latest_version, newest_batch, version_method
from ..operators.watermark import FULL
from ..sources.extract import load_control, run_extraction
from ..sources.footers import footer_table
from ..sources.landing import cutoff, path_exists, read_manifests
from ..session import materialize, scratch_path
from ..streaming.batch_index import BatchIndex
from ..streaming.bronze import load_once, read_bronze, register_bronze
from ..streaming.schema_history import SchemaHistory
from .measures import MeasureStore, changed_orders
from .tables import VersionedCatalog


@dataclass(frozen=True)
class SourceTable:
    """One source table.  ``buckets`` (incremental tables only; a hash bucket
    count or a ``Bucketing``, e.g. record-id ranges) keeps the Silver table in
    the key-bucket layout and upserts only the buckets the day's changes touch,
    instead of writing a whole new version every run; such a table is read with
    ``read_silver``, not from the catalog."""

    name: str
    mapping: dict
    load_type: str
    order: tuple = VERSION_ORDER
    keys: tuple = SILVER_KEYS
    buckets: int | Bucketing | None = None
    lenient: bool = False       # bad dates/decimals become NULL and are counted by a gate


@dataclass(frozen=True)
class Domain:
    """Which Silver table plays which role, and how the fact is joined."""

    tables: dict[str, SourceTable]
    header: str
    item: str
    customer: str
    seller: str
    product: str
    units: Callable[[SparkSession], DataFrame]
    fact_keys: tuple = FACT_KEYS
    fact_header_columns: tuple = FACT_HEADER_COLUMNS
    order_buckets: int | None = None    # store versioned headers and items clustered by the order key


ERP_DOMAIN = Domain(
    tables={t: SourceTable(t, m, LOAD_TYPES[t]) for t, m in ERP_MAPPINGS.items()},
    header="sc5", item="sc6", customer="sa1", seller="sa3", product="sb1",
    units=dims.dim_unit,
)


@dataclass
class LoadReport:
    silver: dict = field(default_factory=dict)
    gold: dict = field(default_factory=dict)
    gates: list = field(default_factory=list)
    published: bool = False


def bucketed_path(silver: VersionedCatalog, table: str) -> str:
    return f"{silver.root}/{silver.database}/{table}/bucketed"


def read_silver(spark: SparkSession, spec: SourceTable, silver: VersionedCatalog) -> DataFrame:
    if spec.buckets and spec.load_type != FULL:
        return read_bucketed(spark, bucketed_path(silver, spec.name)).drop(BUCKET)
    return silver.table(spec.name)


def silver_state(spark: SparkSession, spec: SourceTable, silver: VersionedCatalog) -> str | None:
    """What names the current content of a Silver table."""
    if spec.buckets and spec.load_type != FULL:
        return (committed_versions(spark, bucketed_path(silver, spec.name)) or [None])[-1]
    return silver.current_location(spec.name)


def silver_exists(spark: SparkSession, spec: SourceTable, silver: VersionedCatalog) -> bool:
    if spec.buckets and spec.load_type != FULL:
        return bool(committed_versions(spark, bucketed_path(silver, spec.name)))
    return silver.exists(spec.name)


def build_silver(spark: SparkSession, spec: SourceTable, bronze: DataFrame, silver: VersionedCatalog,
                 reprocess: bool = False, newest: dict | None = None, clustered: tuple | None = None) -> dict:
    """S1 + S6..S11 for one table; publishes a new Silver version (or, for a
    bucketed incremental table, a version of the touched buckets).  ``newest`` (company -> newest
    batch, from the load's index) prunes a FULL table's Bronze to its snapshots; ``clustered`` is the
    layout of a published version of an incremental table."""
    std = standardise(bronze, spec.mapping, lenient=spec.lenient)
    if spec.buckets and spec.load_type != FULL:
        path = bucketed_path(silver, spec.name)
        if committed_versions(spark, path) and not reprocess:
            last = read_newest_batch(spark, path) or newest_batch(read_bucketed(spark, path))   # S8
            before = read_bucketed(spark, path).drop(BUCKET)
            changes = materialize(latest_version(batches_after(std, last), spec.keys, spec.order), "silver_changes")
            touched = upsert_touched_buckets(path, changes, scratch_path(spark, "silver_staging", spec.name),
                                             spec.keys, buckets=spec.buckets)
            return {"table": spec.name, "path": path, "buckets_rewritten": len(touched), "changes": changes, "before": before}
        write_latest(std, path, spec.keys, spec.order, spec.buckets)
        return {"table": spec.name, "path": path, "buckets_rewritten": None}      # first load: all
    if spec.load_type == FULL:
        return silver.publish(latest_snapshot(std, newest=newest), spec.name)        # S7 + S11
    if silver.exists(spec.name) and not reprocess:
        target = spark.read.parquet(silver.current_location(spec.name))
        # The newest batch recorded at the last publish (no scan), else computed
        last = silver.newest_batch(spec.name) or newest_batch(target)
        fresh = batches_after(std, last)
        changes = materialize(latest_version(fresh, spec.keys, spec.order, version_method(fresh, spec.keys)), "silver_changes")    # S6
        done = silver.publish(upsert(target, changes, spec.keys), spec.name, clustered=clustered)    # S9
        return {**done, "changes": changes, "before": target}
    method = version_method(std, spec.keys)
    return silver.publish(latest_version(std, spec.keys, spec.order, method), spec.name, clustered=clustered)    # S10


def daily_load(spark: SparkSession, domain: Domain, bronze: dict[str, DataFrame], lake_root: str,
               env: str = "dev", reprocess: bool = False, today: _dt.date | str | None = None,
               loaded_at=None, manifests: DataFrame | None = None, bronze_counts: DataFrame | None = None,
               parallelism: int = 5, raise_on_failure: bool = True, check_fact_grain: bool = False,
               check_calendar: bool = False, keep_versions: int | None = None,
               newest: dict[str, dict] | None = None, measures: MeasureStore | None = None) -> LoadReport:
    """Silver -> Gold versions -> gates -> publish (the scheduler starts one run per environment at a time).

    ``check_fact_grain`` adds a uniqueness gate on the fact grain (duplicate live
    headers would fan the fact out); ``check_calendar`` adds the fact -> calendar
    relation to the integrity gate.  Both are off by default, as in the original pipeline.
    ``keep_versions`` deletes older Gold and Silver versions after a publish.
    ``newest`` holds the batch index of each FULL table (see ``streaming.batch_index``).
    ``measures`` follows each published fact by the orders that the run changed (see ``measures``).
    """
    return _daily_load(spark, domain, bronze, lake_root, env, reprocess, today, loaded_at, manifests,
                       bronze_counts, parallelism, raise_on_failure, check_fact_grain, check_calendar,
                       keep_versions, newest or {}, measures)


def _daily_load(spark, domain, bronze, lake_root, env, reprocess, today, loaded_at, manifests, bronze_counts,
                parallelism, raise_on_failure, check_fact_grain, check_calendar, keep_versions, newest, measures) -> LoadReport:
    report = LoadReport()
    silver = VersionedCatalog(spark, lake_root, f"{env}_silver")
    gold = VersionedCatalog(spark, lake_root, f"{env}_gold")

    base = gold.committed()[0]
    order_tables = [domain.header, domain.item]
    states = [{n: silver_state(spark, domain.tables[n], silver) for n in order_tables} if measures else {}]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        clustered = (domain.order_buckets, domain.fact_keys) if domain.order_buckets else None
        futures = {n: pool.submit(build_silver, spark, spec, bronze[n], silver, reprocess, newest.get(n),
                                  clustered if n in order_tables else None)
                   for n, spec in domain.tables.items() if n in bronze}
        report.silver = {n: f.result() for n, f in futures.items()}
    if measures:
        states.append({n: silver_state(spark, domain.tables[n], silver) for n in order_tables})
        made = [report.silver[n] for n in order_tables if n in report.silver]
        known = all("changes" in m for m in made)
        if states[0] != states[1]:
            measures.note(*states, changed_orders([m["changes"] for m in made], [m["before"] for m in made], domain.fact_keys) if known else None)

    s = {n: read_silver(spark, spec, silver) for n, spec in domain.tables.items() if silver_exists(spark, spec, silver)}
    builders = {
        "dim_cliente": ([domain.customer], lambda: dims.dim_customer(s[domain.customer])),
        "dim_vendedor": ([domain.seller], lambda: dims.dim_seller(s[domain.seller])),
        "dim_produto": ([domain.product], lambda: dims.dim_product(s[domain.product])),
        "dim_unidade": ([], lambda: domain.units(spark)),
        "fato_pedido_venda": ([domain.header, domain.item], lambda: order_fact(
            s[domain.header], s[domain.item], domain.fact_keys, domain.fact_header_columns, loaded_at)),
    }
    staged = {name: build() for name, (needs, build) in builders.items() if all(n in s for n in needs)}
    # independent writes: submitted together so the small dimension jobs overlap the fact job
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        written = {name: pool.submit(gold.write_version, df, name) for name, df in staged.items()}
        paths = {name: f.result()[0] for name, f in written.items()}
    fact_name = "fato_pedido_venda"
    if fact_name in paths:
        paths["dim_calendario"], _ = gold.write_version(
            dims.calendar_for_fact(footer_table(spark, paths[fact_name]), today), "dim_calendario")
    new = {n: spark.read.parquet(p) for n, p in paths.items()}
    report.gold = paths

    parts = [quality.key_gate_rows(bucket_key_counts(spark, bucketed_path(silver, n)), f"silver.{n}")
             if domain.tables[n].buckets and domain.tables[n].load_type != FULL
             else quality.key_gate(df, f"silver.{n}", list(domain.tables[n].keys)) for n, df in s.items()]
    if fact_name in new:
        fact = new[fact_name]
        relations = {dim: keys for dim, keys in FACT_RELATIONS.items() if dim in new}
        if check_calendar:                      # the emission date must exist in the calendar
            relations["dim_calendario"] = ["dat_data"]
            fact = fact.withColumn("dat_data", fact["dat_emissao"])
        parts.append(quality.integrity_gate(fact, new, relations))
        if check_fact_grain:
            parts.append(quality.key_gate(new[fact_name], f"gold.{fact_name}",
                                          ["cod_empresa", "cod_filial", "cod_pedido", "cod_item"]))
        parts.append(quality.value_gate(new[fact_name], FACT_NON_NEGATIVE))
    parts.append(quality.dictionary_gate(spark, gold.database, list(paths)))
    if manifests is not None and bronze_counts is not None:
        parts.append(quality.reconcile_gate(quality.reconcile(manifests, bronze_counts)))
    for n, spec in domain.tables.items():
        if spec.lenient and n in bronze:
            parts.append(quality.rejects_gate(conversion_rejects(bronze[n], spec.mapping), f"bronze.{n}"))
    report.gates = [r.asDict() for r in quality.gate_report(parts).collect()]   # a few dozen gate rows
    failing = [g for g in report.gates if g["qtd_falhas"] > 0]
    if failing:
        if raise_on_failure:
            raise quality.GateFailure("quality gates failed: " + "; ".join(
                f"{g['gate']} {g['objeto']}={g['qtd_falhas']}" for g in failing))
        return report

    served = gold.current_location(fact_name) if measures else None
    gold.commit(paths, base)                    # readers of the snapshot change over here, all tables at once
    for name, path in paths.items():
        gold.point_to(name, path)
    report.published = True
    if measures and fact_name in paths:
        measures.follow(_version_of(paths[fact_name]), new[fact_name], served and _version_of(served),
                        served and spark.read.parquet(served), states[1], domain.fact_keys)
    if keep_versions:
        for name in paths:
            gold.prune_versions(name, keep_versions)
        for name in s:
            if silver.exists(name):
                silver.prune_versions(name, keep_versions)
            else:
                prune_bucketed(spark, bucketed_path(silver, name))
    return report


def _version_of(path: str) -> str:
    return path.rstrip("/").rsplit("v=", 1)[-1]


def extract_and_load(spark: SparkSession, domain: Domain, control: DataFrame | None, config_items: DataFrame,
                     sources: dict[str, DataFrame], landing_root: str, lake_root: str,
                     schemas: dict[str, str], env: str = "dev", company_col: str = "empresa",
                     batch: str | None = None, now: _dt.datetime | None = None,
                     company_pattern: str | None = None, overlap_minutes: int = DEFAULT_OVERLAP_MINUTES,
                     reconcile_days: int = DEFAULT_RECONCILE_DAYS, per_table: bool = False,
                     **load_kwargs) -> tuple[DataFrame, LoadReport]:
    """Sync config -> extract -> load Bronze once -> daily load. Returns (control, report).

    ``control=None`` continues from the control stored below the landing, also after a failed or
    interrupted run.
    """
    synced = sync(load_control(spark, landing_root) if control is None else control, config_items)
    run = run_extraction(spark, synced, sources, landing_root, company_col=company_col,
                         overlap_minutes=overlap_minutes, batch=batch, now=now, per_table=per_table)
    bronze, newest = {}, {}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {env}_bronze LOCATION '{lake_root.rstrip('/')}/{env}_bronze'")
    extra = {"company_pattern": company_pattern} if company_pattern else {}
    since = cutoff(reconcile_days, now)          # Q7: reconcile the last N days only
    counts = []
    for name in domain.tables:
        landing = f"{landing_root.rstrip('/')}/{name}"
        if not path_exists(spark, landing):
            continue
        bronze_dir = f"{lake_root.rstrip('/')}/{env}_bronze/{name}"
        index = BatchIndex(spark, f"{lake_root.rstrip('/')}/_batches/{env}/{name}")
        schema = SchemaHistory(spark, f"{lake_root.rstrip('/')}/_schemas/{env}/{name}").record(schemas[name])     # B5
        load_once(spark, landing, bronze_dir, f"{lake_root.rstrip('/')}/_checkpoints/{env}/{name}",
                  schema, index=index, **extra)
        if domain.tables[name].load_type == FULL:
            newest[name] = index.newest()
        register_bronze(spark, f"{env}_bronze.{name}", bronze_dir, f"Bronze: {name} como recebida da origem, só acréscimos.")
        bronze[name] = read_bronze(spark, bronze_dir, schema)
        counts.append(quality.batch_counts(bronze[name], name, since=since))
    manifests = read_manifests(spark, landing_root, since=since)
    bronze_counts = None
    if counts:
        bronze_counts = counts[0]
        for c in counts[1:]:
            bronze_counts = bronze_counts.unionByName(c)
    report = daily_load(spark, domain, bronze, lake_root, env=env, manifests=manifests,
                        bronze_counts=bronze_counts, newest=newest, **load_kwargs)
    return run.control, report


def landing_schema(source: DataFrame) -> str:
    """Canonical landing schema of a source: its columns plus the batch id."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return ", ".join(fields + ["_lote string"])
