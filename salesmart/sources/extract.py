"""The extraction run as Spark jobs.

The source system is any Spark relation per table (``spark.read.jdbc`` with a
partition column, or Parquet), with a company column.  For every active
control item, the run reads the item's rows (everything for FULL and first
loads, ``stamp > watermark - overlap`` otherwise; both predicates reach the
source), writes them as a new landing batch, and derives the next watermark
from the same write.  A failing item is recorded and the others continue; the
run fails at the end if any item failed.  Order of effects per run: files
(each item's result is logged as it finishes), then the control table, then the manifest.
A new driver continues from ``load_control``.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_OVERLAP_MINUTES
from ..operators import control as ctl
from ..operators.watermark import INCREMENTAL, extract, extract_items, next_watermark_value
from .landing import (LANDING_BATCH, LANDING_COMPANY, batch_dir, list_names, new_batch_id, path_exists, remove_dir, write_batch,
                      write_manifest)

log = logging.getLogger(__name__)


@dataclass
class RunSummary:
    batch: str
    items: list[dict] = field(default_factory=list)
    failures: list[dict] = field(default_factory=list)
    control: DataFrame | None = None


class ExtractionFailed(RuntimeError):
    def __init__(self, summary: RunSummary):
        super().__init__(f"{len(summary.failures)} extraction item(s) failed: {summary.failures}")
        self.summary = summary


def run_extraction(spark: SparkSession, control: DataFrame, sources: dict[str, DataFrame], landing_root: str,
                   company_col: str = "empresa", stamp: str = "s_t_a_m_p_",
                   overlap_minutes: int = DEFAULT_OVERLAP_MINUTES, batch: str | None = None,
                   now: _dt.datetime | None = None, parallelism: int = 4, raise_on_failure: bool = True,
                   per_table: bool = False) -> RunSummary:
    """X9 over the active items of ``control`` (X12); returns the updated control.

    By default each (table, company) item is its own job, isolated like the
    source system's extractor.  With ``per_table`` each table is read once and
    written once, partitioned by company (same landing layout), which avoids
    one scan per company when the source relation is not split by company;
    a failure then marks every item of that table.
    """
    summary = RunSummary(batch=batch or new_batch_id(now))
    complete_manifest(spark, landing_root, now)
    control = persist_control(spark, control, landing_root)
    # the control table is tables x companies: a bounded list for the driver loop
    items = [r.asDict() for r in ctl.active_items(control).collect()]
    if per_table:
        return _finish(spark, control, summary, _extract_tables(
            spark, items, sources, landing_root, company_col, stamp, overlap_minutes, summary.batch, parallelism, now),
            landing_root, now, raise_on_failure)

    def one(item: dict) -> dict:
        table, company = item["tabela"], item["empresa"]
        try:
            source = sources[table].filter(F.col(company_col) == F.lit(company))
            rows = extract(source, item["tipo_carga"], item["ultimo_watermark"], overlap_minutes, stamp)
            n, newest, path = write_batch(rows, landing_root, table, company, summary.batch, stamp)
            wm = item["ultimo_watermark"]
            if item["tipo_carga"] == INCREMENTAL:
                wm = next_watermark_value(wm, [newest])
            return {"tabela": table, "empresa": company, "tipo_carga": item["tipo_carga"], "registros": n,
                    "arquivo": path, "status": ctl.SUCCESS, "novo_watermark": wm}
        except Exception as err:  # noqa: BLE001 - isolate the item, keep going
            log.exception("extraction of %s/%s failed", table, company)
            return {"tabela": table, "empresa": company, "status": ctl.FAILURE, "erro": str(err)}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        outcomes = list(pool.map(lambda item: record_outcomes(spark, landing_root, [one(item)], now, summary.batch)[0], items))
    return _finish(spark, control, summary, outcomes, landing_root, now, raise_on_failure)


def _extract_tables(spark: SparkSession, items: list[dict], sources: dict[str, DataFrame], root: str, company_col: str,
                    stamp: str, overlap_minutes: int, batch: str, parallelism: int,
                    now: _dt.datetime | None) -> list[dict]:
    by_table: dict[str, list[dict]] = {}
    for item in items:
        by_table.setdefault(item["tabela"], []).append(item)

    def one_table(table: str) -> list[dict]:
        group = by_table[table]
        try:
            source = sources[table]
            obs = Observation(f"landing_{table}_{batch}")
            metrics = []
            for i, item in enumerate(group):
                hit = F.col(company_col) == F.lit(item["empresa"])
                metrics += [F.count(F.when(hit, 1)).alias(f"n{i}"), F.max(F.when(hit, F.col(stamp))).alias(f"m{i}")]
            out = (extract_items(source, group, company_col, overlap_minutes, stamp)
                   .withColumn("_lote", F.lit(batch))
                   .withColumn(LANDING_COMPANY, F.col(company_col)).withColumn(LANDING_BATCH, F.lit(batch))
                   .observe(obs, *metrics))
            out.write.mode("append").partitionBy(LANDING_COMPANY, LANDING_BATCH).parquet(f"{root.rstrip('/')}/{table}")
            got = obs.get
            results = []
            for i, item in enumerate(group):
                n, newest = int(got.get(f"n{i}") or 0), got.get(f"m{i}")
                wm = item["ultimo_watermark"]
                if item["tipo_carga"] == INCREMENTAL:
                    wm = next_watermark_value(wm, [newest])
                results.append({"tabela": table, "empresa": item["empresa"], "tipo_carga": item["tipo_carga"],
                                "registros": n, "arquivo": batch_dir(root, table, item["empresa"], batch) if n else None,
                                "status": ctl.SUCCESS, "novo_watermark": wm})
            return results
        except Exception as err:  # noqa: BLE001 - isolate the table, keep going
            log.exception("extraction of %s failed", table)
            return [{"tabela": table, "empresa": item["empresa"], "status": ctl.FAILURE, "erro": str(err)}
                    for item in group]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = pool.map(lambda table: record_outcomes(spark, root, one_table(table), now, batch), list(by_table))
        return [o for outcomes in done for o in outcomes]


def _finish(spark: SparkSession, control: DataFrame, summary: RunSummary, outcomes: list[dict], landing_root: str,
            now: _dt.datetime | None, raise_on_failure: bool) -> RunSummary:
    for o in outcomes:
        (summary.items if o["status"] == ctl.SUCCESS else summary.failures).append(o)

    summary.control = ctl.record_results(control, _results(spark, outcomes, now), now=now)
    summary.control = persist_control(spark, summary.control, landing_root)
    write_manifest(spark, landing_root, summary.batch, summary.items, generated_at=now)
    if summary.failures and raise_on_failure:
        raise ExtractionFailed(summary)
    return summary


def _results(spark: SparkSession, outcomes: list[dict], now: _dt.datetime | None) -> DataFrame:
    """Outcomes (one per table and company) as result rows."""
    when = now or _dt.datetime.now(_dt.UTC).replace(tzinfo=None)
    return spark.createDataFrame(
        [(o["tabela"], o["empresa"], o["status"], o.get("novo_watermark"), o.get("registros"), when) for o in outcomes],
        f"{ctl.RESULT_SCHEMA}, quando timestamp")


def _new_entry() -> str:
    return _dt.datetime.now(_dt.UTC).strftime("%Y%m%dT%H%M%S%fZ") + "_" + uuid.uuid4().hex[:6]


LOG_SCHEMA = f"{ctl.RESULT_SCHEMA}, quando timestamp, lote string, tipo_carga string, arquivo string"


def record_outcomes(spark: SparkSession, root: str, outcomes: list[dict], now: _dt.datetime | None,
                    batch: str | None = None) -> list[dict]:
    """Log finished items at once, so that a driver lost later in the run does not lose them."""
    if outcomes:
        files = spark.createDataFrame([(o["tabela"], o["empresa"], batch, o.get("tipo_carga"), o.get("arquivo")) for o in outcomes],
                                      "tabela string, empresa string, lote string, tipo_carga string, arquivo string")
        _results(spark, outcomes, now).join(files, ["tabela", "empresa"]).coalesce(1).write.mode("errorifexists") \
            .parquet(f"{root.rstrip('/')}/_control_log/{_new_entry()}")
    return outcomes


def _complete(spark: SparkSession, root: str, folder: str) -> list[str]:
    return [n for n in list_names(spark, f"{root}/{folder}") if path_exists(spark, f"{root}/{folder}/{n}/_SUCCESS")]


def complete_manifest(spark: SparkSession, root: str, now: _dt.datetime | None = None) -> str | None:
    """Write the manifest of the last run from its log, if its driver was lost before it did; the batch or None.

    Only the last run can lack one, as every run starts here.
    """
    root = root.rstrip("/")
    logged = _complete(spark, root, "_control_log")
    if not logged:
        return None
    batch = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_control_log/{logged[-1]}").first().lote
    if batch is None or path_exists(spark, f"{root}/_manifest/{batch}/_SUCCESS"):
        return None
    remove_dir(spark, f"{root}/_manifest/{batch}")
    rows = (spark.read.schema(LOG_SCHEMA).parquet(*[f"{root}/_control_log/{n}" for n in logged])
            .where((F.col("lote") == batch) & (F.col("status") == ctl.SUCCESS)).collect())         # items of one run
    write_manifest(spark, root, batch, [{"tabela": r.tabela, "empresa": r.empresa, "tipo_carga": r.tipo_carga, "registros": r.qtd or 0,
                                         "arquivo": r.arquivo} for r in rows], generated_at=now)
    return batch


def persist_control(spark: SparkSession, control: DataFrame, root: str) -> DataFrame:
    """Write the (small) control table as a new version and read it back, cutting lineage."""
    path = f"{root.rstrip('/')}/_control/{_new_entry()}"
    control.coalesce(1).write.mode("errorifexists").parquet(path)
    return spark.read.schema(control.schema).parquet(path)


def load_control(spark: SparkSession, root: str) -> DataFrame:
    """The stored control table: its newest complete version, and what items logged after it (a run
    starts by storing its control, so the log of an interrupted run names an item once)."""
    root = root.rstrip("/")

    versions = _complete(spark, root, "_control")
    if not versions:
        return ctl.empty_control(spark)
    control = spark.read.schema(ctl.CONTROL_SCHEMA).parquet(f"{root}/_control/{versions[-1]}")
    later = [f"{root}/_control_log/{n}" for n in _complete(spark, root, "_control_log") if n > versions[-1]]
    if not later:
        return control
    return ctl.record_results(control, spark.read.schema(f"{ctl.RESULT_SCHEMA}, quando timestamp").parquet(*later))
