"""The event table run through the ingestion path: extract -> landing -> Bronze.

Two extraction runs of the event stream (company = event type): the first
sees the source as it was before 2024-01-15 (first load, everything); the
second sees the whole table and reads incrementally from each type's
watermark minus the overlap.  Both land as batches, then the load-once stream
moves every landing file into Bronze (and a rerun adds nothing).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import control as ctl
from ..session import scratch_path
from ..sources import testdata as td
from ..sources.extract import run_extraction
from ..sources.landing import read_manifests
from ..streaming.batch_index import BatchIndex
from ..streaming.bronze import load_once, read_bronze

FIRST_CUT = "2024-01-15 00:00:00"
FIRST_BATCH = "20240115T000000Z"
SECOND_BATCH = "20240131T090000Z"
COMPANY_PATTERN = r"empresa=([^/]+)"
LANDING_SCHEMA = ("event_id long, s_t_a_m_p_ timestamp_ntz, user_id long, event_type string, value double, "
                  "props string, _lote string")


@dataclass
class EventFeed:
    root: str
    bronze: DataFrame
    manifests: DataFrame
    loaded_first: int
    loaded_rerun: int
    index: BatchIndex | None = None


def run(spark: SparkSession, sf_dir: str, per_table: bool = False) -> EventFeed:
    """Two extraction runs and two load-once passes; ``per_table`` picks the extraction mode."""
    root = scratch_path(spark, "event_feed")
    source = td.read(spark, sf_dir, "events").withColumnRenamed("ts", "s_t_a_m_p_")
    before = source.filter(F.col("s_t_a_m_p_") < F.lit(FIRST_CUT).cast("timestamp_ntz"))
    types = source.select(F.lit("events").alias("tabela"), F.col("event_type").alias("empresa"),
                          F.lit("INCREMENTAL").alias("tipo_carga"), F.lit(True).alias("ativo")).distinct()
    control = ctl.sync(ctl.empty_control(spark), types)
    first = run_extraction(spark, control, {"events": before}, root, company_col="event_type",
                           batch=FIRST_BATCH, now=_dt.datetime(2024, 1, 15), per_table=per_table)
    run_extraction(spark, first.control, {"events": source}, root, company_col="event_type",
                   batch=SECOND_BATCH, now=_dt.datetime(2024, 1, 31, 9), per_table=per_table)
    landing, bronze_dir, ckpt = f"{root}/events", f"{root}/bronze/events", f"{root}/_checkpoints/bronze_events"
    # a file outside empresa=* is not a landing file (B2)
    types.write.mode("errorifexists").parquet(f"{landing}/outro")
    n1 = load_once(spark, landing, bronze_dir, ckpt, LANDING_SCHEMA, company_pattern=COMPANY_PATTERN)
    n2 = load_once(spark, landing, bronze_dir, ckpt, LANDING_SCHEMA, company_pattern=COMPANY_PATTERN)
    return EventFeed(root, read_bronze(spark, bronze_dir, LANDING_SCHEMA), read_manifests(spark, root), n1, n2)


def run_full(spark: SparkSession, sf_dir: str, absent: str = "error") -> EventFeed:
    """The same table as FULL loads: the second run finds no rows of the ``absent`` company, which so lands
    nothing and keeps its first snapshot.  Each load maintains the batch index."""
    root = scratch_path(spark, "event_feed")
    source = td.read(spark, sf_dir, "events").withColumnRenamed("ts", "s_t_a_m_p_")
    items = source.select(F.lit("events").alias("tabela"), F.col("event_type").alias("empresa"),
                          F.lit("FULL").alias("tipo_carga"), F.lit(True).alias("ativo")).distinct()
    control = ctl.sync(ctl.empty_control(spark), items)
    landing, bronze_dir = f"{root}/events", f"{root}/bronze/events"
    index = BatchIndex(spark, f"{root}/_batches/events")
    loaded = []
    for rows, batch, now in ((source.filter(F.col("s_t_a_m_p_") < F.lit(FIRST_CUT).cast("timestamp_ntz")), FIRST_BATCH, _dt.datetime(2024, 1, 15)),
                             (source.filter(F.col("event_type") != absent), SECOND_BATCH, _dt.datetime(2024, 1, 31, 9))):
        run_extraction(spark, control, {"events": rows}, root, company_col="event_type", batch=batch, now=now, per_table=True)
        loaded.append(load_once(spark, landing, bronze_dir, f"{root}/_checkpoints/bronze_events", LANDING_SCHEMA,
                                company_pattern=COMPANY_PATTERN, index=index))
    return EventFeed(root, read_bronze(spark, bronze_dir, LANDING_SCHEMA), read_manifests(spark, root), loaded[0], loaded[1], index)
