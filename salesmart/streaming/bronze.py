"""Load every landing file into Bronze exactly once (Structured Streaming).

A file-source stream over ``<landing>/<table>/empresa=*`` (files elsewhere are not
landing files, B2) with ``trigger(availableNow)``
processes the files that arrived since the last run and stops; the source's
checkpoint remembers loaded paths, so a rerun loads nothing twice (each
environment keeps its own checkpoint).  The Parquet file sink commits each
micro-batch to its ``_spark_metadata`` log, which batch readers of the Bronze
folder honour, so a half-written batch is never visible.

Provenance: ``_empresa`` from the path (B3), ``_arquivo`` = file path,
``_dt_ingestao`` = ingestion time (B4).  The landing is read with a canonical
explicit schema (decimal precision differs per landing file otherwise; the
company is kept as text).  Adding a column = restarting with the wider
schema on the same checkpoint (B5; ``schema_history`` keeps the schemas of all loads).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COMPANY_PATH_PATTERN, LANDING_FILE_GLOB
from .batch_index import METRIC, BatchIndex, committed_micro_batch, loaded_pairs


def landing_stream(spark: SparkSession, landing_table_dir: str, schema: T.StructType | str,
                   company_pattern: str = COMPANY_PATH_PATTERN, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", LANDING_FILE_GLOB)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.parquet(f"{landing_table_dir.rstrip('/')}/empresa=*")
    return raw.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_path"), company_pattern, 1).alias("_empresa"),
        F.col("_metadata.file_path").alias("_arquivo"),
        F.current_timestamp().alias("_dt_ingestao"),
    )


#: Batches that a task writes side by side; from there on it sorts its rows by batch.  A landing file holds one batch.
OPEN_BATCHES = 4


@contextmanager
def _open_files(spark: SparkSession, most: int):
    """Writes that start here keep so many partitions open instead of sorting all rows by partition first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def load_once(spark: SparkSession, landing_table_dir: str, bronze_dir: str, checkpoint_dir: str,
              schema: T.StructType | str, company_pattern: str = COMPANY_PATH_PATTERN,
              max_files_per_trigger: int | None = None, index: BatchIndex | None = None) -> int:
    """B1: run the stream until every available file is loaded; return rows appended.

    ``index`` follows the load: the newest batch of every company, for snapshot reads.
    """
    stream = landing_stream(spark, landing_table_dir, schema, company_pattern, max_files_per_trigger)
    if index is not None:
        if committed_micro_batch(spark, bronze_dir) is not None:
            index.follow(bronze_dir, read_bronze(spark, bronze_dir, schema))
        stream = stream.observe(METRIC, loaded_pairs())
    # The sum below needs the progress of every micro-batch, not of the latest hundred.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(2**31 - 1))
    with _open_files(spark, OPEN_BATCHES):
        query = (stream.writeStream.format("parquet")
                 .option("path", bronze_dir)
                 .option("checkpointLocation", checkpoint_dir)
                 .partitionBy("_lote")                   # S7, S8 and Q8 then read only the batches they ask for
                 .outputMode("append")
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if index is not None:
        index.advance(bronze_dir, [(x["company"], x["batch"]) for p in query.recentProgress
                                   for x in (p.observedMetrics[METRIC]["pairs"] if METRIC in p.observedMetrics else [])])
    return sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)


def bronze_schema(landing_schema: T.StructType | str) -> T.StructType:
    """Columns of Bronze: the landing's plus provenance."""
    base = T._parse_datatype_string(landing_schema) if isinstance(landing_schema, str) else landing_schema
    return T.StructType([*base.fields, T.StructField("_empresa", T.StringType()), T.StructField("_arquivo", T.StringType()),
                         T.StructField("_dt_ingestao", T.TimestampType())])


def read_bronze(spark: SparkSession, bronze_dir: str, landing_schema: T.StructType | str | None = None) -> DataFrame:
    """Committed Bronze rows (the sink's log hides uncommitted files).

    With the landing schema no file footer is opened to plan the read, and a column that early files
    lack is NULL in their rows (B5); without it the schemas of all files are merged.
    """
    if landing_schema is None:
        return spark.read.option("mergeSchema", "true").parquet(bronze_dir)
    return spark.read.schema(bronze_schema(landing_schema)).parquet(bronze_dir)


def register_bronze(spark: SparkSession, table: str, bronze_dir: str, comment: str) -> None:
    """External table over the Bronze folder, with its description."""
    safe = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{bronze_dir}' COMMENT '{safe}'")
