"""B1 by manifest: load the files that new manifests name, without listing the landing.

A run lists the manifest folder, reads the manifests newer than the last one it has marked, and appends the folders they
name for its table.  Bronze is partitioned by batch and a batch's partition is overwritten, so a load
that dies before its mark is repeated with the same result: nothing is loaded twice, nothing is lost.
Folders that no manifest names are never opened; an interrupted extraction's manifest is completed by the next
extraction (``extract.complete_manifest``) before any later one is written, so batches are marked in order.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COMPANY_PATH_PATTERN
from ..sources.files import create_text, names_below
from ..sources.landing import MANIFEST_SCHEMA
from .bronze import bronze_schema


def new_batches(spark: SparkSession, landing_root: str, marks_dir: str) -> list[str]:
    """Batches with a manifest that no mark covers, oldest first."""
    marked = [n.removesuffix(".json") for n in names_below(spark, marks_dir) if n.endswith(".json")]
    last = max(marked, default="")
    return [n for n in names_below(spark, f"{landing_root.rstrip('/')}/_manifest") if n > last]


def load_listed(spark: SparkSession, landing_root: str, table: str, bronze_dir: str, marks_dir: str, schema: T.StructType | str,
                company_pattern: str = COMPANY_PATH_PATTERN) -> int:
    """Load ``table`` from all new manifests; return the rows that they declare."""
    root = landing_root.rstrip("/")
    batches = new_batches(spark, root, marks_dir)
    if not batches:
        return 0
    manifests = spark.read.schema(MANIFEST_SCHEMA).json([f"{root}/_manifest/{b}" for b in batches])
    items = (manifests.select("lote", F.explode("itens").alias("item")).where((F.col("item.tabela") == table) & (F.col("item.registros") > 0))
             .select("lote", "item.arquivo", "item.registros").collect())          # companies x new batches
    if items:
        rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[i.arquivo for i in items]).select(
            "*", F.regexp_extract(F.col("_metadata.file_path"), company_pattern, 1).alias("_empresa"),
            F.col("_metadata.file_path").alias("_arquivo"), F.current_timestamp().alias("_dt_ingestao"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_lote").parquet(bronze_dir))
    create_text(spark, f"{marks_dir.rstrip('/')}/{batches[-1]}.json", json.dumps({"batches": batches}))
    return sum(i.registros for i in items)


def read_listed(spark: SparkSession, bronze_dir: str, landing_schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(bronze_schema(landing_schema)).parquet(bronze_dir)
