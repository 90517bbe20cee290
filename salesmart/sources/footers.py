"""Counts, minima and maxima of stored Parquet tables from its footers.

Spark's v2 Parquet source answers count, min and max from the footers when nothing but partition columns is filtered
or grouped, so no row is read.  The settings are needed while the relation is resolved (v2)
and while the query is planned (push-down), so the latter stays on; it concerns v2 scans only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_V1, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def footer_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table at ``path`` as a relation whose aggregates are pushed into the footers."""
    before = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    spark.conf.set(_PUSH, "true")
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    finally:
        spark.conf.set(_V1, before)
