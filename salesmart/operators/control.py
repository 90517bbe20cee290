"""The extraction control table as DataFrame transformations.

Control row: tabela, empresa, tipo_carga, ativo, ultimo_watermark,
status_ultima_carga, data_ultima_execucao, qtd_ultima_carga; key (tabela, empresa).
The table is small (tables x companies); every step is a join on the key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL_SCHEMA = ("tabela string, empresa string, tipo_carga string, ativo boolean, ultimo_watermark timestamp, "
                  "status_ultima_carga string, data_ultima_execucao timestamp, qtd_ultima_carga long")
CONFIG_SCHEMA = "tabela string, empresa string, tipo_carga string, ativo boolean"
CONTROL_COLUMNS = ["tabela", "empresa", "tipo_carga", "ativo", "ultimo_watermark", "status_ultima_carga",
                   "data_ultima_execucao", "qtd_ultima_carga"]
KEY = ["tabela", "empresa"]
SUCCESS = "SUCESSO"
FAILURE = "FALHA"


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL_SCHEMA)


def config_items(config: DataFrame) -> DataFrame:
    """Explode the JSON configuration (one row per table) into (table, company) items.

    ``ativo`` defaults to true when absent.
    """
    cols = config.columns
    active = F.coalesce(F.col("ativo"), F.lit(True)) if "ativo" in cols else F.lit(True)
    return config.select(
        F.col("tabela"), F.explode("empresas").alias("empresa"), F.col("tipo_carga"), active.alias("ativo"))


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """X15 from a multi-line JSON file with an explicit schema."""
    schema = ("sistema string, tabelas array<struct<tabela: string, tipo_carga: string, ativo: boolean, "
              "empresas: array<string>>>")
    raw = spark.read.schema(schema).option("multiLine", "true").json(path)
    return config_items(raw.select(F.explode("tabelas").alias("t")).select("t.*"))


def sync(control: DataFrame, items: DataFrame) -> DataFrame:
    """X11: upsert configured items (type and active flag from config, watermark and
    history kept); control rows absent from the config become inactive.

    One full outer join on (tabela, trimmed empresa).
    """
    c = control.withColumn("empresa", F.trim("empresa")).alias("c")
    i = items.select(*KEY, F.col("tipo_carga").alias("_cfg_tipo"), F.col("ativo").alias("_cfg_ativo"),
                     F.lit(True).alias("_in_cfg")).alias("i")
    j = c.join(i, KEY, "full_outer")
    in_cfg = F.col("_in_cfg").isNotNull()
    return j.select(
        "tabela", "empresa",
        F.when(in_cfg, F.col("_cfg_tipo")).otherwise(F.col("tipo_carga")).alias("tipo_carga"),
        F.when(in_cfg, F.col("_cfg_ativo")).otherwise(F.lit(False)).alias("ativo"),
        "ultimo_watermark", "status_ultima_carga", "data_ultima_execucao", "qtd_ultima_carga",
    )


def active_items(control: DataFrame) -> DataFrame:
    """Active rows ordered by table and company (company trimmed)."""
    return (control.filter(F.col("ativo"))
            .select("tabela", F.trim("empresa").alias("empresa"), "tipo_carga", "ultimo_watermark")
            .orderBy("tabela", "empresa"))


RESULT_SCHEMA = "tabela string, empresa string, status string, novo_watermark timestamp, qtd long"


def record_results(control: DataFrame, results: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """Apply run results (tabela, empresa, status, novo_watermark, qtd).

    Success sets watermark, status, run time and row count; failure sets status
    and run time and keeps watermark and count.  Rows without a result are kept.
    A result's own time (optional column ``quando``) comes before ``now``.
    """
    stamp = F.lit(now or _dt.datetime.now(_dt.UTC).replace(tzinfo=None)).cast("timestamp")
    if "quando" in results.columns:
        stamp = F.coalesce("_quando", stamp)
    else:
        results = results.withColumn("quando", F.lit(None).cast("timestamp"))
    r = results.select(*KEY, F.col("quando").alias("_quando"), F.col("status").alias("_st"), F.col("novo_watermark").alias("_wm"),
                       F.col("qtd").alias("_qtd"))
    j = control.join(r, KEY, "left")
    ok = F.col("_st") == SUCCESS
    has = F.col("_st").isNotNull()
    return j.select(
        "tabela", "empresa", "tipo_carga", "ativo",
        F.when(ok, F.col("_wm")).otherwise(F.col("ultimo_watermark")).alias("ultimo_watermark"),
        F.when(has, F.col("_st")).otherwise(F.col("status_ultima_carga")).alias("status_ultima_carga"),
        F.when(has, stamp).otherwise(F.col("data_ultima_execucao")).alias("data_ultima_execucao"),
        F.when(ok, F.col("_qtd")).otherwise(F.col("qtd_ultima_carga")).alias("qtd_ultima_carga"),
    )


def set_active(control: DataFrame, table: str, company: str | None, active: bool) -> DataFrame:
    """Switch a table (optionally one company) on or off."""
    hit = F.col("tabela") == table
    if company is not None:
        hit = hit & (F.trim("empresa") == company)
    return control.withColumn("ativo", F.when(hit, F.lit(active)).otherwise(F.col("ativo")))


def rewind_watermark(control: DataFrame, table: str, company: str | None, watermark) -> DataFrame:
    """Manual watermark rewind (``None`` forces a full reload of that item)."""
    hit = F.col("tabela") == table
    if company is not None:
        hit = hit & (F.trim("empresa") == company)
    value = F.lit(watermark).cast("timestamp")
    return control.withColumn("ultimo_watermark", F.when(hit, value).otherwise(F.col("ultimo_watermark")))
