"""Declarative standardisation of a Bronze table into Silver shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conversions import convert, deleted


@dataclass(frozen=True)
class ControlColumns:
    """Names of the change-tracking columns every Bronze table carries."""

    company: str = "_empresa"
    deleted: str = "d_e_l_e_t_"
    record: str = "r_e_c_n_o_"
    stamp: str = "s_t_a_m_p_"
    batch: str = "_lote"


BRONZE = ControlColumns()


def standardise(df: DataFrame, mapping: dict[str, tuple[str, str]], control: ControlColumns = BRONZE,
                lenient: bool = False) -> DataFrame:
    """Project, rename and convert by ``mapping``; unmapped columns are dropped.

    One ``select``: Catalyst prunes the Parquet scan to the mapped columns and
    the conversions compile into the scan's codegen stage.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [F.trim(F.col(control.company)).alias("cod_empresa")]
    for source, (target, kind) in mapping.items():
        columns.append(convert(F.col(source), kind, types.get(source), lenient=lenient).alias(target))
    columns += [
        deleted(F.col(control.deleted)).alias("flg_deletado"),
        F.col(control.record).cast("long").alias("num_recno"),
        F.col(control.stamp).cast("timestamp").alias("dat_stamp"),
        F.col(control.batch).alias("_lote"),
    ]
    return df.select(*columns)


def conversion_rejects(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """Counted rejects of a lenient standardisation (hazard H3), one scan.

    For every date or decimal column of ``mapping``: rows whose source value is
    present and non-blank but converts to NULL (unparseable date, decimal
    overflow).  Use it as a gate next to ``standardise(..., lenient=True)``;
    the default strict mode fails the job on the first bad value instead.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = []
    for source, (target, kind) in mapping.items():
        if kind not in ("data", "decimal"):
            continue
        raw = F.col(source)
        present = raw.isNotNull() & (F.trim(raw.cast("string")) != "")
        converted = convert(raw, kind, types.get(source), lenient=True)
        checks.append(F.count(F.when(present & converted.isNull(), 1)).alias(target))
    if not checks:
        return df.sparkSession.range(1).select(F.lit(0).alias("_none")).limit(0)
    return df.agg(*checks)
