"""Calendar attributes of a date column, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MONTH_NAMES


def month_name(date_col: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.element_at(names, F.month(date_col))


def calendar_columns(date_col: str = "dat_data") -> list[Column]:
    d = F.col(date_col)
    return [
        d.alias("dat_data"),
        F.year(d).alias("num_ano"),
        F.month(d).alias("num_mes"),
        month_name(d).alias("des_mes"),
        F.quarter(d).alias("num_trimestre"),
        F.date_format(d, "yyyy-MM").alias("des_ano_mes"),
        F.dayofweek(d).alias("num_dia_semana"),   # 1 = Sunday
    ]
