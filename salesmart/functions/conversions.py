"""Column conversions used by the Silver standardisation.

Each conversion is a plain Column expression, so the whole standardisation is
one projection inside whole-stage codegen.  The source type is known when the
plan is built, so a date conversion picks its expression from it: text in
``yyyyMMdd`` is parsed, a date or timestamp is cast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BLOCKED_MARKER, DELETED_MARKER, SOURCE_DATE_FORMAT

MONEY = T.DecimalType(14, 2)


def text(col: Column, dtype: T.DataType | None = None) -> Column:
    """Trimmed text; a blank value stays an empty string, not NULL."""
    return F.trim(col.cast("string"))


def source_date(col: Column, dtype: T.DataType | None = None, lenient: bool = False) -> Column:
    """``yyyyMMdd`` text -> date; blank -> NULL. Dates and timestamps are cast."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    trimmed = F.trim(col.cast("string"))
    parsed = (F.try_to_date if lenient else F.to_date)(trimmed, SOURCE_DATE_FORMAT)
    return F.when(trimmed == "", F.lit(None).cast("date")).otherwise(parsed)


def money(col: Column, dtype: T.DataType | None = None, lenient: bool = False) -> Column:
    """Fixed-point decimal(14,2); with ``lenient`` an overflow gives NULL."""
    return col.try_cast(MONEY) if lenient else col.cast(MONEY)


def blocked(col: Column, dtype: T.DataType | None = None) -> Column:
    return F.trim(col.cast("string")) == BLOCKED_MARKER


def deleted(col: Column) -> Column:
    return F.trim(col.cast("string")) == DELETED_MARKER


CONVERSIONS: dict[str, Callable[..., Column]] = {
    "texto": text,
    "data": source_date,
    "decimal": money,
    "bloqueio": blocked,
}


def convert(col: Column, kind: str, dtype: T.DataType | None = None, lenient: bool = False) -> Column:
    try:
        fn = CONVERSIONS[kind]
    except KeyError:
        raise ValueError(f"unknown conversion: {kind!r}") from None
    if kind in ("data", "decimal"):
        return fn(col, dtype, lenient=lenient)
    return fn(col, dtype)
