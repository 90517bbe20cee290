"""The schemas of all loads of a Bronze table, and the one schema that reads them all.

Every load records the schema its landing has; unchanged schemas are recorded once.  The read schema
is the merge of all versions: columns are added, types widen (the Parquet reader reads a narrower stored type
as the wider one), a column that later loads lack stays.  A change that loses values (text to number, say) is
refused when it is recorded, before anything is loaded.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.files import create_text, names_below, read_text

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


class SchemaConflict(ValueError):
    pass


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds all values of both and that both are read as."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if x in _WHOLE[:3] and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
        if isinstance(x, T.DecimalType) and y in _WHOLE:
            return wider(x, T.DecimalType(_DIGITS[y], 0))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise SchemaConflict(f"{a.simpleString()} and {b.simpleString()} have no common wider type")


def merged(schemas: list[T.StructType]) -> T.StructType:
    """Columns in the order they first came, each in its widest type; names compare without case."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            old = fields.get(f.name.lower())
            try:
                fields[f.name.lower()] = T.StructField(f.name if old is None else old.name,
                                                       f.dataType if old is None else wider(old.dataType, f.dataType))
            except SchemaConflict as e:
                raise SchemaConflict(f"column {f.name}: {e}") from None
    return T.StructType(list(fields.values()))


class SchemaHistory:
    """Versions below ``path`` as ``<n>.json``, written by the load of the table (one at a time)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[T.StructType]:
        out = []
        for n in sorted(n for n in names_below(self.spark, self.path) if n.endswith(".json")):
            try:
                out.append(T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/{n}"))))
            except ValueError:  # cut off while it was written; its load did not start
                continue
        return out

    def record(self, schema: T.StructType | str) -> T.StructType:
        """Add the landing schema of a load, if it is new, and return the schema to read and load with."""
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        known = self.versions()
        if schema not in known:
            known = [*known, schema]
            merged(known)
            taken = [int(n.removesuffix(".json")) for n in names_below(self.spark, self.path) if n.endswith(".json")]
            create_text(self.spark, f"{self.path}/{max(taken, default=0) + 1:06d}.json", json.dumps(schema.jsonValue()))
        return merged(known)

    def read_schema(self) -> T.StructType:
        return merged(self.versions())
