"""Latest version per key, latest snapshot per company, new-batch filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SILVER_KEYS, VERSION_ORDER
from ..session import materialize


def sort_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys in an order that sorts fast: numbers before text, and the last text before the first.

    A sort compares eight bytes of its first column before it looks at whole rows.  Keys come as (company, ...) and all
    rows have the same few companies, so the company goes last.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return sorted(reversed(list(keys)), key=lambda k: isinstance(kinds.get(k), T.StringType))


#: Rows of a slice of the keys beyond twice the mean from which it counts as hot, and the number of slices.
HOT_ROWS, SLICES = 100_000, 1024


def version_method(df: DataFrame, keys: Sequence[str] = SILVER_KEYS) -> str:
    """How to find the latest versions of ``df`` or of a part of it: ``dealt``, or ``window`` where a slice of the keys has far more
    than its share of the rows (a key with very many versions, or very many NULL keys).  Counting the slices reads the keys only."""
    slices = df.groupBy(F.pmod(F.hash(*keys), F.lit(SLICES)).alias("_slice")).count()
    total, heaviest = slices.agg(F.sum("count"), F.max("count")).first()
    return "window" if (heaviest or 0) > 2 * (total or 0) / SLICES + HOT_ROWS else "dealt"


def latest_version(df: DataFrame, keys: Sequence[str] = SILVER_KEYS, order: Sequence[str] = VERSION_ORDER,
                   method: str = "window") -> DataFrame:
    """Keep one row per key: the greatest ``order`` (descending, NULLs last).

    ``window`` (default) is ``row_number() = 1`` over the keys; Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task sends at
    most one row per key and a key holding a third of all rows is cut down
    map-side.  ``dealt`` deals the rows out first: nothing is sorted, or spilled, map-side, but a hot key goes to
    one task as it is (``version_method`` tells which to take).  ``aggregate`` is ``max_by(struct(row), struct(order))``, also
    combined map-side; struct buffers force a sort-based aggregate, which
    measured slower.  ``struct(order)`` is never NULL, so keys whose stamps are
    all NULL keep a row in both forms.  NULL keys form one group; full ties are
    broken arbitrarily, so callers pass a total order.
    """
    keys, order = list(keys), list(order)
    if method in ("window", "dealt"):
        columns = df.columns
        if method == "dealt":      # by a column of its own: a constant among the keys would be dealt out twice
            df, keys = df.withColumn("_lane", F.xxhash64(*keys)).repartition("_lane"), ["_lane", *keys]
        w = Window.partitionBy(*sort_keys(df, keys)).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).select(*[f"`{c}`" for c in columns])
    if method != "aggregate":
        raise ValueError(f"unknown method: {method!r}")
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) for c in order])
    packed = df.groupBy(*keys).agg(F.max_by(row, rank).alias("_latest"))
    return packed.select(*[F.col(f"_latest.{c}").alias(c) for c in df.columns])


def newest_batches(df: DataFrame, company: str = "cod_empresa", batch: str = "_lote") -> DataFrame:
    """(``_c``, ``_b``): the newest batch of every company.

    Distinct (company, batch) pairs first, a hash aggregate combined map-side.
    ``max`` of a string would plan a sort of every row, and Catalyst drops a
    distinct under a ``max``; ``max_by`` keeps the distinct and sorts only the pairs.
    """
    pairs = df.select(F.col(company).alias("_c"), F.col(batch).alias("_b")).distinct()
    return pairs.groupBy("_c").agg(F.max_by("_b", "_b").alias("_b"))


#: Companies up to which a snapshot is read by a literal filter.
SNAPSHOT_LITERALS = 1000


def snapshot_filter(newest: dict, company: str = "cod_empresa", batch: str = "_lote") -> Column:
    """The predicate of S7 as literals: rows of the batch that is named for their company.

    Its first conjunct holds batches only, so a table partitioned by batch lists and reads just those.
    """
    groups: dict = {}
    for name, newest_batch_id in newest.items():
        if newest_batch_id is not None:
            groups.setdefault(newest_batch_id, []).append(name)
    if not groups:
        return F.lit(False)

    def of(names: list) -> Column:
        known = [n for n in names if n is not None]
        hit = F.col(company).isin(known)
        return hit | F.col(company).isNull() if len(known) < len(names) else hit

    mine = reduce(Column.__or__, ((F.col(batch) == F.lit(b)) & of(names) for b, names in sorted(groups.items())))
    return F.col(batch).isin(sorted(groups)) & mine


def latest_snapshot(df: DataFrame, company: str = "cod_empresa", batch: str = "_lote", newest: dict | None = None) -> DataFrame:
    """Rows whose batch is the newest batch of their company.

    ``newest`` (company -> batch) is the index that the Bronze load maintains; without it, the pairs are
    reduced map-side from two columns first.  Up to ``SNAPSHOT_LITERALS`` companies the rows are then read by
    a literal filter, beyond by a semi join with the materialised pairs; the table itself is
    never shuffled by the filter.
    """
    if newest is None:
        pairs = newest_batches(df, company, batch)
        few = pairs.limit(SNAPSHOT_LITERALS + 1).collect()
        if len(few) > SNAPSHOT_LITERALS:
            cond = F.col(company).eqNullSafe(F.col("_c")) & (F.col(batch) == F.col("_b"))
            return df.join(materialize(pairs, "newest_batches"), cond, "left_semi")
        newest = dict(few)
    return df.filter(snapshot_filter(newest, company, batch))


def newest_batch(target: DataFrame, batch: str = "_lote"):
    """Scalar maximum batch id of a table, or None when it is empty."""
    return target.agg(F.max(batch)).first()[0]


def batches_after(df: DataFrame, last_batch, batch: str = "_lote") -> DataFrame:
    """Keep rows of batches newer than ``last_batch`` (all rows when None).

    The literal comparison is pushed to the Parquet scan.
    """
    if last_batch is None or last_batch == "":
        return df
    return df.filter(F.col(batch) > F.lit(last_batch))
