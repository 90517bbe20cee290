"""Conditional upsert without MERGE (plain Parquet tables).

Semantics of ``MERGE ... ON t.k = s.k WHEN MATCHED AND s.stamp >= t.stamp THEN
UPDATE SET * WHEN NOT MATCHED THEN INSERT *``:

* key present only in the target -> target row kept;
* only in the source -> inserted;
* in both -> source row when ``s.stamp >= t.stamp``; an older source row or a
  NULL comparison keeps the target;
* NULL keys never match (``=`` not ``<=>``), so NULL-key source rows are
  inserted and NULL-key target rows are kept.

Expressed as one full outer join on the keys with literal presence markers and
a per-column ``CASE``; Catalyst plans a sort-merge (or shuffled-hash) join.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SILVER_KEYS, VERSION_ORDER
from .versions import latest_version, sort_keys


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = SILVER_KEYS,
           stamp: str = "dat_stamp") -> DataFrame:
    keys = list(keys)
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in columns], F.lit(True).alias("_s"))
    on = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in sort_keys(target, keys)]
    cond = on[0]
    for extra in on[1:]:
        cond = cond & extra
    joined = t.join(s, cond, "full_outer")
    take_source = F.col("_t").isNull() | (F.col("_s").isNotNull() & (F.col(f"s_{stamp}") >= F.col(f"t_{stamp}")))
    return joined.select(*[
        F.when(take_source, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in columns
    ])


# --- bucketed form: rewrite only the buckets the changes touch -----------------
#
#   <table>/bucket_version=<n>-full|part/key_bucket=<b>/part-*.parquet
#   <table>/bucket_version=<n>-full|part/_keys            per bucket: rows with a NULL key, repeated keys (Q9)
#   <table>/bucket_version=<n>-full|part/_committed       written last: columns, newest batch
#
# Version directories are never changed.  Readers take the versions from the newest committed
# whole-table write on, and each bucket from the newest of them that holds it.  Before its mark
# appears a version is invisible, so a driver that dies at any point leaves the previous state.

BUCKET = "key_bucket"


@dataclass(frozen=True)
class Bucketing:
    """How a key maps to a storage bucket.

    ``hash``: ``pmod(xxhash64(keys), buckets)``, even bucket sizes for any keys.
    ``range``: ``floor(range_col / width)`` on a sequential record id, so new rows
    go to the newest bucket and updates of recent rows touch few buckets.  Either
    way the bucket is a function of the keys (NULL ids go to bucket -1).
    """

    buckets: int = 64
    range_col: str | None = None
    width: int | None = None

    def column(self, keys: Sequence[str]) -> Column:
        if self.range_col:
            b = F.floor(F.col(self.range_col) / F.lit(self.width or 1)).cast("long")
            return F.coalesce(b, F.lit(-1).cast("long"))
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.buckets)).cast("long")


def _bucketing(spec) -> Bucketing:
    return spec if isinstance(spec, Bucketing) else Bucketing(buckets=int(spec))


def key_bucket(keys: Sequence[str], buckets) -> Column:
    """Stable bucket of a key (``buckets``: a count for hash buckets, or a ``Bucketing``)."""
    return _bucketing(buckets).column(keys)


VERSION = "bucket_version"
_FULL, _PART = "-full", "-part"
_COMMITTED = "_committed"


def _hadoop(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark, path: str, prefix: str) -> list[str]:
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(prefix))


def _commit(spark, version_dir: str, schema: T.StructType, newest: str | None) -> None:
    """Make a version visible: the mark is written aside and renamed into place."""
    fs, aside = _hadoop(spark, f"{version_dir}/{_COMMITTED}.new")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps({"newest_batch": newest, "schema": schema.jsonValue()}).encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(aside, _hadoop(spark, f"{version_dir}/{_COMMITTED}")[1]):
        raise RuntimeError(f"could not commit {version_dir}")


def _mark(spark, version_dir: str) -> dict:
    fs, p = _hadoop(spark, f"{version_dir}/{_COMMITTED}")
    java = spark.sparkContext._jvm.java.io
    stream = fs.open(p)
    try:
        return json.loads(java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine())
    finally:
        stream.close()


def committed_versions(spark, path: str) -> list[str]:
    """Version directories that make up the table, oldest first; empty if there is no table."""
    done = [n for n in _children(spark, path, f"{VERSION}=") if _COMMITTED in _children(spark, f"{path}/{n}", _COMMITTED)]
    whole = [i for i, n in enumerate(done) if n.endswith(_FULL)]
    return done[whole[-1]:] if whole else []


def _bucket_dirs(spark, path: str, versions: Sequence[str]) -> dict[int, str]:
    """Bucket id -> its newest directory (one entry per bucket: a driver-sized list)."""
    return {int(leaf.partition("=")[2]): f"{path}/{v}/{leaf}"
            for v in versions for leaf in _children(spark, f"{path}/{v}", f"{BUCKET}=")}


def read_newest_batch(spark, path: str) -> str | None:
    """The newest batch id recorded for a bucketed table, or None (then scan for it)."""
    path = path.rstrip("/")
    known = (_mark(spark, f"{path}/{v}")["newest_batch"] for v in committed_versions(spark, path))
    return max((b for b in known if b is not None), default=None)


def read_bucketed(spark, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The table's rows with their bucket; ``only`` reads the named buckets' directories alone."""
    path = path.rstrip("/")
    versions = committed_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed bucketed table at {path}")
    schema = T.StructType.fromJson(_mark(spark, f"{path}/{versions[-1]}")["schema"])
    wanted = None if only is None else set(only)
    dirs = [d for b, d in sorted(_bucket_dirs(spark, path, versions).items()) if wanted is None or b in wanted]
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*dirs).select(*schema.names)


_KEYS = "_keys"
_KEYS_SCHEMA = f"{BUCKET} long, nulos long, duplicadas long"


LANE = "_faixa"


def _lane(spark, keys: Sequence[str], buckets: int) -> Column:
    """A slice of a key's bucket, so that the rows of ``buckets`` buckets spread over all shuffle partitions."""
    slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, buckets)))
    return F.xxhash64(F.lit(slices), F.col(BUCKET), F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(slices)))


@contextmanager
def _joined_by_lane(spark):
    """Joins on a lane and its keys use rows that are dealt out by lane, without dealing them out again by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def _write_version(df: DataFrame, path: str, kind: str, keys: Sequence[str], newest: str | None = None, observe: bool = False,
                   dealt: bool = False) -> None:
    """One write of ``df`` (with its bucket column) as the next version, rebalanced by bucket: a bucket
    has few files, and one beyond the advisory size is split over tasks.  Rows that are ``dealt`` out by lane
    are in such tasks already.  The keys of the written buckets
    are counted from the stored columns, so the key gate never reads a bucket that did not change."""
    spark, path = df.sparkSession, path.rstrip("/")
    taken = [int(n.partition("=")[2].partition("-")[0]) for n in _children(spark, path, f"{VERSION}=")]
    target = f"{path}/{VERSION}={max(taken, default=0) + 1:012d}{kind}"
    # in key order the stored rows take less space
    out, obs = (df if dealt else df.hint("rebalance", BUCKET)).sortWithinPartitions(BUCKET, *keys), None
    if observe:
        obs = Observation(f"bucketed_{id(df):x}")
        out = out.observe(obs, F.max("_lote").alias("newest"))
    out.write.mode("errorifexists").option("compression", "zstd").partitionBy(BUCKET).parquet(target)
    stored = spark.read.schema(df.schema).option("basePath", target).parquet(target)
    groups = stored.groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    (groups.groupBy(BUCKET).agg(F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0).cast("long")).alias("nulos"),
                                F.count_if(F.col("_n") > 1).alias("duplicadas"))
     .select(F.col(BUCKET).cast("long").alias(BUCKET), "nulos", "duplicadas").coalesce(1).write.parquet(f"{target}/{_KEYS}"))
    _commit(spark, target, df.schema, obs.get.get("newest") if obs else newest)


def bucket_key_counts(spark, path: str) -> DataFrame:
    """Q9 without reading the table: (nulos, duplicadas) of its current state, from the counts kept with each version.

    A key's rows are all in one bucket, so the sums over buckets are those of the whole table.
    """
    path = path.rstrip("/")
    versions = committed_versions(spark, path)
    parts = [spark.read.schema(_KEYS_SCHEMA).parquet(f"{path}/{v}/{_KEYS}").withColumn("_v", F.lit(i)) for i, v in enumerate(versions)]
    newest = reduce(DataFrame.unionByName, parts).groupBy(BUCKET).agg(F.max_by(F.struct("nulos", "duplicadas"), "_v").alias("k"))
    return newest.agg(*[F.coalesce(F.sum(f"k.{c}"), F.lit(0).cast("long")).alias(c) for c in ("nulos", "duplicadas")])


#: Rows of a lane beyond twice the mean from which it counts as hot.
HOT_ROWS = 100_000


def write_latest(rows: DataFrame, path: str, keys: Sequence[str] = SILVER_KEYS, order: Sequence[str] = VERSION_ORDER, buckets=64) -> None:
    """``write_bucketed`` of the latest versions of ``rows``: one exchange by lane serves the versions and the write.

    That exchange sends every version.  Where a lane has far more than its share (a key with very many versions),
    the versions are cut map-side in an exchange of their own, as in ``latest_version``; counting the lanes sends counts only.
    """
    spark, spec = rows.sparkSession, _bucketing(buckets)
    laned = rows.withColumn(BUCKET, spec.column(keys))
    laned = laned.withColumn(LANE, _lane(spark, keys, 1 if spec.range_col else spec.buckets))
    lanes, total, heaviest = laned.groupBy(LANE).count().agg(F.count(F.lit(1)), F.sum("count"), F.max("count")).first()
    if spec.range_col or (heaviest or 0) > 2 * (total or 0) / max(1, lanes) + HOT_ROWS:
        write_bucketed(latest_version(rows, keys, order), path, keys, buckets)
        return
    latest = latest_version(laned.repartition(LANE), [LANE, *keys], order).drop(LANE)
    _write_version(latest, path, _FULL, keys, observe="_lote" in rows.columns, dealt=True)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str] = SILVER_KEYS, buckets=64) -> None:
    """Store a Silver table partitioned by key bucket (the layout the upsert below expects).

    The new version replaces the whole table, whatever its earlier buckets were and whatever the
    session's overwrite mode says.  The newest batch id is observed during the write.
    """
    _write_version(df.withColumn(BUCKET, key_bucket(keys, buckets)), path, _FULL, keys, observe="_lote" in df.columns)


def upsert_touched_buckets(target_path: str, source: DataFrame, staging_path: str,
                           keys: Sequence[str] = SILVER_KEYS, stamp: str = "dat_stamp",
                           buckets=64) -> list[int]:
    """S9 at scale: only buckets that receive changes are read, merged and written, once.

    The merged buckets become a new version directory; the old ones stay until ``prune_bucketed``.
    ``buckets`` must be what the table was last wholly written with.  Without changes nothing is
    written.  Returns the rewritten bucket ids.
    """
    spark = source.sparkSession
    keys = list(keys)
    # the changes (the small side at scale) are staged once: they give the touched buckets and the
    # newest batch and feed the merge without being computed twice
    staged = source.withColumn(BUCKET, key_bucket(keys, buckets))
    obs = Observation(f"changes_{id(staged):x}")
    newest = F.col("_lote") if "_lote" in source.columns else F.lit(None).cast("string")
    changes_path = f"{staging_path.rstrip('/')}/changes"
    staged.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(newest).alias("newest")) \
        .write.mode("errorifexists").option("compression", "zstd").parquet(changes_path)
    if not obs.get.get("rows"):
        return []
    src = spark.read.schema(staged.schema).parquet(changes_path)
    # at most one id per bucket (hash) or per id range touched by the changes
    touched = sorted(r[0] for r in src.select(BUCKET).distinct().collect())
    target = read_bucketed(spark, target_path, touched)
    # both sides are dealt out by lane once: the merge and the write use the same tasks
    lane = _lane(spark, keys, len(touched))
    sides = [rows.withColumn(LANE, lane).repartition(LANE) for rows in (target, src.select(*target.columns))]
    merged = upsert(*sides, [LANE, *keys], stamp).drop(LANE)
    with _joined_by_lane(spark):
        _write_version(merged, target_path, _PART, keys, newest=obs.get.get("newest"), dealt=True)
    return touched


def prune_bucketed(spark, path: str) -> list[str]:
    """Delete version directories and buckets that the current state does not use (no reader may still
    be on an older state).  Returns what was deleted."""
    path = path.rstrip("/")
    versions = committed_versions(spark, path)
    if not versions:
        return []
    live = set(_bucket_dirs(spark, path, versions).values())
    doomed = [f"{path}/{n}" for n in _children(spark, path, f"{VERSION}=") if n not in versions and n < versions[-1]]
    doomed += [d for v in versions for d in (f"{path}/{v}/{leaf}" for leaf in _children(spark, f"{path}/{v}", f"{BUCKET}="))
               if d not in live]
    for d in doomed:
        fs, p = _hadoop(spark, d)
        fs.delete(p, True)
    return doomed
