"""Versioned table publishing on plain Parquet.

Each publish writes a complete new version directory

    <root>/<database>/<table>/v=<version>/

and then re-points an external catalog table at it (``ALTER TABLE ... SET
LOCATION``), so readers always see one whole version, a job can read version n
while writing n+1 (an upsert reads its own target), and restoring is
re-pointing at an older directory.  Table and column descriptions are applied
with ``COMMENT ON TABLE`` / ``ALTER COLUMN ... COMMENT``; a publish that
changes the columns re-creates the table entry and its comments.

Tables that belong together are committed together: ``commit`` creates one pointer file

    <root>/<database>/_current/<n>.json

naming every table's version, and fails if somebody else has committed since the state it started from.
``snapshot`` reads all tables as of one pointer, so its readers see all old or all new
versions.  Catalog entries follow the pointer one by one, for users of plain SQL.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import GOLD_COMMENTS
from ..sources.files import create_text, names_below, read_text
from ..sources.landing import path_exists


_QUOTED = str.maketrans({"\\": "\\\\", "'": "\\'"})


def _literal(text: str) -> str:
    """A SQL string literal."""
    return f"'{text.translate(_QUOTED)}'"


def comment_statements(qualified: str, table: str, dictionary: dict = GOLD_COMMENTS) -> list[str]:
    """One statement for the table, one for each described column (Spark's own tables take no bulk change)."""
    about, columns = dictionary[table]
    targets = [(f"COMMENT ON TABLE {qualified} IS", about),
               *((f"ALTER TABLE {qualified} ALTER COLUMN {name} COMMENT", text) for name, text in columns.items())]
    return [f"{target} {_literal(text)}" for target, text in targets]


def new_version_id() -> str:
    return _dt.datetime.now(_dt.UTC).strftime("%Y%m%dT%H%M%S%fZ") + "_" + uuid.uuid4().hex[:6]


class ConcurrentCommit(RuntimeError):
    pass


class VersionedCatalog:
    """Publishes DataFrames as versioned external Parquet tables of one database."""

    NEWEST_BATCH = "salesmart.newest_batch"
    CLUSTERED = "_clustered.json"

    def __init__(self, spark: SparkSession, root: str, database: str):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self._newest: dict[str, str | None] = {}       # version path -> newest batch observed at write
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/{database}'")

    def qualified(self, table: str) -> str:
        return f"{self.database}.{table}"

    def version_path(self, table: str, version: str) -> str:
        return f"{self.root}/{self.database}/{table}/v={version}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def current_location(self, table: str) -> str | None:
        if not self.exists(table):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(table)}").collect()
        for r in rows:
            if r.col_name == "Location":
                return r.data_type
        return None

    def write_version(self, df: DataFrame, table: str, version: str | None = None,
                      clustered: tuple[int, Sequence[str]] | None = None) -> tuple[str, int]:
        """Write a complete version directory; rows are counted during the write.

        ``clustered`` = (buckets, columns) stores it bucketed by these columns, a file per bucket: tables
        clustered alike are joined on them without an exchange.
        """
        version = version or new_version_id()
        path = self.version_path(table, version)
        obs = Observation(f"publish_{table}_{version}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if "_lote" in df.columns:                  # the newest batch, for the next run's S8 filter
            metrics.append(F.max("_lote").alias("newest_batch"))
        out = df.observe(obs, *metrics)
        if clustered is None:
            out.write.mode("errorifexists").parquet(path)
        else:
            count, columns = clustered
            # Spark writes buckets through a catalog entry only; this one is external and goes at once
            entry = f"{self.database}.{table}_{uuid.uuid4().hex[:8]}"
            (out.repartition(count, *columns).write.format("parquet").mode("errorifexists").option("path", path)
             .bucketBy(count, *columns).sortBy(*columns).saveAsTable(entry))
            self.spark.sql(f"DROP TABLE {entry}")
            create_text(self.spark, f"{path}/{self.CLUSTERED}", json.dumps({"buckets": count, "columns": list(columns)}))
        got = obs.get
        self._newest[path] = got.get("newest_batch")
        return path, int(got.get("rows", 0) or 0)

    def point_to(self, table: str, path: str, comments: bool = True) -> None:
        """Make ``table`` read ``path``; re-create the entry when the columns differ."""
        q = self.qualified(table)
        new_schema = self.spark.read.parquet(path).schema
        clustered = self._clustering(path)
        if self.exists(table) and clustered == self._clustering(self.current_location(table)) and \
                [(f.name, f.dataType) for f in self.table(table).schema] == [(f.name, f.dataType) for f in new_schema]:
            self.spark.sql(f"ALTER TABLE {q} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(q)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {q}")
            if clustered is None:
                self.spark.sql(f"CREATE TABLE {q} USING parquet LOCATION '{path}'")
            else:
                columns = ", ".join(clustered["columns"])
                fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new_schema)
                self.spark.sql(f"CREATE TABLE {q} ({fields}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns}) "
                               f"INTO {clustered['buckets']} BUCKETS LOCATION '{path}'")
            if comments and table in GOLD_COMMENTS:
                self.apply_comments(table)
        newest = self._newest.get(path)
        if newest is not None:
            self.spark.sql(f"ALTER TABLE {q} SET TBLPROPERTIES ('{self.NEWEST_BATCH}' = {_literal(str(newest))})")
        else:                                      # unknown for this version: never keep a stale value
            self.spark.sql(f"ALTER TABLE {q} UNSET TBLPROPERTIES IF EXISTS ('{self.NEWEST_BATCH}')")

    # --- one commit for all tables ---------------------------------------------------------------

    def _pointers(self) -> list[int]:
        names = names_below(self.spark, f"{self.root}/{self.database}/_current")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def committed(self) -> tuple[int, dict[str, str]]:
        """(number, table -> version path) of the newest pointer; (0, {}) before the first."""
        for n in sorted(self._pointers(), reverse=True):
            try:
                return n, json.loads(read_text(self.spark, f"{self.root}/{self.database}/_current/{n:012d}.json"))["tables"]
            except ValueError:                     # cut off while it was written: never committed
                continue
        return 0, {}

    def commit(self, paths: dict[str, str], base: int) -> int:
        """Serve ``paths`` (and the other tables of pointer ``base`` unchanged) from now on, all at once."""
        newest, tables = self.committed()
        if newest != base:
            raise ConcurrentCommit(f"{self.database}: pointer {newest} was committed after {base}")
        number = max(self._pointers(), default=0) + 1
        if not create_text(self.spark, f"{self.root}/{self.database}/_current/{number:012d}.json",
                           json.dumps({"tables": {**tables, **paths}})):
            raise ConcurrentCommit(f"{self.database}: pointer {number} was committed meanwhile")
        return number

    def snapshot(self) -> dict[str, DataFrame]:
        """All committed tables as of one pointer."""
        return {name: self.spark.read.parquet(path) for name, path in self.committed()[1].items()}

    def _clustering(self, path: str | None) -> dict | None:
        if path is None or not path_exists(self.spark, f"{path}/{self.CLUSTERED}"):
            return None
        return json.loads(read_text(self.spark, f"{path}/{self.CLUSTERED}"))

    def newest_batch(self, table: str) -> str | None:
        """The newest batch id recorded when the current version was written, or None."""
        if not self.exists(table):
            return None
        for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(table)}").collect():
            if r[0] == self.NEWEST_BATCH:
                return r[1]
        return None

    def apply_comments(self, table: str, dictionary: dict = GOLD_COMMENTS) -> None:
        for stmt in comment_statements(self.qualified(table), table, dictionary):
            self.spark.sql(stmt)

    def publish(self, df: DataFrame, table: str, version: str | None = None, activate: bool = True,
                clustered: tuple[int, Sequence[str]] | None = None) -> dict:
        """Write a new version and (by default) point the table at it."""
        path, rows = self.write_version(df, table, version, clustered)
        if activate:
            self.point_to(table, path)
        return {"table": self.qualified(table), "path": path, "rows": rows}

    def versions(self, table: str) -> list[str]:
        base = f"{self.root}/{self.database}/{table}"
        if not path_exists(self.spark, base):
            return []
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(base)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n[2:] for n in names if n.startswith("v="))

    def prune_versions(self, table: str, keep: int = 7) -> list[str]:
        """Delete all but the newest ``keep`` version directories of ``table``; the version the table
        currently reads and the committed one are always kept.  Returns deleted versions."""
        served = self.committed()[1].get(table, "").rstrip("/")
        current = (self.current_location(table) or "").rstrip("/")
        versions = self.versions(table)
        doomed = versions[:-keep] if keep > 0 else list(versions)
        deleted = []
        jvm = self.spark.sparkContext._jvm
        for v in doomed:
            path = self.version_path(table, v)
            if current.endswith(path.rstrip("/")) or current.endswith(f"/v={v}") or served.endswith(f"/v={v}"):
                continue
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            deleted.append(v)
        return deleted

    def restore(self, table: str, version: str) -> None:
        """Re-point the table at an earlier version directory."""
        self.point_to(table, self.version_path(table, version))

    def describe(self, table: str) -> tuple[str | None, dict[str, str | None]]:
        """Table description and column descriptions from the catalog."""
        t = self.spark.catalog.getTable(self.qualified(table))
        cols = {c.name: c.description for c in self.spark.catalog.listColumns(self.qualified(table))}
        return t.description, cols
