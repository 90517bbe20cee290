"""The newest batch of every company, maintained by the Bronze load.

Each load observes the (company, batch) pairs it appends (no second scan) and writes the merged index as
``<path>/<micro-batch>.json``, named after the sink's last committed micro-batch.  A load that
finds an index older than the sink (its driver died in between) rebuilds it once from the two columns of Bronze.
The index has one entry per company, so readers turn it into literal partition filters.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import create_text, names_below, read_text

METRIC = "loaded_batches"


def loaded_pairs(company: str = "_empresa", batch: str = "_lote") -> Column:
    """Aggregate: the (company, batch) pairs of the appended rows; companies as Silver has them, trimmed."""
    return F.collect_set(F.struct(F.trim(company).alias("company"), F.col(batch).alias("batch"))).alias("pairs")


def committed_micro_batch(spark: SparkSession, bronze_dir: str) -> int | None:
    """The file sink's last committed micro-batch."""
    done = [n.removesuffix(".compact") for n in names_below(spark, f"{bronze_dir.rstrip('/')}/_spark_metadata")]
    return max((int(n) for n in done if n.isdigit()), default=None)


class BatchIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self) -> tuple[int | None, dict[str | None, str]]:
        found = sorted(int(n.removesuffix(".json")) for n in names_below(self.spark, self.path) if n.endswith(".json"))
        for version in reversed(found):
            try:
                entries = json.loads(read_text(self.spark, f"{self.path}/{version}.json"))["newest"]
            except (ValueError, KeyError):  # cut off while it was written
                continue
            return version, {e["company"]: e["batch"] for e in entries}
        return None, {}

    def newest(self) -> dict[str | None, str]:
        """Company -> its newest batch."""
        return self._read()[1]

    def _write(self, version: int, newest: dict[str | None, str]) -> None:
        entries = [{"company": c, "batch": b} for c, b in sorted(newest.items(), key=lambda e: (e[0] is None, e[0] or ""))]
        create_text(self.spark, f"{self.path}/{version}.json", json.dumps({"newest": entries}))

    @staticmethod
    def merged(newest: dict, pairs: Iterable[tuple[str | None, str | None]]) -> dict:
        out = dict(newest)
        for company, batch in pairs:
            if batch is not None and (company not in out or out[company] < batch):
                out[company] = batch
        return out

    def follow(self, bronze_dir: str, bronze: DataFrame | None) -> None:
        """Before a load: rebuild the index if it does not stand for what the sink has committed."""
        committed = committed_micro_batch(self.spark, bronze_dir)
        if committed is None or self._read()[0] == committed or bronze is None:
            return
        pairs = bronze.select(F.trim("_empresa").alias("c"), F.col("_lote").alias("b")).distinct()
        self._write(committed, self.merged({}, pairs.groupBy("c").agg(F.max("b")).collect()))  # one row per company

    def advance(self, bronze_dir: str, pairs: Iterable[tuple[str | None, str | None]]) -> None:
        """After a load: merge the pairs it appended."""
        committed, (version, newest) = committed_micro_batch(self.spark, bronze_dir), self._read()
        if committed is not None and committed != version:
            self._write(committed, self.merged(newest, pairs))
