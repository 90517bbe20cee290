"""V3-V7 maintained: the dashboard's sums follow the day's changed orders instead of being computed anew.

A store is a folder of parts.  A part holds, for one load, signed partial sums per (company, branch, seller,
month): the new fact rows of the orders that changed, less their old rows.  The measures are sums over all
parts, a table of business size.  A load's part counts once: it is named by a mark that only one
writer can create, so a repeated load adds nothing and a load that died before its mark left nothing.
``compact`` replaces parts by their sum.

Sums and the numbers of their non-NULL terms are kept, so a group whose rows are all retracted
vanishes and a sum over NULLs only stays NULL, as in a full computation.  The measures join units (inner) and sellers
(left) as the dashboard does; they equal its full join while product and customer keys are unique (gate Q1;
``SalesStar`` computes the full join in any case).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FACT_KEYS, SILVER_KEYS
from ..operators.versions import sort_keys
from ..sources.files import create_text, names_below, read_text
from .marts import TOTAL

GROUP = ["cod_empresa", "cod_filial", "cod_vendedor", "mes"]
SUMS = ["vlr_total", "vlr_saldo"]
STATE = ("cod_empresa string, cod_filial string, cod_vendedor string, mes date, linhas long, "
         + ", ".join(f"{c} {TOTAL}, n_{c} long" for c in SUMS))
_COUNTED = ["linhas", *(x for c in SUMS for x in (c, f"n_{c}"))]


def _month() -> Column:
    return F.trunc("dat_emissao", "MM").alias("mes")


def partial_sums(fact: DataFrame, sign: int = 1) -> DataFrame:
    """Signed partial sums of fact rows; combined map-side to one row per group and task."""
    terms = [F.sum(F.lit(sign).cast("long")).alias("linhas")]
    for c in SUMS:
        terms += [(F.coalesce(F.sum(c), F.lit(0)).cast(TOTAL) * sign).cast(TOTAL).alias(c), (F.count(c) * sign).alias(f"n_{c}")]
    return fact.groupBy("cod_empresa", "cod_filial", "cod_vendedor", _month()).agg(*terms)


def _summed(parts: DataFrame) -> DataFrame:
    sums = parts.groupBy(*GROUP).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in _COUNTED])
    return sums.where(reduce(Column.__or__, (F.col(c) != 0 for c in _COUNTED)))


def retractions(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Sums to add to the state when the rows ``old`` give way to ``new``.

    Rows that stay as they are cancel out within their order first, where the facts are joined anyway; only what differs
    is dealt out by group.  They cancel by counting equal rows, so the values themselves are added up once, for the groups.
    """
    if old is None:
        return partial_sums(new)
    signed = reduce(DataFrame.unionByName, (
        rows.select("cod_empresa", "cod_pedido", "cod_filial", "cod_vendedor", _month(), *SUMS, F.lit(sign).cast("long").alias("linhas"))
        for rows, sign in ((new, 1), (old, -1))))
    differing = signed.groupBy("cod_pedido", *GROUP, *SUMS).agg(F.sum("linhas").alias("linhas")).where("linhas <> 0")
    times, terms = F.col("linhas"), [F.sum("linhas").alias("linhas")]
    for c in SUMS:
        value = F.when(times == 1, F.col(c)).when(times == -1, -F.col(c)).otherwise(F.col(c) * times)
        terms += [F.coalesce(F.sum(value), F.lit(0)).cast(TOTAL).alias(c),
                  F.sum(F.when(F.col(c).isNotNull(), times).otherwise(F.lit(0).cast("long"))).alias(f"n_{c}")]
    return differing.groupBy(*GROUP).agg(*terms).where(reduce(Column.__or__, (F.col(c) != 0 for c in _COUNTED)))


def changed_orders(changes: Sequence[DataFrame], before: Sequence[DataFrame | None], keys: Sequence[str] = FACT_KEYS,
                   record: Sequence[str] = SILVER_KEYS) -> DataFrame:
    """Keys of the orders that changed rows belong to now, or belonged to before (a record may move).

    ``changes`` and ``before`` are the changed rows and the earlier state of each Silver table (items, headers).
    """
    parts = [c.select(*keys) for c in changes]
    parts += [b.join(c.select(*record), sort_keys(b, record), "left_semi").select(*keys)
              for c, b in zip(changes, before, strict=True) if b is not None]
    return reduce(DataFrame.unionByName, parts).distinct()


def of_orders(rows: DataFrame, orders: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    return rows.join(orders.select(*keys), sort_keys(rows, keys), "left_semi")


class MeasureStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marks(self) -> dict[str, dict]:
        names = [n for n in names_below(self.spark, f"{self.path}/_marks") if n.endswith(".json")]
        out = {}
        for n in names:
            try:
                out[n.removesuffix(".json")] = json.loads(read_text(self.spark, f"{self.path}/_marks/{n}"))
            except ValueError:  # cut off while it was written: not there
                continue
        return out

    def _write(self, name: str, sums: DataFrame, covers: Sequence[str] = (), silver: dict | None = None) -> bool:
        part = f"{self.path}/{name}-{uuid.uuid4().hex}"
        sums.write.parquet(part)
        mark = json.dumps({"part": part.rsplit("/", 1)[-1], "covers": list(covers), "silver": silver})
        return create_text(self.spark, f"{self.path}/_marks/{name}.json", mark)

    def _live(self) -> dict[str, dict]:
        marks = self._marks()
        covered = {c for m in marks.values() for c in m["covers"]}
        return {n: m for n, m in marks.items() if n not in covered}

    def applied(self, load: str) -> bool:
        return load in self._marks()

    def add(self, load: str, sums: DataFrame, silver: dict | None = None) -> bool:
        """Count ``sums`` as the changes of ``load``; False if that load is counted already."""
        return not self.applied(load) and self._write(load, sums, silver=silver)

    def newest(self) -> str | None:
        """The load that the state stands for (loads are named in order)."""
        return max((n.rstrip("+") for n in self._marks()), default=None)

    # --- following the daily load -------------------------------------------------------------------
    #
    # Silver moves on with every run, the published fact only when the gates pass.  So each run notes which
    # orders lie between two states of Silver, and a publish takes the notes on the way from the state of the
    # last counted fact.  A gap in them (a driver lost in between, a reprocess) means a full computation.

    def note(self, before: dict, after: dict, orders: DataFrame | None) -> None:
        """The orders that changed between two states of Silver (None: unknown)."""
        part = None
        if orders is not None:
            part = f"orders-{uuid.uuid4().hex}"
            orders.write.parquet(f"{self.path}/_notes/{part}")
        create_text(self.spark, f"{self.path}/_notes/{uuid.uuid4().hex}.json",
                    json.dumps({"before": before, "after": after, "part": part}))

    def _noted(self, before: dict | None, after: dict) -> list[str] | None:
        notes = {}
        for n in names_below(self.spark, f"{self.path}/_notes"):
            if n.endswith(".json"):
                note = json.loads(read_text(self.spark, f"{self.path}/_notes/{n}"))
                notes[json.dumps(note["before"], sort_keys=True)] = note
        parts: list[str] = []
        while before != after:
            note = notes.pop(json.dumps(before, sort_keys=True), None)
            if note is None or note["part"] is None:
                return None
            parts.append(f"{self.path}/_notes/{note['part']}")
            before = note["after"]
        return parts

    def follow(self, load: str, new: DataFrame, previous: str | None, old: DataFrame | None, silver: dict,
               keys: Sequence[str] = FACT_KEYS) -> None:
        """Bring the state from the fact of load ``previous`` to that of ``load``, made from this state of Silver.

        Only rows of the noted orders are read; with a gap in the notes the new fact replaces the state.
        """
        if self.applied(load):
            return
        marks, last = self._marks(), self.newest()
        known = [m["silver"] for n, m in marks.items() if last is not None and n.rstrip("+") == last]
        parts = self._noted(known[-1], silver) if known and last == previous and old is not None else None
        if parts is None:
            self._write(load, partial_sums(new), covers=sorted(self._live()), silver=silver)
        elif not parts:
            self.add(load, partial_sums(new.limit(0)), silver)
        else:
            orders = self.spark.read.parquet(*parts).distinct()
            self.add(load, retractions(of_orders(old, orders, keys), of_orders(new, orders, keys)), silver)

    def _parts(self) -> DataFrame:
        """The signed sums of all counted loads as they are stored: a group may be in several parts."""
        parts = [f"{self.path}/{m['part']}" for m in self._live().values()]
        return self.spark.read.schema(STATE).parquet(*parts) if parts else self.spark.createDataFrame([], STATE)

    def state(self) -> DataFrame:
        """Partial sums as of all counted loads."""
        return _summed(self._parts())

    def compact(self) -> None:
        """One part in place of all (their folders stay until nobody reads them)."""
        live = self._live()
        if len(live) > 1:
            last = max(live)
            self._write(f"{last}+", self.state(), covers=sorted(live), silver=live[last]["silver"])

    def measures(self, units: DataFrame, sellers: DataFrame) -> DataFrame:
        """V3-V7 as (medida, chave, valor).

        The parts are read once, whatever their groups: sums by (month, unit) and by seller, each a few rows that are
        combined map-side, hold all measures.  What adds up to nothing in them has been retracted.
        """
        keyed = (self._parts().join(units.select("cod_empresa", "cod_filial", "des_unidade"), ["cod_filial", "cod_empresa"])
                 .join(sellers.select("cod_empresa", "cod_vendedor", F.col("des_nome").alias("des_vendedor")),
                       ["cod_vendedor", "cod_empresa"], "left"))
        by = ["mes", "des_unidade", "des_vendedor"]
        sums = (keyed.groupingSets([by[:2], by[2:]], *by).agg(F.grouping_id().alias("_set"), *[F.sum(c).alias(c) for c in _COUNTED])
                .where(reduce(Column.__or__, (F.col(c) != 0 for c in _COUNTED))))

        def row(name: str, key: Column | None, measure: str) -> Column:
            return F.struct(F.lit(name).alias("medida"), (F.lit(None) if key is None else key).cast("string").alias("chave"),
                            F.col(measure).cast(TOTAL).alias("soma"), F.col(f"n_{measure}").cast("long").alias("n"))

        totals = [row("valor_vendido", None, SUMS[0]), row("valor_em_carteira", None, SUMS[1])]
        of_months = F.array(*totals, row("vendas_por_mes", F.col("mes"), SUMS[0]), row("vendas_por_unidade", F.col("des_unidade"), SUMS[0]))
        of_sellers = F.array(row("carteira_por_vendedor", F.col("des_vendedor"), SUMS[1]))
        rows = sums.select(F.explode(F.when(F.col("_set") == 1, of_months).otherwise(of_sellers)).alias("r"))
        none = self.spark.range(1).select(*[F.lit(0).alias(c) for c in _COUNTED]).select(F.explode(F.array(*totals)).alias("r"))
        return (rows.select("r.*").unionByName(none.select("r.*")).groupBy("medida", "chave")
                .agg(F.when(F.sum("n") > 0, F.sum("soma")).cast(TOTAL).alias("valor")).select("medida", "chave", "valor"))
