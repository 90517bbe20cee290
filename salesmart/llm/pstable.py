"""Operator 12, near-duplicate vectors by Euclidean p-stable hashing.

Vectors are compared only with equal, non-null labels.  Rows with equal label and equal vector are merged
first (their representative carries how many there are).  A table of the index concatenates
``K`` quantised projections floor((a.v + b) / WIDTH) of the normalised vector, a Gaussian, b uniform.
At distance c one projection agrees with probability

    p(c) = 1 - 2 Phi(-w/c) - 2c / (sqrt(2 pi) w) (1 - exp(-w^2 / 2c^2))

``K`` grows with the logarithm of the largest label's vectors so that an unrelated (orthogonal) vector shares a
bucket with about ``STRAY`` others; the number of tables follows from ``MISS``, the probability that a
pair at exactly the least cosine meets in none (closer pairs meet far more often).  Every vector is indexed.

Buckets.  Only buckets with company are joined with the vectors.  A large one is cut into blocks of ``BLOCK``
rows and every pair of blocks is a piece of work of its own, so no key gathers in one task.  A piece compares its rows by
exact cosine in double precision and counts a pair only in the first table in which it meets, so counts are
exact over the pairs found.  It emits one count per row and the few links that join components, never a list of pairs.

Rows.  One result row per input row, repeated rows and ids included: n_links counts all other rows linked
directly (copies are linked), component_id is the smallest vec_id of the component, kept is vec_id =
component_id (false for a null id).  Null labels and vectors that are null, empty, zero or hold null or non-finite components
link with nothing; nor do vectors of different lengths.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import mix, stage
from salesmart.llm.components import components

COSINE = 0.93
#: Width of a quantised projection, for unit vectors.
WIDTH = 2.0
#: Unrelated vectors expected in a bucket, and the chance that a pair at the least cosine shares none.
STRAY, MISS = 0.05, 1e-3
SEED = 20_240_611
#: Rows of a block: two blocks and the cosines between them are in memory at once.
BLOCK = 512

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection of two vectors at ``distance`` falls into one interval."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def index_size(rows: int, cosine: float = COSINE) -> tuple[int, int]:
    """(projections of a table, tables) for ``rows`` vectors of one label."""
    near, apart = agreement(math.sqrt(2 - 2 * cosine)), agreement(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(rows, 1) / STRAY) / -math.log(apart)))
    return k, math.ceil(math.log(MISS) / math.log1p(-near ** k))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as unit vectors in double precision) for each length that occurs."""
    lengths = np.array(column.value_lengths())
    flat, ends = np.asarray(column.flatten(), np.float64), np.cumsum(lengths)
    out = []
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        x = flat[(ends[at] - d)[:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out.append((at, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _hasher(k: int, tables: int):
    """(rid, label, vector, copies) -> the same with the bucket keys of all tables."""
    made: dict = {}

    def planes(d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in made:
            rng = np.random.default_rng([SEED, d])
            made[d] = rng.standard_normal((d, tables * k)), rng.uniform(0, WIDTH, tables * k)
        return made[d]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            label = np.asarray(batch.column(1).cast(pa.int64())).astype(np.int64).view(_U)
            keys = np.zeros((batch.num_rows, tables), _U)
            for at, x in _matrix(batch.column(2)):
                a, b = planes(x.shape[1])
                cell = np.floor((x @ a + b) / WIDTH).astype(np.int64).view(_U).reshape(len(at), tables, k)
                key = mix(label[at] + np.full(1, x.shape[1], _U) * _GOLDEN)[:, None] + np.arange(1, tables + 1, dtype=_U) * _GOLDEN
                for j in range(k):
                    key = mix(key + cell[:, :, j] * _U(0xD6E8FEB86659FD93))
                keys[at] = key
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * tables
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), lists],
                                             names=["rid", "vec", "copies", "keys"])

    return run


def _piece_links(rid: np.ndarray, side: np.ndarray, copies: np.ndarray, table: int, keys: np.ndarray, x: np.ndarray,
                 cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links per row, joining links) of one piece; side 0 and 1 are its blocks, 2 the only one of a block with itself."""
    counts = np.zeros(len(rid), np.int64)
    group = np.arange(len(rid))
    left, right = (np.flatnonzero((side == s) | (side == 2)) for s in (0, 1))
    joined = []
    close = x[left] @ x[right].T >= cosine
    for i, row in zip(left, close):
        others = right[row]
        others = others[rid[others] > rid[i]] if side[i] == 2 else others
        if table and len(others):  # a pair that met in an earlier table was counted there
            others = others[~(keys[others, :table] == keys[i, :table]).any(axis=1)]
        counts[i] += copies[others].sum()
        counts[others] += copies[i]
        for j in others[group[others] != group[i]]:
            if group[i] != group[j]:
                joined.append((i, j))
                group[group == group[j]] = group[i]
    return counts, joined


def _pieces(cosine: float):
    """Rows sorted by piece (bk, lo, hi) -> (u, v, n): counts with v null, joining links with n null."""

    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        rid, side, copies = (t.column(c).to_numpy() for c in ("rid", "side", "copies"))
        keys = np.asarray(t.column("keys").combine_chunks().flatten()).reshape(t.num_rows, -1)
        (_, x), = _matrix(t.column("vec").combine_chunks())
        counts, joined = _piece_links(rid, side, copies, t.column("t")[0].as_py(), keys, x, cosine)
        has = np.flatnonzero(counts)
        if len(has):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([rid[has], [rid[i] for i, _ in joined]]).astype(np.int64)),
                                              pa.array([None] * len(has) + [int(rid[j]) for _, j in joined], pa.int64()),
                                              pa.array([int(c) for c in counts[has]] + [None] * len(joined), pa.int64())],
                                             names=["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            marks = [t.column(c).to_numpy() for c in ("bk", "lo", "hi")]
            new = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1 if t.num_rows else np.zeros(0, np.int64)
            for a, b in zip([0, *new[:-1]], new):
                yield from one(t.slice(a, b - a))
            rest = t.slice(new[-1] if len(new) else 0)
        if rest is not None and rest.num_rows:
            yield from one(rest)

    return run


def links(reps: DataFrame, k: int, tables: int, cosine: float = COSINE) -> DataFrame:
    """(u, v, n) from ``reps(rid, label, vec, copies)``: rows (u, null, n) to be summed, and joining links (u, v, null)."""
    sketch = stage(reps.mapInArrow(_hasher(k, tables), "rid long, vec array<double>, copies long, keys array<long>"), "pstable-sketch")
    buckets = sketch.select("rid", F.posexplode("keys").alias("t", "bk"))
    shared = stage(buckets.groupBy("bk").agg(F.count("*").alias("size")).where("size > 1"), "pstable-shared")
    live = buckets.join(shared, "bk")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (live.join(sketch, "rid").withColumn("block", F.pmod(F.xxhash64("rid", "bk"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("bk", "t", "rid", "copies", "keys", "vec", F.least("block", "other").alias("lo"),
                     F.greatest("block", "other").alias("hi"),
                     F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")))
    return (dealt.repartition("bk", "lo", "hi").sortWithinPartitions("bk", "lo", "hi", "rid")
            .mapInArrow(_pieces(cosine), "u long, v long, n long"))


def near_duplicates(vectors: DataFrame, vec: str = "embedding", label: str = "label", vec_id: str = "vec_id",
                    cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    spark = vectors.sparkSession
    v = F.col(vec).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = F.coalesce(F.col(label).isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda e: e != 0), F.lit(False))
    rows = stage(vectors.select(F.col(vec_id).alias("id"), F.col(label).cast("long").alias("label"),
                                F.when(usable, v).alias("vec")).withColumn("rid", F.monotonically_increasing_id()), "pstable-rows")
    prints = [F.xxhash64("label", "vec").alias("f1"), F.xxhash64("vec", F.lit(1), "label").alias("f2")]
    usable_rows = rows.where("vec is not null").select("rid", "label", *prints)
    # Tables by key are staged, so that a key with very many rows meets its own in a join that Spark splits.
    same = stage(usable_rows.groupBy("f1", "f2").agg(F.min("rid").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label")),
                 "pstable-same")
    member = stage(usable_rows.drop("label").join(same, ["f1", "f2"]).select("rid", "rep", "copies", "label"), "pstable-member")
    largest = member.where("rid = rep").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables = index_size(largest, cosine)
    reps = rows.drop("label").join(member.where("rid = rep"), "rid").select("rid", "label", "vec", "copies")
    found = stage(links(reps, k, tables, cosine), "pstable-links")
    counted = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    comps = components(found.where("v is not null").select("u", "v")).withColumnsRenamed({"node": "rep", "component": "comp"})
    about = stage(member.where("rid = rep").select("rep").join(counted, "rep", "left").join(comps, "rep", "left"), "pstable-reps")
    marked = (rows.select("rid", "id").join(member, "rid", "left").join(about, "rep", "left")
              .select("id", F.coalesce("comp", "rep", "rid").alias("comp"),
                      (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links")))
    marked = stage(marked, "pstable-marked")
    least = stage(marked.groupBy("comp").agg(F.min("id").alias("component_id")), "pstable-least")
    return marked.join(least, "comp").select(F.col("id").alias("vec_id"), "n_links", "component_id",
                                             F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def digest(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    return near_duplicates(vectors)


#: All pairs of equal labels by brute force; components by walking the links.
ORACLE = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(u, v) AS (SELECT u, v FROM near UNION SELECT r.u, n.v FROM reach r JOIN near n ON r.v = n.u),
comp AS (SELECT u, least(u, min(v)) AS c FROM reach GROUP BY u),
links AS (SELECT u, count(*) AS n FROM near GROUP BY u)
SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(c.c, e.vec_id) AS component_id,
       coalesce(c.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN comp c ON c.u = e.vec_id LEFT JOIN links l ON l.u = e.vec_id
"""
