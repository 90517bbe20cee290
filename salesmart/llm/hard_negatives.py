"""Operator 13, hard negatives by exact integer inner products, multiplied by Strassen's recursion.

Vectors are quantised to floor(``SCALE`` * x), x as double.  Rows are packed into tiles of at most one Arrow batch
in a staged table.  Anchors are taken in blocks of at most ``ANCHORS`` rows and ``ANCHOR_BYTES``: one block at a time
is read from the staged tiles, broadcast, and multiplied with every candidate tile.  A product of int64 tiles
halves all three sides, zero-padded to even ones, into Strassen's seven products down to ``LEAF``;
additions wrap modulo 2^64, so a score is exact whenever it fits in 64 bits itself.

Pass one keeps for each anchor a heap of its first ``POSITIVES`` other rows of its label (higher score first, ties by smaller
vec_id, then row number); pass two keeps for each anchor and positive a heap of the first ``NEGATIVES`` rows of other
labels inside the window 50 * positive <= 100 * negative <= 95 * positive.  A task merges the heaps
of its tiles and passes on one heap per anchor; Spark merges those of all tasks by a window whose
group limit runs before the shuffle.  Nothing is sampled: every anchor meets every row.

Rows.  Null labels, null vectors and vectors with a null or non-finite component take no part.  Missing components
of a shorter vector count as 0, so an empty vector scores 0 with all.  Repeated vec_ids are different rows: a row is no
positive of itself, but a copy of it is.  A null vec_id is no anchor; as a candidate it comes last among ties.
A row with a component that is 2^27 or more in size after scaling could overflow a score and is refused with an error.
An empty table, or one without anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score in hundredths of the positive's.
LEAST, MOST = 50, 95
#: Side of a product below which it is multiplied directly.
LEAF = 16
#: Rows and bytes of an anchor block (collected, broadcast, and scored against all tiles), rows of it in one product.
ANCHORS, ANCHOR_BYTES, STRIP = 16_384, 16 << 20, 512
LIMIT = 1 << 27

_ABSENT = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2^64."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2))) if n % 2 or k % 2 else a
    b = np.pad(b, ((0, k % 2), (0, m % 2))) if k % 2 or m % 2 else b
    p, q, r = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:p, :q], a[:p, q:], a[p:, :q], a[p:, q:]
    b11, b12, b21, b22 = b[:q, :r], b[:q, r:], b[q:, :r], b[q:, r:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * p, 2 * r), np.int64)
    out[:p, :r] = m1 + m4 - m5 + m7
    out[:p, r:] = m3 + m5
    out[p:, :r] = m2 + m4
    out[p:, r:] = m1 - m2 + m3 + m6
    return out[:n, :m]


def quantised(column: pa.Array) -> np.ndarray:
    """Rows of floor(SCALE * x), shorter ones padded with zeros."""
    lengths = np.array(column.value_lengths(), np.int64)
    flat = np.floor(np.asarray(column.flatten(), np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT // SCALE} or more in size: its scores may not fit in 64 bits")
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat.astype(np.int64)
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, id, label, vector) -> one tile per batch: rows sorted by id and rid, arrays as little-endian int64."""
    for batch in batches:
        if batch.num_rows:
            rid, ids, label = (np.asarray(batch.column(k).fill_null(_ABSENT)).astype(np.int64) for k in range(3))
            q, order = quantised(batch.column(3)), np.lexsort((rid, ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(order)], pa.int32()), *(pa.array([x[order].astype("<i8").tobytes()], pa.binary()) for x in (rid, ids, label, q))],
                names=["rows", "rid", "id", "label", "q"])


def _unpack(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    rid, ids, label, q = (np.frombuffer(batch.column(c)[k].as_py(), "<i8").astype(np.int64, copy=False) for c in ("rid", "id", "label", "q"))
    return rid, ids, label, q.reshape(len(rid), -1)


def _wide(q: np.ndarray, width: int) -> np.ndarray:
    return np.pad(q, ((0, 0), (0, width - q.shape[1]))) if q.shape[1] < width else q


def _scores(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], q.shape[1], 1)
    return strassen(_wide(a, width), np.ascontiguousarray(_wide(q, width).T))


def _first(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, rid: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The first ``n`` entries of each slot: the merge of heaps, and how they are filled."""
    order = np.lexsort((rid, ids, -score, slot))
    slot = slot[order]
    start = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
    place = np.arange(len(slot)) - np.repeat(start, np.diff(np.concatenate([start, [len(slot)]])))
    keep = order[place < n]
    return slot[place < n], score[keep], ids[keep], rid[keep]


def _emit(heap: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    slot, score, ids, rid = heap
    return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(ids, mask=ids == _ABSENT), pa.array(rid)],
                                      names=["slot", "score", "id", "rid"])


def _merged(heap: tuple | None, more: tuple, n: int) -> tuple:
    return _first(*more, n) if heap is None else _first(*(np.concatenate(x) for x in zip(heap, more)), n)


def _positives(block):
    """Tiles -> for each anchor (slot) of the block its first other rows of its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_rid, _, a_label, a_q = block.value
        heap = None
        for batch in batches:
            for k in range(batch.num_rows):
                rid, ids, label, q = _unpack(batch, k)
                for mine in np.intersect1d(a_label, label):
                    anchors, own = np.flatnonzero(a_label == mine), np.flatnonzero(label == mine)
                    for at in range(0, len(anchors), STRIP):
                        strip = anchors[at:at + STRIP]
                        s = _scores(a_q[strip], q[own])
                        n = min(len(own), POSITIVES + 1)  # one more: the anchor itself may be among them
                        floor = np.partition(s, len(own) - n, axis=1)[:, len(own) - n]
                        i, j = np.nonzero((s >= floor[:, None]) & (rid[own][None, :] != a_rid[strip][:, None]))
                        heap = _merged(heap, (strip[i], s[i, j], ids[own[j]], rid[own[j]]), POSITIVES)
        if heap is not None:
            yield _emit(heap)

    return run


def _negatives(block, goals):
    """Tiles -> for each (anchor, positive), slot anchor * POSITIVES + place, its first rows in the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, a_label, a_q = block.value
        goal = goals.value  # (anchors, POSITIVES) scores
        known = goal != _ABSENT
        low = np.where(known, -(-LEAST * goal // 100), _ABSENT)
        high = np.where(known, MOST * goal // 100, -_ABSENT)
        heap = None
        for batch in batches:
            for k in range(batch.num_rows):
                rid, ids, label, q = _unpack(batch, k)
                for at in range(0, len(a_q), STRIP):
                    part = slice(at, at + STRIP)
                    s = _scores(a_q[part], q)
                    i, j = np.nonzero((s >= low[part].min(axis=1)[:, None]) & (s <= high[part].max(axis=1)[:, None])
                                      & (label[None, :] != a_label[part][:, None]))
                    found = s[i, j]
                    for p in range(POSITIVES):
                        inside = (found >= low[at + i, p]) & (found <= high[at + i, p])
                        if inside.any():
                            more = ((at + i[inside]) * POSITIVES + p, found[inside], ids[j[inside]], rid[j[inside]])
                            heap = _merged(heap, more, NEGATIVES)
        if heap is not None:
            yield _emit(heap)

    return run


_HEAP = "slot long, score long, id long, rid long"


def _first_of(heaps: DataFrame, n: int) -> DataFrame:
    """The heaps of all tasks merged: the first ``n`` rows of each slot with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _blocks(tiles: DataFrame, every: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors (vec_id divisible by ``every``) in blocks of bounded rows and bytes, a tile's anchors at a time."""

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rid, ids, label, q = _unpack(batch, k)
                at = np.flatnonzero((ids % every == 0) & (ids != _ABSENT))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(at)], pa.int32()), *(pa.array([x[at].tobytes()], pa.binary()) for x in (rid, ids, label, q))],
                        names=["rows", "rid", "id", "label", "q"])

    parts, rows, size = [], 0, 0
    for row in tiles.mapInArrow(only, tiles.schema).toLocalIterator():
        if parts and (rows + row.rows > ANCHORS or size + len(row.q) > ANCHOR_BYTES):
            yield _joined(parts)
            parts, rows, size = [], 0, 0
        rid, ids, label = (np.frombuffer(row[c], "<i8") for c in ("rid", "id", "label"))
        parts.append((rid, ids, label, np.frombuffer(row.q, "<i8").reshape(len(rid), -1)))
        rows, size = rows + row.rows, size + len(row.q)
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    width = max(p[3].shape[1] for p in parts)
    return (*(np.concatenate([p[k] for p in parts]) for k in range(3)), np.concatenate([_wide(p[3], width) for p in parts]))


def hard_negatives(vectors: DataFrame, label: Column, every: int = 50, vec: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors of ``vectors``."""
    spark = vectors.sparkSession
    v = F.col(vec).cast("array<double>")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(vec_id).cast("long").alias("id"),
                          label.cast("long").alias("label"), F.when(fine, v).alias("vec")).where("label is not null and vec is not null")
    tiles = stage(rows.mapInArrow(_pack, "rows int, rid binary, id binary, label binary, q binary"), "negatives-tiles")
    out = None
    for anchors in _blocks(tiles, every):
        block = spark.sparkContext.broadcast(anchors)
        positives = stage(_first_of(tiles.mapInArrow(_positives(block), _HEAP), POSITIVES), "negatives-positives")
        goal = np.full((len(anchors[0]), POSITIVES), _ABSENT)
        for r in positives.select("slot", "rank", "score").collect():  # at most POSITIVES rows for each anchor of the block
            goal[r.slot, r.rank - 1] = r.score
        heaps = tiles.mapInArrow(_negatives(block, spark.sparkContext.broadcast(goal)), _HEAP)
        about = positives.select((F.col("slot") * POSITIVES + F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                                 F.col("score").alias("positive_score"), F.col("slot").alias("anchor"))
        names = spark.createDataFrame(pa.table({"anchor": np.arange(len(anchors[1])), "anchor_id": anchors[1]}))
        part = (_first_of(heaps, NEGATIVES).join(about, "slot").join(names, "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
        part = stage(part, "negatives")
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out


def digest(vectors: DataFrame) -> DataFrame:
    """Hard negatives of the given table; labels of rows whose vec_id is divisible by 7 are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, moved)


ORACLE = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score
    FROM v a JOIN v c ON a.id <> c.id WHERE a.id % 50 = 0),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
