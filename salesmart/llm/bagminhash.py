"""Operator 7, near-duplicate classes by BagMinHash over multisets of five-word shingles.

Signature.  A shingle that occurs c times owns the weight interval [0, c).  Intervals are cut
into dyadic levels [0,1), [1,2), [2,4), ...; each (shingle, level) drives a Poisson process whose
rate is the level's width.  A point carries a time, a position in the interval and one of
``SIZE`` signature components; points beyond the shingle's weight are thinned out.  A component
keeps its earliest point, so two documents agree in a component with probability sum(min)/sum(max)
of their counts: unbiased weighted Jaccard.  Processes run only to the time by which a
document's whole signature is sure to be filled (else that time is doubled), a few points per
shingle instead of one hash per shingle and component.

Candidates.  ``BANDS`` bands of ``ROWS`` components; a pair of similarity 0.8 shares no band with
probability 7e-6, and its signatures agree in so few components that it is not verified (``AGREEMENT``) with
probability 1e-6 (binomial; less for closer pairs), so at most 8e-6 of such pairs are missed.  Texts with equal shingle multisets are merged first.  Inside a bucket no list of
pairs is made: all members are compared with one hub, and what hubs leave open (members of
different components that were never compared) is compared inside tasks, block by block of bounded
size, which emit only links that join components.  Every link is verified on the texts:
sum(min)/sum(max) of shingle counts >= ``SIMILARITY``.
Classes are the connected components of verified links.

Words: letters, digits and non-ASCII characters, A-Z lower-cased.  Texts of one to four words are
one shingle.  Texts without words (also null, empty) form classes by equal text, null equal to
empty.  Rows may repeat, also with equal or null ids: every row belongs to the class of its text,
and ``keep_one`` keeps exactly one row of each class, the one with the smallest (id, row number),
null ids last.  Input must be a repeatable scan (a stored table): rows are numbered by it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import LETTERS, Words, free_name, mix, stage, text_slices
from salesmart.llm.components import components
from salesmart.llm.shingles import multiset_jaccard, shingle_multisets

SIMILARITY = 0.8
BANDS, ROWS = 30, 5
SIZE = BANDS * ROWS
#: Signature agreement below which a candidate is not verified: 0.8 less five standard deviations.
AGREEMENT = SIMILARITY - 5 * math.sqrt(SIMILARITY * (1 - SIMILARITY) / SIZE)
#: Rows and bytes of text of a block of the blockwise comparison.
BLOCK, BLOCK_BYTES = 1000, 8 << 20

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_SINGLE, _STRIDE = 8, 128


def _processes(shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index of the shingle, seed, rate, accepted share) of every level a shingle reaches."""
    index = np.arange(len(shingle))
    parts = []
    at = 0
    while len(index):
        low = 0 if at == 0 else 1 << (at - 1)
        width = max(low, 1)
        seed = mix(shingle[index] + _U((at + 1) * int(_GOLDEN) % (1 << 64)))
        parts.append((index, seed, np.full(len(index), float(width)), np.minimum(1.0, (count[index] - low) / width)))
        index = index[count[index] > low + width]
        at += 1
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.zeros(0, t) for t in (np.int64, np.uint64, float, float))


def _points(seed: np.ndarray, rate: np.ndarray, share: np.ndarray, until: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(process, time, component, identity) of accepted points up to each process's end, in chunks."""
    alive, time, drawn = np.arange(len(seed)), np.zeros(len(seed)), 0
    while len(alive):
        step = 1 if drawn < _SINGLE else _STRIDE
        piece = alive if step == 1 else alive[:4096]
        while len(piece):
            number = np.arange(drawn + 1, drawn + 1 + step, dtype=np.uint64) * _GOLDEN
            draw = mix(seed[piece][:, None] + number[None, :])
            gap = -np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate[piece][:, None]
            t = time[piece][:, None] + np.cumsum(gap, axis=1)
            other = mix(draw ^ _U(0x2545F4914F6CDD1D))
            ok = (t <= until[piece][:, None]) & ((other & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 < share[piece][:, None])
            who, which = np.nonzero(ok)
            component = (((other[who, which] >> _U(32)) * _U(SIZE)) >> _U(32)).astype(np.int64)
            yield piece[who], t[who, which], component, draw[who, which]
            time[piece] = t[:, -1]
            if step == 1:
                break
            at = int(np.searchsorted(alive, piece[-1], side="right"))
            piece = alive[at:at + 4096]
        drawn += step
        alive = alive[time[alive] <= until[alive]]


def signatures(rows: int, row: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(rows, SIZE) identities of the earliest point per component; rows without shingles stay 0."""
    ids = np.zeros(rows * SIZE, np.uint64)
    weight = np.bincount(row, weights=count, minlength=rows)
    index, seed, rate, share = _processes(shingle, count)
    owner = row[index]
    end = np.zeros(rows)
    end[weight > 0] = SIZE * (math.log(SIZE) + 6) / weight[weight > 0]
    todo = weight > 0
    while todo.any():
        use = np.flatnonzero(todo[owner])
        best = np.full(rows * SIZE, np.inf)
        chunks = []
        for process, t, component, identity in _points(seed[use], rate[use], share[use], end[owner[use]]):
            slot = owner[use[process]] * SIZE + component
            np.minimum.at(best, slot, t)
            chunks.append((slot, t, identity))
        filled = np.isfinite(best.reshape(rows, SIZE)).all(axis=1) & todo
        for slot, t, identity in chunks:
            first = (t == best[slot]) & filled[slot // SIZE]
            ids[slot[first]] = identity[first]
        todo &= ~filled
        end[todo] *= 2
    return ids.reshape(rows, SIZE)


def _band_keys(ids: np.ndarray) -> np.ndarray:
    parts = ids.reshape(len(ids), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN, parts.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key + parts[:, :, j])
    return key.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row id, text) -> row id, fingerprint of the shingle multiset, band keys, signature bytes."""
    for batch in batches:
        for at, end, raw, offsets in text_slices(batch.column(1)):
            w = Words(raw, offsets, LETTERS)
            row, shingle, count, first = shingle_multisets(w)
            ids = signatures(w.rows, row, shingle, count)
            one = mix(shingle * _U(0xA0761D6478BD642F) + count.astype(np.uint64))
            two = mix(one ^ _U(0xE7037ED1A0B428DB))
            prints = []
            for x in (one, two):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
                prints.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64).copy())
            empty = np.flatnonzero(w.per_row == 0)
            for r in empty:
                digest = hashlib.blake2b(raw[offsets[r]:offsets[r + 1]].tobytes(), digest_size=16).digest()
                prints[0][r], prints[1][r] = np.frombuffer(digest, np.int64)
            keys = pa.array(list(_band_keys(ids)), pa.list_(pa.int64()))
            bits = (ids & _U(0xFF)).astype(np.uint8)
            bytes_ = pa.array([None if w.per_row[r] == 0 else bits[r].tobytes() for r in range(w.rows)], pa.binary())
            if len(empty):
                keep = np.ones(w.rows, bool)
                keep[empty] = False
                keys = pa.array([k if ok else [] for k, ok in zip(_band_keys(ids), keep)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, end - at), pa.array(prints[0]), pa.array(prints[1]), keys, bytes_,
                 pa.array(np.diff(offsets))], names=["rid", "f1", "f2", "bands", "sig", "size"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SIZE) for k in (2, 3))
        ok = (a == b).mean(axis=1) >= AGREEMENT if batch.num_rows else np.zeros(0, bool)
        yield batch.select([0, 1]).filter(pa.array(ok))


def _multiset(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    _, shingle, count, _ = shingle_multisets(Words(raw, np.array([0, len(raw)]), LETTERS))
    return shingle, count


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, text of u, text of v) -> links with their similarity; a hub's multiset is made once in a run of rows."""
    last: tuple[int | None, tuple] = (None, ())
    for batch in batches:
        u, v, score = [], [], []
        for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
            if last[0] != a:
                last = a, _multiset(ta)
            low, high = multiset_jaccard(last[1], _multiset(tb))
            if high and low >= SIMILARITY * high - 1e-9:
                u.append(a)
                v.append(b)
                score.append(low / high)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(score, pa.float64())],
                                         names=["u", "v", "similarity"])


def _block_links(table: pa.Table) -> pa.Table:
    """Rows of two blocks of one bucket -> verified links that join different components.

    Pairs whose signatures agree are verified on the spot, most alike first; components that a link has
    joined need no further link between them, so a block emits fewer links than it has components.
    """
    block, rid, comp = (table.column(c).to_numpy() for c in ("block", "rid", "comp"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, SIZE)
    texts, made = table.column("t"), {}

    def multiset(k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in made:
            made[k] = _multiset(texts[k].as_py())
        return made[k]

    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    _, label = np.unique(comp, return_inverse=True)
    u, v, score = [], [], []
    for i in left:
        others = right[label[right] != label[i]]
        if lo == hi:
            others = others[rid[others] > rid[i]]
        agree = (sig[others] == sig[i]).mean(axis=1) if len(others) else np.zeros(0)
        for k in np.argsort(-agree, kind="stable"):
            j = int(others[k])
            if agree[k] < AGREEMENT:
                break
            if label[i] == label[j]:
                continue
            low, high = multiset_jaccard(multiset(int(i)), multiset(j))
            if low >= SIMILARITY * high - 1e-9:
                u.append(min(rid[i], rid[j]))
                v.append(max(rid[i], rid[j]))
                score.append(low / high)
                label[label == label[j]] = label[i]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "similarity": pa.array(score, pa.float64())})


def numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("rid", F.monotonically_increasing_id())


def classes(docs: DataFrame, text: str = "text", rid: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rid, class) of every row, and the verified links (u, v, similarity) between representatives.

    ``rid`` names a stored column that numbers the rows; without it, rows are numbered in the order of the
    scan, once, in a staged copy.  A class is the smallest rid of its rows' representatives.
    """
    rows = docs.select((F.col(rid) if rid else F.monotonically_increasing_id()).alias("rid"), F.col(text).alias("t"))
    if not rid:
        rows = stage(rows, "bag-rows")
    sketch = stage(rows.mapInArrow(_sketch, "rid long, f1 long, f2 long, bands array<long>, sig binary, size long"), "bag-sketch")
    least = stage(sketch.groupBy("f1", "f2").agg(F.min("rid").alias("rep")), "bag-least")
    member = sketch.select("rid", "f1", "f2").join(least, ["f1", "f2"]).select("rid", "rep")
    member = stage(member, "bag-member")
    reps = stage(sketch.join(member.where("rid = rep").select("rid"), "rid", "left_semi").where(F.size("bands") > 0)
                 .select("rid", "bands", "sig", "size"), "bag-reps")
    buckets = reps.select("rid", F.explode("bands").alias("bk"))
    # Staged, so that a bucket holding a large group meets it in a join whose skewed partitions Spark splits.
    shared = stage(buckets.groupBy("bk").agg(F.min("rid").alias("hub"), F.max("rid").alias("top")).where("hub <> top").select("bk", "hub"),
                   "bag-shared")
    buckets = stage(buckets.join(shared, "bk"), "bag-buckets")
    signature = reps.select("rid", "sig")
    texts = stage(rows.join(buckets.select("rid").distinct(), "rid", "left_semi"), "bag-texts")

    def linked(pairs: DataFrame) -> DataFrame:
        near = (pairs.join(signature.withColumnsRenamed({"rid": "v", "sig": "sv"}), "v")
                .join(signature.withColumnsRenamed({"rid": "u", "sig": "su"}), "u")
                .select("u", "v", "su", "sv").mapInArrow(_agree, "u long, v long"))
        near = stage(near, "bag-candidates")
        full = (near.join(texts.withColumnsRenamed({"rid": "v", "t": "tv"}), "v")
                .join(texts.withColumnsRenamed({"rid": "u", "t": "tu"}), "u").select("u", "v", "tu", "tv"))
        return stage(full.mapInArrow(_verify, "u long, v long, similarity double"), "bag-links")

    first = buckets.where("rid <> hub").select(F.col("hub").alias("u"), F.col("rid").alias("v")).distinct()
    links = linked(first)
    comps = stage(components(links.select("u", "v")), "bag-components")
    # Members of different components that no hub has compared.
    left = buckets.where("rid <> hub").select("bk", "rid").join(
        comps.withColumnsRenamed({"node": "rid", "component": "comp"}), "rid", "left") \
        .select("bk", "rid", F.coalesce("comp", "rid").alias("comp")).join(reps.select("rid", "sig", "size"), "rid")
    left = stage(left, "bag-left")
    comps_of = left.groupBy("bk", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    split = (comps_of.groupBy("bk").agg(F.max_by("comp", F.struct("n", "comp")).alias("big"), F.count("*").alias("comps"),
                                        F.max("n").alias("n_big"), F.max_by("bytes", F.struct("n", "comp")).alias("bytes_big"),
                                        F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("comps > 1"))
    more = _blockwise(left.join(stage(split, "bag-open"), "bk"), texts)
    links = links.unionAll(stage(more, "bag-links"))
    comps = stage(components(links.select("u", "v")), "bag-components")
    result = member.join(comps.withColumnsRenamed({"node": "rep", "component": "comp"}), "rep", "left") \
        .select("rid", F.coalesce("comp", "rep").alias("class"))
    return result, links


def _blockwise(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links inside each open bucket, compared in tasks by blocks of bounded rows and bytes.

    Members of one component need no comparison, so those of a bucket's largest component meet only
    the others: its blocks come after the others' and pair with these alone.
    """
    def blocks(rows: str, size: str) -> F.Column:
        return F.greatest(F.ceil(F.expr(rows) / BLOCK), F.ceil(F.expr(size) / BLOCK_BYTES)).cast("int")

    few, many = blocks("n - n_big", "bytes - bytes_big"), blocks("n_big", "bytes_big")
    is_big, spread = F.col("comp") == F.col("big"), F.xxhash64("rid", F.lit(7))
    partners = F.sequence(F.lit(0), F.when(is_big, few - 1).otherwise(few + many - 1))
    dealt = (left.withColumn("block", F.when(is_big, few + F.pmod(spread, many)).otherwise(F.pmod(spread, few)).cast("int"))
             .withColumn("other", F.explode(partners)).join(texts, "rid")
             .select("bk", "rid", "comp", "sig", "t", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    return dealt.groupBy("bk", "lo", "hi").applyInArrow(_block_links, "u long, v long, similarity double")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_rows, is_first."""
    rows = stage(numbered(docs.select("doc_id", "text")), "bag-rows")
    found, _ = classes(rows, rid="rid")
    marked = stage(rows.select("doc_id", "rid").join(found, "rid"), "bag-classes")
    sizes = stage(marked.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows")), "bag-sizes")
    return marked.join(sizes, "class").select(
        "doc_id", "class_id", "class_rows", (F.col("doc_id") == F.col("class_id")).alias("is_first"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one row of each class, unchanged otherwise."""
    spare = free_name(docs.columns, "_row_of_scan")
    rows = stage(docs.withColumn(spare, F.monotonically_increasing_id()), "bag-rows")
    found, _ = classes(rows, text, spare)
    ids = rows.select(F.col(doc_id).alias("id"), F.col(spare).alias("rid"))
    first = (found.join(ids, "rid").groupBy("class")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("first"))
             .select(F.col("first.rid").alias(spare)))
    return rows.join(first, spare, "left_semi").select(*docs.columns)
