"""Operator 9, benchmark decontamination: a broadcast hash set of normalised test n-grams.

Texts and test items are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII
characters.  Every 13 consecutive words of an item form a window; an item of fewer words is one
window.  The 64-bit hashes of all windows are broadcast; each task slides over its documents'
words, looks up the few positions whose words all occur in the test set, and compares the words
of every hash match, so a reported hit is exact.

The broadcast is bounded: test items are dealt into blocks of at most ``block_bytes`` of text by
their size, and the documents pass through one block after the other (hit spans accumulate), so a
test set of any size needs no larger broadcast and no shuffle of documents.

Edge cases: null or wordless texts have no words, no hits and are not contaminated.  Null or
wordless items have no window.  Repeated items count once per distinct item_id; a null item_id
marks words as hit and is listed as the empty string.  Empty tables give the input rows unhit.
Repeated documents are each scanned.  Result columns that clash with input columns get a trailing
underscore; ``doc_columns`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import LETTERS, Words, free_name, lookup, mix, stage, word_slices

WINDOW = 13
BLOCK_BYTES = 4 << 20

_STEP = mix(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def _window_hash(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.full(len(at), length, np.uint64)
    for j in range(length):
        out += hashes[at + j] * _STEP[j]
    return mix(out)


class _TestSet:
    """Windows of one block of items, by length: sorted hashes and, for each, its places in the items."""

    def __init__(self, ids: list[str], texts: list[str]):
        encoded = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        sizes = [len(t) for t in encoded]
        self.ids = ids
        self.words = Words(raw, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), LETTERS)
        self.vocabulary = np.unique(self.words.hash)
        self.by_length = {}
        places: dict[int, list[np.ndarray]] = {}
        for item in range(len(texts)):
            first, n = int(self.words.first[item]), int(self.words.per_row[item])
            if n:
                length = min(n, WINDOW)
                places.setdefault(length, []).append(np.arange(first, first + n - length + 1))
        for length, parts in places.items():
            at = np.concatenate(parts)
            hashes = _window_hash(self.words.hash, at, length)
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = (hashes[order], at[order])

    def hits(self, w: Words) -> Iterator[tuple[int, int, set[int]]]:
        """(word index, window length, items) of every occurring window."""
        known = lookup(self.vocabulary, w.hash) >= 0
        unknown = np.concatenate([[0], np.cumsum(~known)])
        for length, (hashes, places) in self.by_length.items():
            n = len(w.hash) - length + 1
            if n <= 0:
                continue
            at = np.flatnonzero((unknown[length:] == unknown[:n]) & (w.row[length - 1:] == w.row[:n]))
            if len(at) == 0:
                continue
            found = _window_hash(w.hash, at, length)
            lo, hi = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
            for k in np.flatnonzero(hi > lo):
                phrase = w.phrase(int(at[k]), length)
                items = {int(self.words.row[p]) for p in places[lo[k]:hi[k]] if self.words.phrase(int(p), length) == phrase}
                if items:
                    yield int(at[k]), length, items


class _Blocks:
    """Items in blocks of bounded text, collected one at a time; an item's block follows from its hash and the measured total."""

    def __init__(self, benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
        self.items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                                      F.col(text).alias("t")).where(F.col("t").isNotNull()).distinct()
        total = self.items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        self.count = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1

    def read(self, k: int) -> tuple[list[str], list[str]]:
        rows = self.items.where(F.pmod(F.xxhash64("i", "t"), F.lit(self.count)) == k).toArrow()
        return rows.column("i").to_pylist(), rows.column("t").to_pylist()


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus n_words, n_hit, items (sorted distinct ids), hit_spans (character ranges).

    Returns the frame and the actual names of the added columns.
    """
    names = {c: free_name(docs.columns, c) for c in ("n_words", "n_hit", "items", "hit_spans")}
    spans_type = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(names["n_words"], T.LongType(), False),
                           T.StructField(names["n_hit"], T.LongType(), False),
                           T.StructField(names["items"], T.ArrayType(T.StringType(), False), False),
                           T.StructField(names["hit_spans"], T.ArrayType(spans_type, False), False)])
    width = len(docs.columns)
    blocks = _Blocks(benchmark, item_id, item_text, block_bytes)
    where = docs.columns.index(text)
    sc = docs.sparkSession.sparkContext
    out = docs
    for k in range(blocks.count):
        shared = sc.broadcast(blocks.read(k))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, earlier=k > 0) -> Iterator[pa.RecordBatch]:
            tests = _TestSet(*shared.value)
            for batch in batches:
                n_words = np.zeros(batch.num_rows, np.int64)
                n_hit = np.zeros(batch.num_rows, np.int64)
                items: list[list[str]] = batch.column(width + 2).to_pylist() if earlier else [[] for _ in range(batch.num_rows)]
                spans: list[list] = batch.column(width + 3).to_pylist() if earlier else [[] for _ in range(batch.num_rows)]
                for at, end, w in word_slices(batch.column(where), LETTERS):
                    n_words[at:end] = w.per_row
                    hit = {i: set(items[i]) for i in range(at, end) if items[i]}
                    cover = np.zeros(len(w.hash) + 1, np.int64)
                    for word, length, found in tests.hits(w):
                        cover[word] += 1
                        cover[word + length] -= 1
                        hit.setdefault(at + int(w.row[word]), set()).update(tests.ids[i] for i in found)
                    inside = np.cumsum(cover)[:-1] > 0
                    for row, found in hit.items():
                        lo, hi = int(w.first[row - at]), int(w.first[row - at + 1])
                        spans[row], n_hit[row] = _merge(w, row - at, inside[lo:hi], spans[row])
                        items[row] = sorted(found)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(n_words), pa.array(n_hit),
                     pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int32())))],
                    names=schema.names)

        out = out.mapInArrow(run, schema)
        if k + 1 < blocks.count:
            out = stage(out, "decontaminate")
            shared.unpersist()
    return out, names


def _merge(w: Words, row: int, inside: np.ndarray, earlier: list[list[int]]) -> tuple[list[list[int]], int]:
    """Character ranges of the row's hit words, with those of earlier blocks; and how many words they hold."""
    base = int(w.offsets[row])
    lo, hi = int(w.first[row]), int(w.first[row + 1])
    raw = w.raw[base:int(w.offsets[row + 1])]
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    start, end = chars[w.start[lo:hi] - base], chars[w.end[lo:hi] - base]
    for a, b in earlier:
        inside |= (start >= a) & (end <= b)
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return [[int(start[a]), int(end[b - 1])] for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))], int(inside.sum())


def contaminated(names: dict[str, str]) -> F.Column:
    """At least one hit word, and hit words make a twentieth of all words."""
    hit, words = F.col(names["n_hit"]), F.col(names["n_words"])
    return (hit > 0) & (20 * hit >= words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    marked, names = scan(docs, benchmark, text, **options)
    return marked.where(~contaminated(names)).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows of ``docs`` with every hit span cut out of the text."""
    marked, names = scan(docs, benchmark, text, **options)
    spans = F.col(names["hit_spans"])
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s[1]))
    starts = F.concat(F.transform(spans, lambda s: s[0]), F.array(F.length(text)))
    kept = F.array_join(F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")),
                                    lambda p: F.substring(F.col(text), p["a"] + 1, p["b"] - p["a"])), "")
    return marked.withColumn(text, F.when(F.size(spans) == 0, F.col(text)).otherwise(kept)).select(*docs.columns)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract columns of the query."""
    marked, names = scan(docs.select("doc_id", "text"), benchmark)
    items = F.col(names["items"])
    return marked.select(
        "doc_id", F.col(names["n_words"]).alias("n_words"), F.col(names["n_hit"]).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(names).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS g
       FROM i, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
dw AS (SELECT rid, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM d JOIN (SELECT DISTINCT n FROM iw) s ON len(w) >= n, unnest(range(1, len(w) - n + 2)) AS u(k)),
hit AS (SELECT rid, k, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
spans AS (SELECT DISTINCT rid, k, n FROM hit),
covered AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS x FROM spans) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered c ON d.rid = c.rid LEFT JOIN found f ON d.rid = f.rid
"""
