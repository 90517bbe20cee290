"""Shared pieces: lineage cuts, Arrow batches and vectorised word tables over UTF-8 buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import shared_dir

#: Bytes of text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Rows handled at once; a row number of a slice fits in 12 bits.
SLICE_ROWS = 1 << 12

_U = np.uint64


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: ``df`` as Parquet below the cluster's shared checkpoint folder, read back."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def small_arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts travel in Arrow batches: keep a batch to a few MB of ordinary documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, lengthened until no column of the input has that name (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def fold_of(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32(doc_id as text) mod ``folds``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def byte_classes(separators: Iterable[tuple[int, int]], lower: bool = True) -> np.ndarray:
    """Byte -> 0 for separators (inclusive ranges), otherwise the byte, A-Z lower-cased on request."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    for lo, hi in separators:
        table[lo:hi + 1] = 0
    return table


#: Words between white space, `[^\x20\x09-\x0D]+`.  NUL is a word character, so it stands in as 1.
BLANKS = byte_classes([(0x20, 0x20), (0x09, 0x0D)])
BLANKS[0] = 1
#: Words of letters and digits, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
LETTERS = byte_classes([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the public splitmix64 constants), vectorised."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
_P = _U(0xD6E8FEB86659FD93)
_POW = [np.ones(1, np.uint64)]
_INV = [np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i (mod 2^64) for i < n, kept per process up to one slice."""
    if len(_POW[0]) < n:
        inverse = _U(pow(int(_P), -1, 1 << 64))
        one = np.ones(1, np.uint64)
        up = np.cumprod(np.concatenate([one, np.full(n - 1, _P, np.uint64)]))
        down = np.cumprod(np.concatenate([one, np.full(n - 1, inverse, np.uint64)]))
        if n > 4 * SLICE_BYTES:
            return up, down
        _POW[0], _INV[0] = up, down
    return _POW[0][:n], _INV[0][:n]


class Words:
    """Words of a slice of texts: row, byte start, byte end (into ``raw``) and a 64-bit hash each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.raw, self.offsets, self.rows = raw, offsets, len(offsets) - 1
        self.norm = norm = np.frombuffer(raw.tobytes().translate(table.tobytes()), np.uint8)
        n = len(raw)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = norm != 0
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut) & inside[1:])
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.first = np.searchsorted(self.start, offsets)
        self.per_row = np.diff(self.first)
        self.row = np.repeat(np.arange(self.rows), self.per_row)
        power, inverse = _powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.multiply(_CODE.take(norm), power[:n], out=self._sums[1:])
        np.cumsum(self._sums[1:], out=self._sums[1:])
        self._inverse = inverse
        self.hash = self.range_hash(self.start, self.end)

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the normalised bytes of ranges."""
        sums = self._sums.take(end)
        sums -= self._sums.take(start)
        sums *= self._inverse.take(start)
        sums += (end - start).astype(np.uint64)
        return mix(sums)

    def word(self, i: int) -> bytes:
        return self.norm[self.start[i]:self.end[i]].tobytes()

    def phrase(self, i: int, n: int) -> bytes:
        """The ``n`` normalised words from word ``i`` on, joined by one blank."""
        return b" ".join(self.word(k) for k in range(i, i + n))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32, n + 1 + column.offset)[column.offset:].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, at + SLICE_ROWS, max(end, at + 1))
        yield at, end, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def word_slices(column: pa.Array, table: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for at, end, raw, offsets in text_slices(column, limit):
        yield at, end, Words(raw, offsets, table)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``first`` marks (empty rows give 0)."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index into sorted unique ``keys`` of each wanted value, -1 where absent."""
    if len(keys) == 0:
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)
