"""Multisets of five-word shingles as sorted hashes with counts."""

from __future__ import annotations

import numpy as np

from salesmart.llm.common import Words, mix

SHINGLE = 5
#: Shingle hashes keep 52 bits, so that (row of a slice, hash) sorts as one 64-bit key.
HASH_BITS = 52

_U = np.uint64
_STEP = mix(np.arange(11, 11 + SHINGLE, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def shingle_multisets(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count, first) of the distinct shingles, ordered by row and hash.

    A text of one to four words is one shingle; a text without words has none.  ``first`` marks
    where each row begins.
    """
    hashes, rows = [], []
    long_enough = w.per_row[w.row] >= SHINGLE
    at = np.flatnonzero(long_enough[:len(w.row) - SHINGLE + 1] & (w.row[SHINGLE - 1:] == w.row[:len(w.row) - SHINGLE + 1])) \
        if len(w.row) >= SHINGLE else np.zeros(0, np.int64)
    whole = np.zeros(len(at), np.uint64)
    for j in range(SHINGLE):
        whole += w.hash[at + j] * _STEP[j]
    hashes.append(mix(whole))
    rows.append(w.row[at])
    for n in range(1, SHINGLE):
        short = np.flatnonzero(w.per_row == n)
        part = np.full(len(short), n, np.uint64)
        for j in range(n):
            part += w.hash[w.first[short] + j] * _STEP[j]
        hashes.append(mix(part))
        rows.append(short)
    key = (np.concatenate(rows).astype(np.uint64) << _U(HASH_BITS)) | (np.concatenate(hashes) >> _U(64 - HASH_BITS))
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([new, [len(key)]]))
    key = key[new]
    row = (key >> _U(HASH_BITS)).astype(np.int64)
    first = np.searchsorted(row, np.arange(w.rows + 1))
    return row, key & _U((1 << HASH_BITS) - 1), count, first


def multiset_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of minima, sum of maxima) of two (sorted hashes, counts)."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    low = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return low, int(a[1].sum()) + int(b[1].sum()) - low
