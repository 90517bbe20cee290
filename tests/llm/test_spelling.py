import re
import zlib
from collections import Counter, defaultdict

import pytest
from brute import lower_ascii

from salesmart.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def counted(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(words):
    """word -> (form, root, n, n_near, form_n); candidates share a word with one code point deleted."""
    holes = defaultdict(set)
    for w in words:
        for v in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            holes[v].add(w)
    close = {w: {x for v in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))} for x in holes[v] if near(w, x)} for w in words}
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = form[w], root, words[w], len(close[w]), words[form[w]] if form[w] else None
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute(counted([(r.doc_id, r.text) for r in docs.collect()]))
    assert found(spelling.digest(docs)) == want
    assert any(v[0] for v in want.values()) and any(v[1] != v[0] for v in want.values() if v[0])


def test_hot_buckets_are_halved_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BUCKET_PAIRS", 3)
    stem = "abcdefghijklmnop"
    words = {stem[:k] + x + stem[k + d:]: 10 * k + d for k in range(16) for x in ("", "q", "rs", "é") for d in (0, 1)}
    words.update({w[::-1]: n + 1 for w, n in list(words.items())})
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    assert found(spelling.variants(df)) == brute(words)


def test_ties_accents_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "École école ecole"), (1, None), (2, ""), (2, "abcd " * 5), (3, "überall Überall überal"),
            (7, "houses house, HOUSE-house;housf housf housf housg"), (7, "houses house, HOUSE-house;housf housf housf housg"),
            (8, "中houses中 houses\U0001F600housg housg \x00housg"), (9, "a" * 70 + " " + ("a" * 69 + " ") * 9)]
    rows = rows * 3
    df = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int, word string")
    assert found(spelling.digest(df)) == brute(counted(rows))
    assert spelling.digest(df.limit(0)).count() == 0


def test_very_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_BYTES", 50)
    monkeypatch.setattr(spelling, "TABLE_WORDS", 7)
    words = [f"w{'abcdefghij'[i % 10] * (3 + i % 7)}è" for i in range(400)]
    rows = [(k, " ".join(words[k:]) + "z" * 300) for k in range(4)]
    got = spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.word: r.n for r in got.collect()} == counted(rows)


@pytest.mark.parametrize("size", [5, 6, 7, 8, 13])
def test_every_single_edit_is_found(spark, size):
    base = "abcdefghijklm"[:size]
    words = {base, *(base[:k] + base[k + 1:] for k in range(size)), *(base[:k] + "z" + base[k:] for k in range(size + 1)),
             *(base[:k] + "z" + base[k + 1:] for k in range(size)), "a" * size, "a" * (size + 1), "a" * (size - 1)}
    words = {w: 3 for w in words if len(w) >= 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = {frozenset((r.a, r.b)) for r in spelling.near_pairs(df).collect()}
    assert pairs == {frozenset((a, b)) for a in words for b in words if near(a, b)}
