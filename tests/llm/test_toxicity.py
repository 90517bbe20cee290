import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import letters

from salesmart.llm import toxicity as tx
from salesmart.llm.common import LETTERS, word_slices


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def hash_of(word):
    return next(word_slices(pa.array([word]), LETTERS))[2].hash[0]


@pytest.fixture(scope="module")
def fitted(spark):
    # "francisco" is as frequent as "rest" but follows one word only.
    bad = [f"you vile idiot {a} go san francisco rest" for a in ("now", "then", "here", "away", "off", "home", "back", "there")]
    good = [f"we had lunch {a} in san francisco {a} rest" for a in ("one", "two", "three", "four", "five", "six", "seven", "eight")]
    rows = [(i, (bad if i % 2 else good)[i // 2 % 8] + f" n{i}", i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return rows, docs, labels, tx.train(docs, labels)


def test_words_back_off_to_their_distinct_contexts(fitted):
    rows, _, _, model = fitted
    fit = [(letters(t), y) for i, t, y in rows if fold(i) not in (tx.HELD_OUT_FOLD, tx.CALIBRATION_FOLD)]
    contexts, n = defaultdict(set), [Counter(), Counter()]
    for words, y in fit:
        n[y].update(set(words))
        for u, v in zip([None, *words], words):
            contexts[v].add(u)
    pooled, pairs = n[0] + n[1], sum(map(len, contexts.values()))
    held = [sum(max(c - tx.DISCOUNT, 0) for c in k.values()) for k in n]
    back = 1 - sum(max(c - tx.DISCOUNT, 0) for c in pooled.values()) / sum(pooled.values())
    keys, prob = model.levels[0]
    kept = [w for w in pooled if max(n[0][w], n[1][w]) > tx.DISCOUNT]
    assert len(keys) == len(kept) > 10 and len(contexts["francisco"]) == 1 < len(contexts["rest"])
    for w in kept:
        want = [(1 - back) * max(k[w] - tx.DISCOUNT, 0) / h + back * len(contexts[w]) / pairs for k, h in zip(n, held)]
        assert np.allclose(prob[np.searchsorted(keys, hash_of(w))], want)


def test_scores_part_the_classes(fitted):
    rows, docs, labels, _ = fitted
    got = {r.doc_id: r for r in tx.digest(docs, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in rows) and any(r.held_out for r in got.values())


def test_null_wordless_and_unlabelled(spark, fitted):
    rows, _, labels, model = fitted
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!?"), (3, "!?")], "doc_id long, text string")
    out, name = tx.score(odd, model)
    scores = [r[name] for r in out.collect()]
    assert len(scores) == 4 and len(set(scores)) == 1 and np.isclose(scores[0], 1 / (1 + np.exp(-model.weights[0])))
    assert [r.score for r in tx.digest(odd, labels.limit(0)).collect()] == [0.0] * 4
    assert tx.digest(odd.limit(0), labels).count() == 0


def brute_scores(docs, labels):
    """doc text -> score, recomputed with plain counters: word, stem and pair levels, features, calibration."""
    D, label = tx.DISCOUNT, defaultdict(int)
    for i, y in labels:
        if i is not None and y in (0, 1) and fold(i) != tx.HELD_OUT_FOLD:
            label[i] = max(label[i], y)
    sample = [((t or "").lower(), label[i], fold(i)) for i, t in docs if i in label]
    fit = defaultdict(int)
    for t, y, f in sample:
        if f != tx.CALIBRATION_FOLD:
            fit[t] = max(fit[t], y)

    def stem(w, n):
        return w[:n]

    singles, pairs = [Counter(), Counter()], [Counter(), Counter()]
    starts = set()
    for t, y in fit.items():
        w = letters(t)
        singles[y].update(set(w))
        pairs[y].update(set(zip(w, w[1:])))
        starts.update(w[:1])
    every = {(u, v) for k in pairs for u, v in k} | {(None, v) for v in starts}
    units = [lambda w: w, lambda w: stem(w, tx.STEMS[0]), lambda w: stem(w, tx.STEMS[1])]
    levels = []
    for unit in units:
        n = [Counter(), Counter()]
        for c in (0, 1):
            for w, k in singles[c].items():
                n[c][unit(w)] += k
        pooled = n[0] + n[1]
        held = [sum(max(k - D, 0) for k in c.values()) for c in n]
        back = 1 - sum(max(k - D, 0) for k in pooled.values()) / sum(pooled.values())
        contexts = Counter(x for _, x in {(u, unit(v)) for u, v in every})
        total = sum(contexts.values())
        levels.append({x: [(1 - back) * max(c[x] - D, 0) / h + back * contexts[x] / total for c, h in zip(n, held)]
                       for x in pooled if max(n[0][x], n[1][x]) > D})
    after = defaultdict(list)
    for u, v in {*pairs[0], *pairs[1]}:
        after[u].append((pairs[0][u, v], pairs[1][u, v]))
    held = {u: [sum(max(x[c] - D, 0) for x in k) for c in (0, 1)] for u, k in after.items()}
    backs = {u: 1 - sum(max(sum(x) - D, 0) for x in k) / sum(map(sum, k)) for u, k in after.items() if min(held[u]) > 0}

    def features(text):
        w = letters(text.lower())
        ratio, seen = [0.0] * len(w), set()
        for i, x in enumerate(w):
            if x in seen:
                continue
            seen.add(x)
            p = next((level[unit(x)] for unit, level in zip(units, levels) if unit(x) in level), [1.0, 1.0])
            u = w[i - 1] if i else None
            n = [k[u, x] for k in pairs]
            if u in backs and min(n) > D:
                p = [(1 - backs[u]) * max(n[c] - D, 0) / held[u][c] + backs[u] * p[c] for c in (0, 1)]
            ratio[i] = np.log(p[1] / p[0])
        if not w:
            return [0.0, 0.0, 0.0]
        stretch = [sum(ratio[i:i + tx.STRETCH]) / tx.STRETCH for i in range(len(w))]
        top = int(np.argmax(stretch))
        rest = [s if abs(i - top) >= tx.STRETCH else 0.0 for i, s in enumerate(stretch)]
        return [sum(ratio) / len(seen), max(stretch[top], 0), max(max(rest), 0)]

    calibration = [(features(t), y) for t, y, f in sample if f == tx.CALIBRATION_FOLD]
    weights = tx._logistic(np.array([f for f, _ in calibration]), np.array([float(y) for _, y in calibration]))
    gradient = sum((1 / (1 + np.exp(-(weights[0] + np.dot(f, weights[1:]))) ) - y) for f, y in calibration)
    assert abs(gradient) < 1e-3 * len(calibration)          # an optimum: the intercept is not penalised
    return [1 / (1 + np.exp(-np.clip(weights[0] + np.dot(features(t or ""), weights[1:]), -50, 50))) for _, t in docs]


def test_every_score_against_plain_counters(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    want = dict(zip([i for i, _ in rows], brute_scores(rows, [(r.doc_id, r.toxic) for r in labels.collect()])))
    got = tx.digest(docs, labels).collect()
    assert len(got) == len(rows) and max(abs(r.score - want[r.doc_id]) for r in got) < 1e-6
    assert 0.02 < sum(r.predicted for r in got) / len(got) < 0.5


def test_clashing_column_and_very_long_text(spark, fitted):
    _, _, _, model = fitted
    rows = [(1, "x", "we had lunch one in san " * 60000), (2, "y", "you vile idiot now go " * 60000)]
    out, name = tx.score(spark.createDataFrame(rows, "doc_id long, Toxicity string, text string"), model)
    assert name == "toxicity_" and [r.Toxicity for r in sorted(out.collect())] == ["x", "y"]
    scores = [r[name] for r in out.orderBy("doc_id").collect()]
    assert scores[0] < 0.5 < scores[1]


def test_the_labelled_sample_keeps_its_bound(spark, fitted, monkeypatch):
    rows, docs, labels, whole = fitted
    monkeypatch.setattr(tx, "MAX_LABELLED", 100)
    model = tx.train(docs, labels)
    assert 0 < len(model.levels[0][0]) and not np.array_equal(model.levels[0][1], whole.levels[0][1])
