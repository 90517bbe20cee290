import math

import numpy as np
import pytest

from salesmart.llm import pstable


def brute(rows):
    """(vec_id, vector, label) rows -> (vec_id, n_links, component_id, kept), in order."""
    def ok(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if ok(a, la) and ok(b, lb) and la == lb and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b >= 0.93 * math.sqrt((a @ a) * (b @ b)):
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), low, rows[i][0] is not None and rows[i][0] == low))
    return out


def check(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows],
                               "vec_id long, embedding array<double>, label int, rid int, copies string")
    got = [tuple(r) for r in pstable.digest(df).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def clustered(rng, centres, size, spread, d=24):
    out = []
    for c in range(centres):
        m = rng.standard_normal(d)
        out += [(m + spread * rng.standard_normal(d)).tolist() for _ in range(size)]
    return out


def test_clusters_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 12, 9, 0.12) + clustered(rng, 30, 1, 1) + clustered(rng, 2, 25, 0.02)
    check(spark, [(int(i), v, int(i) % 3) for i, v in zip(rng.permutation(1000)[:len(vectors)], vectors)], tmp_path)


def test_edges_copies_ties_and_clashing_columns(spark, tmp_path):
    a, b = [1.0, 2.0, 3.0, -1.0], [-3.0, 0.5, 0.0, 1.0]
    rows = [(5, a, 1), (5, a, 1), (9, a, 1), (None, a, 1), (7, [2 * x for x in a], 1), (8, a, 2), (11, a, None), (12, None, 1), (13, [], 1),
            (14, [0.0] * 4, 1), (15, [1.0, None, 3.0, -1.0], 1), (16, [1.0, math.nan, 3.0, -1.0], 1), (17, [1.0, math.inf, 3.0, -1.0], 1),
            (18, a[:3], 1), (19, [1e300 * x for x in b], 1), (20, [1e-300 * x for x in b], 1), (None, b, None), (3, b, 2), (4, b, 2)]
    check(spark, rows, tmp_path)
    assert pstable.digest(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_a_large_bucket_is_dealt_in_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(pstable, "BLOCK", 16)
    rng = np.random.default_rng(4)
    check(spark, list(zip(range(150), clustered(rng, 1, 140, 0.01) + clustered(rng, 10, 1, 1), [0] * 150)), tmp_path)


@pytest.mark.parametrize("cosine", [0.93, 0.95])
def test_recall_at_the_threshold(spark, cosine):
    """Pairs at exactly the given cosine, 4,000 of them among unrelated vectors of one label."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((4000, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y = (cosine + 1e-9) * x + math.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>, label int")
    linked = sum(r.n_links for r in pstable.digest(df).collect()) / 8000
    assert linked >= 0.997


def test_agreement_of_projections_follows_the_formula():
    rng = np.random.default_rng(6)
    for c in (0.3, 0.8, 1.4):
        x, b = rng.standard_normal(200_000) * c, rng.uniform(0, pstable.WIDTH, 200_000)
        assert abs((np.floor((x + b) / pstable.WIDTH) == 0).mean() - pstable.agreement(c)) < 0.005
