import math

import numpy as np
import pytest

from salesmart.llm import hard_negatives as hn


def brute(rows):
    use = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        use.append((k, i, [math.floor(256 * x) for x in v], label))
    out = []
    for k, i, q, label in use:
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), math.inf if j is None else j, m, lab) for m, j, p, lab in use if m != k))
        for s, j, m, lab in [x for x in scored if x[3] == label][:5]:
            window = [x for x in scored if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, None if j == math.inf else j, r, None if x[1] == math.inf else x[1], -s, -x[0]) for r, x in enumerate(window, 1)]
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, score string, rank int").coalesce(1)
    got = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in hn.digest(df).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


@pytest.mark.parametrize("shape", [(1, 1, 1), (2, 3, 5), (17, 17, 17), (33, 64, 70), (100, 65, 31), (0, 4, 4), (4, 0, 4), (64, 64, 64)])
def test_strassen_is_exact(shape):
    n, k, m = shape
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2 ** 27, 2 ** 27, (n, k)), rng.integers(-2 ** 27, 2 ** 27, (k, m))
    for leaf in (1, 4, 16):
        assert (hn.strassen(a, b, leaf) == a @ b).all()


def random_rows(rng, n, d, labels):
    return [(int(i), (rng.standard_normal(d) / 4).round(2).tolist(), int(rng.integers(labels))) for i in rng.permutation(5 * n)[:n]]


def test_against_brute_force(spark):
    got = check(spark, random_rows(np.random.default_rng(2), 500, 12, 4))
    assert len(got) > 50 and {r[2] for r in got} == {1, 2, 3}


def test_blocks_strips_and_tiles_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "STRIP", 2)
    rng = np.random.default_rng(3)
    rows = random_rows(rng, 300, 6, 3) + [(50 * k, [0.5, 0.25, -0.25, 0.5, 0.0, 0.1], k % 3) for k in range(100, 112)]
    check(spark, rows)


def test_edges_ties_and_repeated_rows(spark):
    rows = [(50, [1.0, 0.5], 1), (50, [1.0, 0.5], 1), (100, [1.0, 0.5], 2), (None, [1.0, 0.5], 1), (3, [0.75, 0.5], 2), (4, [0.75, 0.5], 2),
            (5, [0.75, 0.5], 2), (None, [0.75, 0.5], 2), (7, [0.75, 0.25], 1), (8, None, 1), (9, [1.0, None], 1), (10, [1.0, math.nan], 2),
            (11, [math.inf, 1.0], 2), (150, [], 1), (12, [0.9], 2), (13, [0.9, 0.1, 5.0], 2), (14, [1.0, 1.0], None), (200, [-1.0, -2.0], 3), (250, None, 1)]
    check(spark, rows)
    empty = "vec_id long, embedding array<float>, label int"
    assert hn.digest(spark.createDataFrame([], empty)).count() == 0
    assert hn.digest(spark.createDataFrame([(1, [1.0], 1)], empty)).count() == 0


def test_components_too_large_for_exact_scores_are_refused(spark):
    df = spark.createDataFrame([(50, [1e6], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="may not fit"):
        hn.digest(df).count()
