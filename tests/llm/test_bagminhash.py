import numpy as np
import pytest
from brute import near_classes

from salesmart.llm import bagminhash


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    want = {r.doc_id: c for r, c in zip(rows, near_classes([r.text for r in rows]))}
    got = {r.doc_id: r.class_id for r in bagminhash.digest(docs).collect()}
    assert set(got) == set(want)
    ids = sorted(want)
    assert same_partition([want[i] for i in ids], [got[i] for i in ids])


def edited(words, at):
    return " ".join(w if i != at else "changed" for i, w in enumerate(words))


def test_edges_ties_and_clashing_columns(spark, tmp_path):
    base = [f"w{i}" for i in range(60)]
    texts = ([" ".join(base)] * 3 + [edited(base, k) for k in (0, 20, 40, 59)] + ["one two", "One, two!", "one three", None, "", "...",
             "...", "x " * 40, "x " * 45, "x " * 90, " ".join(base[:30])])
    ids = [None, 5, 5, 9, 8, 7, 6, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, Rid int")
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    found, _ = bagminhash.classes(docs)
    rows = bagminhash.numbered(docs.withColumnRenamed("Rid", "k")).collect()
    of = {r.rid: r["class"] for r in found.collect()}
    got = {r.k: of[r.rid] for r in rows}
    want = near_classes(texts)
    assert same_partition(want, [got[k] for k in range(len(texts))])
    kept = bagminhash.keep_one(docs).collect()
    assert len(kept) == len(set(want)) and kept[0].asDict().keys() == {"doc_id", "text", "Rid"}
    assert [r.doc_id for r in kept if r.text and r.text.startswith("w0 w1 ") and len(r.text) > 200] == [5]
    assert bagminhash.keep_one(docs.limit(0)).count() == 0


def test_many_near_copies_of_one_text_in_one_class(spark, tmp_path):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, edited(base, i)) for i in range(400)] + [(1000 + i, edited(edited(base, i).split(), 399 - i)) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    assert bagminhash.digest(spark.read.parquet(str(tmp_path / "d"))).select("class_id").distinct().count() == 1


def test_what_hubs_leave_open_is_compared_blockwise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", 3)
    core = [f"c{i}" for i in range(100)]
    texts = [" ".join(core + [f"{g}x{i}" for i in range(35)] + [f"{g}y{k}"]) for g in range(12) for k in range(3)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.class_id for r in bagminhash.digest(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert same_partition(near_classes(texts), [got[i] for i in range(len(texts))])


@pytest.mark.parametrize("weights", [(1, 1), (3, 2), (40, 25)])
def test_signature_agreement_estimates_weighted_jaccard(weights):
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(40):
        names = rng.integers(1, 1 << 50, 60).astype(np.uint64)
        a, b = np.sort(names[:45]), np.sort(names[10:])
        row = np.repeat([0, 1], [45, 50])
        ids = bagminhash.signatures(2, row, np.concatenate([a, b]), np.repeat(weights, [45, 50]))
        agree.append((ids[0] == ids[1]).mean())
    low, high = 35 * min(weights), 10 * weights[0] + 15 * weights[1] + 35 * max(weights)
    assert abs(np.mean(agree) - low / high) < 0.02
