import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from brute import blanks, lower_ascii

from salesmart.llm import gru_lm
from salesmart.llm.common import BLANKS, mix, word_slices


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5


def tokens(text):
    return [*blanks(lower_ascii(text)), None]


def test_base_columns_against_plain_python(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(gru_lm, "KNOWN", 1100)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, " \t\n"), (None, "The É the"), (None, "The É the"), (-4, "unseen " * 4000 + "\x00 x")]
    docs.unionAll(spark.createDataFrame(odd, docs.schema)).coalesce(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows = docs.collect()
    count = Counter(t for r in rows if fold(r.doc_id) != 1 for t in tokens(r.text))
    total, kinds = sum(count.values()), len(count)
    got = gru_lm.digest(docs).collect()
    assert len(got) == len(rows)
    want = {r.doc_id: r.text for r in rows}
    for g in got:
        t = tokens(want[g.doc_id])
        assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (len(t), sum(count[x] > 0 for x in t), total, fold(g.doc_id) == 1)
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in t)
        assert abs(g.base_score - base) < 1e-6 * len(t)
    assert all(g.score < 0 for g in got)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    got = gru_lm.digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(g.score for g in got) > sum(g.base_score for g in got)


def test_class_factored_softmax_sums_to_one():
    model = gru_lm.Gru(3)
    h = np.random.default_rng(0).standard_normal((2, gru_lm.HIDDEN)).astype(np.float32)
    per = gru_lm.FREQUENT // gru_lm.CLASSES
    total = np.zeros(2)
    for k in range(gru_lm.CLASSES + gru_lm.RARE):
        for m in range(per if k < gru_lm.CLASSES else 1):
            total += np.exp(model.log_probs(h, np.full(2, k), np.full(2, m)))
    assert np.allclose(total, 1, atol=1e-3)


def test_gradients_match_differences():
    model = gru_lm.Gru(5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(1)
    x, head, member = rng.integers(0, 50, (5, 3)), rng.integers(0, 40, (5, 3)), rng.integers(0, 5, (5, 3))
    member[head >= gru_lm.CLASSES] = 0
    live = np.ones((5, 3), bool)

    def loss():
        h, out = np.zeros((3, gru_lm.HIDDEN)), 0.0
        for t in range(5):
            out -= model.log_probs(h, head[t], member[t]).sum()
            h = model.step(x[t], h)[4]
        return out / 15

    grads, _ = model.train_window(x, head, member, live, np.zeros((3, gru_lm.HIDDEN)))
    for name in ("x", "u", "b", "c", "o"):
        at = np.unravel_index(np.argmax(np.abs(grads[name])), grads[name].shape)
        keep = model.p[name][at]
        model.p[name][at] = keep + 1e-5
        up = loss()
        model.p[name][at] = keep - 1e-5
        down = loss()
        model.p[name][at] = keep
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4


def test_state_is_carried_across_windows(monkeypatch):
    model, text = gru_lm.Gru(2), "a b c d e f g " * 30
    _, _, w = next(word_slices(pa.array([text, "b", ""]), BLANKS))
    hashes, rare, first = gru_lm._tokens(w)
    code = gru_lm.Coder(np.unique(hashes)[:5])
    results = []
    for size in (4, 1000):
        monkeypatch.setattr(gru_lm, "WINDOW", size)
        results.append(gru_lm._log_text(model, *code(hashes, rare)[:3], first))
    assert np.allclose(*results, rtol=1e-5) and (results[0] < 0).all()


def test_empty_table(spark):
    assert gru_lm.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_model_beats_the_base_on_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = gru_lm.digest(docs).where("held_out").collect()
    assert sum(g.score for g in got) > sum(g.base_score for g in got) and gru_lm.HIDDEN == 24


def test_every_training_text_is_trained_on_once(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "SHARD_BYTES", 2000)
    texts = [f"w{i} common words here" for i in range(2000)]
    seen = []

    def replica(shared):
        def run(table):
            return pa.table({"i": pa.array([0], pa.int32()), "w": pa.array([float(zlib.crc32("|".join(sorted(table.column("t").to_pylist())).encode()))]),
                             "n": pa.array([table.num_rows], pa.int64())})
        return run

    monkeypatch.setattr(gru_lm, "_replica", replica)
    monkeypatch.setattr(gru_lm, "_unpack", lambda data, like: like)
    frame = spark.createDataFrame([(k, t, k * 37 % gru_lm.SLOTS) for k, t in enumerate(texts)], "row long, t string, slot int")
    kind = type(frame.groupBy("t"))
    apply = kind.applyInArrow

    def spy(self, f, schema):
        out = apply(self, f, schema)
        seen.extend(r.n for r in out.collect())
        return out

    monkeypatch.setattr(kind, "applyInArrow", spy)
    gru_lm.train(frame, np.zeros(0, np.uint64), gru_lm.Gru())
    assert sum(seen) == len(texts) and len(seen) > 20


def test_a_replica_steps_through_all_its_windows(monkeypatch):
    live = []
    step = gru_lm.Gru.train_window
    monkeypatch.setattr(gru_lm.Gru, "train_window", lambda self, x, head, member, on, h: (live.append(int(on.sum())), step(self, x, head, member, on, h))[1])
    texts = ["a b c " * 40 for _ in range(6000)]
    _, tokens = gru_lm._train_replica(gru_lm.Gru().p, np.zeros(0, np.uint64), texts)
    assert sum(live) == tokens == 6000 * 121 and len(live) > 120


def peak(run):
    run()  # what is kept for later calls is made here
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_a_window_works_in_memory_of_the_one_before():
    model, rng = gru_lm.Gru(1), np.random.default_rng(2)
    x = rng.integers(0, gru_lm.FREQUENT + gru_lm.RARE, (gru_lm.WINDOW, 128))
    head, member = np.where(x < gru_lm.FREQUENT, x % gru_lm.CLASSES, x - gru_lm.FREQUENT + gru_lm.CLASSES), np.where(x < gru_lm.FREQUENT, x // gru_lm.CLASSES, 0)
    h, live = np.zeros((128, gru_lm.HIDDEN), np.float32), np.ones(x.shape, bool)
    assert peak(lambda: model.train_window(x, head, member, live, h)) < 3 << 20


def test_a_very_frequent_class_does_not_widen_the_others():
    model, h = gru_lm.Gru(1), np.zeros((4096, gru_lm.HIDDEN), np.float32)
    head = np.where(np.arange(4096) < 4000, 5, np.arange(4096) % gru_lm.CLASSES)
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    assert peak(lambda: model.log_probs(h, head, head, grads)) < 4 << 20


def test_large_logits_stay_exact():
    model, rng = gru_lm.Gru(4), np.random.default_rng(3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.p["c"] *= 500
    model.p["ob"] -= 900
    h, head, member = rng.uniform(-1, 1, (300, gru_lm.HIDDEN)), rng.integers(0, gru_lm.CLASSES + gru_lm.RARE, 300), rng.integers(0, 32, 300)
    member[head >= gru_lm.CLASSES] = 0

    def log_softmax(a):
        a = a - a.max()
        return a - np.log(np.exp(a).sum())

    want = [log_softmax(s @ model.p["c"] + model.p["cb"])[k] + (log_softmax(s @ model.p["o"][k] + model.p["ob"][k])[m] if k < gru_lm.CLASSES else 0)
            for s, k, m in zip(h, head, member)]
    assert np.abs(h @ model.p["c"]).max() > 88
    assert np.allclose(model.log_probs(h, head, member), want)


def test_scores_do_not_depend_on_the_neighbours(monkeypatch):
    monkeypatch.setattr(gru_lm, "SCORE_LANES", 3)
    model, rng = gru_lm.Gru(6), np.random.default_rng(4)
    model.p["u"] *= 20
    length = np.concatenate([rng.integers(0, 90, 40), [700, 0, 1]])
    first = np.concatenate([[0], np.cumsum(length)])
    x = rng.integers(0, gru_lm.FREQUENT + gru_lm.RARE, first[-1])
    got = gru_lm._log_text(model, x, *gru_lm.outputs(x), first)
    alone = [gru_lm._log_text(model, x[a:b], *gru_lm.outputs(x[a:b]), np.array([0, b - a]))[0] for a, b in zip(first, first[1:])]
    h, plain = np.zeros((1, gru_lm.HIDDEN), np.float32), 0.0
    for t in x[first[40]:first[41]]:
        plain += model.log_probs(h, *gru_lm.outputs(np.array([t])))[0]
        h = model.step(np.array([t]), h)[4]
    assert np.allclose(got, alone, rtol=1e-5) and abs(got[40] / plain - 1) < 1e-5


def test_ranks_of_hashes_with_equal_first_bits():
    ranked = np.array([5, 1 << 63, 6, (1 << 63) + 1, 7, 2 ** 64 - 1, 0], np.uint64)
    code = gru_lm.Coder(ranked)
    wanted = np.concatenate([ranked, np.array([8, 4, 1 << 62, (1 << 63) + 2, 2 ** 64 - 2], np.uint64)])
    assert code.ranks(wanted).tolist() == [*range(7), *[-1] * 5]
    assert gru_lm.Coder(ranked[:0]).ranks(wanted).tolist() == [-1] * 12


def test_a_hash_ends_in_its_rare_class():
    texts = ["a b\x00 \u00e9t\u00e9 word Word", None, "", " \t", "sword \u0416"]
    _, _, w = next(word_slices(pa.array(texts), BLANKS))
    hashes, rare, first = gru_lm._tokens(w)
    assert first.tolist() == [0, 6, 7, 8, 9, 12]
    assert (hashes & np.uint64(gru_lm.RARE - 1)).tolist() == rare.tolist()
    assert hashes[3] == hashes[4] != hashes[9] and rare[3] == rare[9] and hashes[5] == gru_lm.END
    for i, word in enumerate(["a", "b\x01", "\u00e9t\u00e9", "word"]):
        b = word.encode()
        key = np.array([b[-1] * 257 + b[max(0, len(b) - 2)] * 65537 + (max(b) >= 0x80)], np.uint64)
        assert rare[i] == mix(key)[0] % np.uint64(gru_lm.RARE)
