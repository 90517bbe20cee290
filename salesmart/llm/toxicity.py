"""Operator 3, toxicity by class-conditional Kneser-Ney models.

Two interpolated models, one per class, over lower-cased words of letters and digits.  Counts are
numbers of distinct training texts that hold an expression, so copies of a text and its
repetitions count once.  An absolute discount ``DISCOUNT`` takes rare expressions out of both
classes and hands their mass to shared backoff counts, so that an expression which neither class
has often enough scores alike in both.  With n_c the counts of class c, H_c their sum after the
discount, b the share of the mass that the discount takes from the pooled counts, and P(x) the pooled
continuation counts (in how many distinct contexts, preceding words or the start of a text, x occurs, as a
share of all such pairs of a context and an x):

    P_c(x)     = (1 - b) * max(n_c(x) - D, 0) / H_c + b * P(x)
    P_c(w | u) = (1 - b(u)) * max(n_c(u w) - D, 0) / H_c(u) + b(u) * P_c(w)

A pair is used where both classes keep it after the discount.  Where one keeps none, its first term would be 0 for
lack of texts more than for lack of the pair (toxic texts are a tenth of the others), so the pair backs off to its word.
x is the word, or if neither class keeps it after the discount its first six characters, else its
first four (one table per length): inflected and compounded words back off to their stems.  A
word of which nothing is kept has ratio 1.  As counts are of texts that hold a word, only a
word's first place in a text counts.  The log-likelihood ratio per distinct word is taken over the
whole text, and per word over its two most suspicious disjoint stretches of ``STRETCH`` words; a
logistic fit on a fold of labelled rows that the counts have not seen turns these length-normalised
ratios into a score.

Learning uses labelled rows whose crc32(doc_id as text) mod 5 is not 0: folds 2-4 for counts, fold
1 for calibration, at most ``MAX_LABELLED`` rows in the order of a hash of their id, which bounds
the broadcast model.  Labels, language, source and ids are no input of a score.

Edge cases: null is an empty text; texts without words have ratio 0 and the score of the calibrated
intercept.  Repeated and contradicting labels of an id count as the largest.  Without labels of
both classes every score is 0.  Rows repeat as they come; added columns that clash with input
columns get a trailing underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import LETTERS, Words, fold_of, free_name, lookup, mix, stage, word_slices

#: Documented bound of the labelled sample.
MAX_LABELLED = 20000
DISCOUNT = 3.0
STRETCH = 2
STEMS = (6, 4)
HELD_OUT_FOLD, CALIBRATION_FOLD = 0, 1

_U = np.uint64
#: The context of a text's first word; hashes of words as contexts are odd as well, and equal it with probability 2^-63.
START = _U(1)


def _pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(index of the second word, hash of the two words, the first as a context) of neighbours in a text."""
    second = np.flatnonzero(w.row[1:] == w.row[:-1]) + 1 if len(w.row) else np.zeros(0, np.int64)
    return second, mix((w.hash[second - 1] | _U(1)) * _U(0x9E3779B97F4A7C15) + w.hash[second])


def _stems(w: Words) -> list[np.ndarray]:
    """Hashes of each word's first characters, one array per length of ``STEMS``."""
    lead = (w.raw & 0xC0) != 0x80
    place = np.flatnonzero(lead)
    before = np.concatenate([[0], np.cumsum(lead)])[w.start]
    starts = np.concatenate([place, [len(w.raw)]])
    out = []
    for n in STEMS:
        end = np.minimum(starts[np.minimum(before + n, len(place))], w.end)
        out.append(mix(w.range_hash(w.start, end) + _U(n)))
    return out


def _expressions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) -> distinct (previous word, word, stems of the word, toxic) of each text.

    Previous word 0 stands for a single word, and ``START`` for the start of the text; only single words carry stems.
    """
    for batch in batches:
        label = np.asarray(batch.column(1))
        for at, _, w in word_slices(batch.column(0), LETTERS):
            second, _ = _pairs(w)
            lead = w.first[:-1][w.per_row > 0]
            place = np.concatenate([np.arange(len(w.hash)), second, lead])
            rows = w.row[place].astype(np.uint64)
            u = np.concatenate([np.zeros(len(w.hash), np.uint64), w.hash[second - 1] | _U(1), np.full(len(lead), START, np.uint64)])
            v = w.hash[place]
            none = np.zeros(len(second) + len(lead), np.uint64)
            _, first = np.unique(mix(mix(u * _U(0xD6E8FEB86659FD93) + v) + rows), return_index=True)
            stems = [np.concatenate([x, none])[first] for x in _stems(w)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (u[first], v[first], *stems)]
                + [pa.array(label[at + rows[first].astype(np.int64)].astype(np.int32))], names=["u", "v", "s0", "s1", "toxic"])


class Model:
    """Sorted expression hashes with their class probabilities, and the calibration."""

    def __init__(self) -> None:
        #: Words, then stems by length: (hashes, probabilities per class).
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts, self.context_back = np.zeros(0, np.uint64), np.zeros(0)
        self.pairs, self.pair_prob = np.zeros(0, np.uint64), np.zeros((0, 2))
        self.weights: np.ndarray | None = None

    @classmethod
    def of(cls, values: dict) -> Model:
        """The model of broadcast plain values."""
        model = cls()
        vars(model).update(values)
        return model

    def ratios(self, w: Words) -> np.ndarray:
        """log P_toxic(word | previous) - log P_ordinary(word | previous) of every word of the slice."""
        prob = np.ones((len(w.hash), 2))
        open_ = np.arange(len(w.hash))
        for unit, (keys, kept) in zip([w.hash, *_stems(w)], self.levels):
            at = lookup(keys, unit[open_])
            prob[open_[at >= 0]] = kept[at[at >= 0]]
            open_ = open_[at < 0]
        second, pair = _pairs(w)
        context = lookup(self.contexts, w.hash[second - 1] | _U(1))
        known = np.flatnonzero(context >= 0)
        found = lookup(self.pairs, pair[known])
        known, found = known[found >= 0], found[found >= 0]
        where, back = second[known], self.context_back[context[known]][:, None]
        prob[where] = (1 - back) * self.pair_prob[found] + back * prob[where]
        return np.log(prob[:, 1] / prob[:, 0])

    def features(self, w: Words) -> np.ndarray:
        """Per text: mean ratio of its distinct words, and the two best mean ratios of disjoint stretches."""
        _, first = np.unique(mix(w.hash + w.row.astype(np.uint64)), return_index=True)
        ratio = np.zeros(len(w.hash))
        ratio[first] = self.ratios(w)[first]
        out = np.zeros((w.rows, 3))
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        n = np.bincount(w.row[first], minlength=w.rows)
        out[:, 0] = (sums[w.first[1:]] - sums[w.first[:-1]]) / np.maximum(n, 1)
        if len(ratio):
            end = np.minimum(np.arange(len(ratio)) + STRETCH, w.first[w.row + 1])
            stretch = (sums[end] - sums[:-1]) / STRETCH
            has = np.flatnonzero(n > 0)
            best = np.full(w.rows, -np.inf)
            best[has] = np.maximum.reduceat(stretch, w.first[has])
            top = stretch == best[w.row]
            place = np.full(w.rows, -1)
            place[w.row[top][::-1]] = np.flatnonzero(top)[::-1]
            apart = np.abs(np.arange(len(ratio)) - place[w.row]) >= STRETCH
            second = np.maximum.reduceat(np.where(apart, stretch, 0.0), w.first[has])
            out[has, 1], out[has, 2] = np.maximum(best[has], 0), np.maximum(second, 0)
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(features))
        z = self.weights[0] + features @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept first) of a ridge-penalised logistic fit by Newton steps."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    full = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(full.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + penalty, full.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:1], w[1:] / scale])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold; counting runs as Spark jobs."""
    label = (labels.select(F.col(doc_id).alias("d"), F.col("toxic").alias("y"), fold_of(doc_id).alias("fold"))
             .where("d is not null and y in (0, 1)").where(F.col("fold") != HELD_OUT_FOLD)
             .groupBy("d", "fold").agg(F.max("y").alias("y")))
    # Above the bound, a hash threshold keeps a little fewer rows, so that chance does not pass it either.
    labelled = label.count()
    if labelled > MAX_LABELLED:
        share = (MAX_LABELLED - 4 * MAX_LABELLED ** 0.5) / labelled
        label = label.where(F.pmod(F.xxhash64("d"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = docs.select(F.col(doc_id).alias("d"), F.lower(text).alias("t")).join(F.broadcast(label), "d")
    fit = (sample.where(F.col("fold") != CALIBRATION_FOLD).groupBy(F.xxhash64("t").alias("key"))
           .agg(F.first("t").alias("t"), F.max("y").cast("int").alias("y")).select("t", "y"))
    counts = (fit.mapInArrow(_expressions, "u long, v long, s0 long, s1 long, toxic int").groupBy("u", "v", "s0", "s1")
              .agg(F.sum(1 - F.col("toxic")).alias("n0"), F.sum("toxic").alias("n1")))
    counts = stage(counts, "toxicity-counts")
    model = Model()
    single, double = counts.where("u = 0"), counts.where(~F.col("u").isin(0, int(START)))
    for unit in ("v", "s0", "s1"):
        table = single.groupBy(F.col(unit).alias("x")).agg(*(F.sum(c).alias(c) for c in ("n0", "n1")))
        level = _level(table, stage(continuations(counts, unit), "toxicity-contexts"))
        if level is None:
            return Model()
        model.levels.append(level)
    kept0, kept1 = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) for c in ("n0", "n1"))
    context = (double.groupBy("u").agg(F.sum(kept0).alias("h0"), F.sum(kept1).alias("h1"),
                                       F.sum(F.greatest(F.col("n0") + F.col("n1") - DISCOUNT, F.lit(0.0))).alias("h"),
                                       F.sum(F.col("n0") + F.col("n1")).alias("n")).where("h0 > 0 and h1 > 0"))
    rows = context.toArrow()
    u = rows.column("u").to_numpy().view(np.uint64)
    order = np.argsort(u)
    model.contexts = u[order]
    model.context_back = (1 - rows.column("h").to_numpy() / rows.column("n").to_numpy())[order]
    rows = double.where(F.least("n0", "n1") > DISCOUNT).join(context.select("u", "h0", "h1"), "u") \
        .select("u", "v", (kept0 / F.col("h0")).alias("p0"), (kept1 / F.col("h1")).alias("p1")).toArrow()
    pu, pv = (rows.column(c).to_numpy().view(np.uint64) for c in ("u", "v"))
    key = mix(pu * _U(0x9E3779B97F4A7C15) + pv)
    order = np.argsort(key)
    model.pairs = key[order]
    model.pair_prob = np.column_stack([rows.column(c).to_numpy() for c in ("p0", "p1")])[order]
    _calibrate(model, sample.where(F.col("fold") == CALIBRATION_FOLD).select("t", F.col("y").cast("int").alias("y")))
    return model


def continuations(counts: DataFrame, unit: str) -> DataFrame:
    """(x, contexts): in how many distinct contexts of ``counts(u, v, s0, s1)`` each word or stem occurs.

    Pairs are distinct already; for stems they meet the stems of the sample's words, whose number is bounded.
    """
    pairs = counts.where("u <> 0").select("u", "v")
    if unit != "v":
        words = counts.where("u = 0").select("v", unit).distinct()
        pairs = pairs.join(F.broadcast(words), "v").select("u", unit).distinct()
    return pairs.groupBy(F.col(unit).alias("x")).agg(F.count("*").alias("contexts"))


def _level(table: DataFrame, contexts: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Kept expressions of (x, n0, n1) and their probabilities per class, backed off to the shares of
    (x, contexts); None if a class keeps nothing."""
    pooled = F.col("n0") + F.col("n1")
    total = table.agg(*(F.sum(F.greatest(c - DISCOUNT, F.lit(0.0))) for c in (F.col("n0"), F.col("n1"), pooled)),
                      F.sum(pooled)).first()
    if not total[0] or not total[1]:
        return None
    back = 1 - total[2] / total[3]
    contexts = contexts.withColumnRenamed("x", "y")
    pairs = contexts.agg(F.sum("contexts")).first()[0]
    kept = (table.where(F.greatest("n0", "n1") > DISCOUNT).join(contexts, F.col("x") == F.col("y"))
            .select("x", "n0", "n1", "contexts").toArrow())
    x, n0, n1, contexts_of = (kept.column(c).to_numpy() for c in ("x", "n0", "n1", "contexts"))
    held = np.maximum(np.column_stack([n0, n1]) - DISCOUNT, 0) / np.array(total[:2], float)
    prob = (1 - back) * held + (back * contexts_of / pairs)[:, None]
    order = np.argsort(x.view(np.uint64))
    return x.view(np.uint64)[order], prob[order]


def _calibrate(model: Model, rows: DataFrame) -> None:
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model.of(shared.value)
        for batch in batches:
            for at, end, w in word_slices(batch.column(0), LETTERS):
                f = fitted.features(w)
                yield pa.RecordBatch.from_arrays([*(pa.array(f[:, j]) for j in range(3)), batch.column(1).slice(at, end - at)],
                                                 names=["a", "b", "c", "y"])

    got = rows.mapInArrow(run, "a double, b double, c double, y int").toArrow()
    x = np.column_stack([got.column(c).to_numpy() for c in ("a", "b", "c")])
    y = got.column("y").to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        model.weights = _logistic(x, y)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> tuple[DataFrame, str]:
    """``docs`` plus the score, and the score's actual column name."""
    name = free_name(docs.columns, name)
    lowered = free_name(docs.columns, "_lowered")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model.of(shared.value)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at, end, w in word_slices(batch.column(width), LETTERS):
                out[at:end] = fitted.scores(fitted.features(w))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(out)], names=schema.names)

    return docs.withColumn(lowered, F.lower(text)).mapInArrow(run, schema), name


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below a half, unchanged."""
    scored, name = score(docs, model, text)
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of the query."""
    scored, name = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (fold_of() == HELD_OUT_FOLD).alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= 0.5).cast("int").alias("predicted"))
