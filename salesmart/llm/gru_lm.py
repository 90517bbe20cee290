"""Operator 4, language-model scoring with a gated recurrent network in numpy.

Counts.  Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, and one end per text.  A Spark
job counts every token of all training texts (crc32(doc_id as text) mod 5 is not 1), keyed by a 64-bit
hash, which ends in the word's rare class.

Model.  The ``FREQUENT`` most frequent tokens have embeddings; every other word is read as one of
``RARE`` classes by its last bytes.  A GRU reads the text; the output softmax is factored into classes:
P(class | state), then P(token | class, state) for frequent tokens, and for a word of a rare class its
smoothed corpus count (c + 0.5) / (N_class + 0.5 (V_class + 1)).  So every word has a probability, and the
model's log10 probability of a text is a sum over all its tokens.

Training is truncated backpropagation, one pass over all training texts.  Rounds, whose number grows with
the logarithm of the corpus, take disjoint parts of the texts: ranges of ``slot``, a hash of the row by which the staged
files are sorted, so that a round reads the pages of its own rows.  A round deals its part into
shards of about ``SHARD_BYTES``, which cut it, in the order of the rows, into windows of ``WINDOW`` tokens whose state is
carried on.  A replica per shard runs one step of Adam per window until its texts end, and the replicas' weights are
averaged after each round, by their numbers of tokens.

Scoring deals texts to lanes that run side by side, carries each text's state over all its windows, and takes the
probabilities of words outside the broadcast tables (``FREQUENT`` embeddings, ``KNOWN`` counts) from a
join of distinct (text, word) pairs with the counts, summed per text.  All later reads of the texts and
their row numbers come from one staged copy.

Edge cases: null is an empty text, which is one end token.  Without training texts counts are 0 and
the untrained model, which starts as a unigram model, scores.  Rows are told apart by row number, so repeated
and null ids are fine.  A very long text is a slice of its own, scored as a whole with its state carried on.
An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import BLANKS, Words, fold_of, mix, row_sums, stage, word_slices

HELD_OUT_FOLD = 1
FREQUENT, CLASSES, RARE = 1024, 32, 32
#: Most words whose counts are broadcast, and steps of a doubling in which their least count is found.
KNOWN, STEPS = 65536, 16
HIDDEN, WINDOW = 24, 32
#: Token streams side by side: the least, the most, and windows that a replica should at least have.
LANES, MOST_LANES, DEPTH = 32, 128, 128
#: Tokens that a task scores side by side, on at most so many lanes; a long text fills a lane while short ones share the others.
SCORE_TOKENS, SCORE_LANES = 1 << 21, 256
#: Bytes of text cut into words, states whose class probabilities are taken and weights stepped at once: what a core's cache holds.
WORD_BYTES, ROWS, PIECE = 1 << 18, 1 << 10, 1 << 14
SHARD_BYTES, LEAST_ROUNDS = 4 << 20, 3
SLOTS = 256
RATE = 0.01

_U = np.uint64
#: Hash of the end token; no word of one slice hashes to it but with probability 2^-64.
END = np.uint64(0x5EED0FE4DD0C5EE0)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _class_table() -> np.ndarray:
    """Rare class by whether a word has bytes beyond ASCII, its last byte but one and its last byte."""
    wide, before, last = np.ogrid[:2, :256, :256]
    hashed = last.astype(_U) * _U(257) + before.astype(_U) * _U(65537) + wide.astype(_U)
    return (mix(hashed) % _U(RARE)).astype(np.uint8).ravel()


_CLASSES = _class_table()


def _rare_class(w: Words) -> np.ndarray:
    """Class of each word by its last two bytes and whether it has bytes beyond ASCII."""
    last = w.norm.take(w.end - 1).astype(np.int32)
    before = w.norm.take(np.maximum(w.end - 2, w.start)).astype(np.int32)
    before <<= 8
    before += last
    if len(w.start) and w.norm.max() >= 0x80:  # the separators up to the next word are 0
        before += (np.maximum.reduceat(w.norm, w.start) >= 0x80).astype(np.int32) << 16
    return _CLASSES.take(before).astype(np.int64)


def _tokens(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, rare class, first) of the slice's tokens, with an end after each text; the hash ends in the class."""
    first = w.first + np.arange(w.rows + 1)
    hashes = np.full(int(first[-1]), END, np.uint64)
    rare = np.zeros(int(first[-1]), np.int64)
    place = np.arange(len(w.hash)) + w.row
    kind = _rare_class(w)
    hashes[place], rare[place] = (w.hash & ~_U(RARE - 1)) | kind.view(np.uint64), kind
    return hashes, rare, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [_tokens(w)[0] for _, _, w in word_slices(batch.column(0), BLANKS, WORD_BYTES)]
        if parts:
            hashes = np.sort(np.concatenate(parts))
            begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            yield pa.RecordBatch.from_arrays([_signed(hashes[begin]), pa.array(np.diff(begin, append=len(hashes)))], names=["h", "c"])


class Gru:
    """Embeddings, one gated recurrent layer, class-factored softmax; float32."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        inputs, heads, per = FREQUENT + RARE, CLASSES + RARE, FREQUENT // CLASSES

        def weights(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        self.p = {"x": weights(inputs, 3 * HIDDEN), "u": weights(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32),
                  "c": weights(HIDDEN, heads), "cb": np.zeros(heads, np.float32),
                  "o": weights(CLASSES, HIDDEN, per), "ob": np.zeros((CLASSES, per), np.float32)}
        self.rooms: dict[str, np.ndarray] = {}

    def start_from(self, counts: np.ndarray, rare_mass: np.ndarray) -> Gru:
        """Output biases from corpus counts (frequent tokens by rank, rare classes): untrained, the model is a unigram model."""
        per = FREQUENT // CLASSES
        table = np.full(FREQUENT, 0.5)
        table[:len(counts)] += counts
        table = table.reshape(per, CLASSES).T
        self.p["ob"] = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
        heads = np.concatenate([table.sum(axis=1), rare_mass + 0.5])
        self.p["cb"] = np.log(heads / heads.sum()).astype(np.float32)
        return self

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array in memory kept under ``name``: arrays made anew for each window would cost a third of its time in page faults."""
        size, kind = math.prod(shape), self.p["x"].dtype
        if name not in self.rooms or self.rooms[name].size < size or self.rooms[name].dtype != kind:
            self.rooms[name] = np.empty(size, kind)
        return self.rooms[name][:size].reshape(shape)

    def views(self, flat: np.ndarray) -> dict:
        """One vector as arrays by name, shaped like the weights."""
        out, at = {}, 0
        for k in sorted(self.p):
            out[k] = flat[at:at + self.p[k].size].reshape(self.p[k].shape)
            at += self.p[k].size
        return out

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Input sums, a row for each gate of an input, and state weights by gate: negated for z and q, whose sigmoids take exp(-a)."""
        u = np.ascontiguousarray(self.p["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))
        np.negative(u[:2], out=u[:2])
        return np.add(self.p["x"], self.p["b"], out=self.room("sums", *self.p["x"].shape)).reshape(-1, HIDDEN), u

    def inputs(self, rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Input sums (time, gate, lane, unit) of the inputs ``x`` (time, lane)."""
        at = 3 * x[:, None, :] + np.arange(3)[:, None]
        return rows.take(at, axis=0, out=self.room("inputs", *at.shape, HIDDEN), mode="clip")

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        rows, u = self.sums()
        a, r, after = self.inputs(rows, x[None])[0].copy(), np.empty((3, *h.shape), u.dtype), np.empty_like(h)
        self.advance(a, u, h, r, after)
        return a[0], a[1], a[2], r[2], after

    def advance(self, a: np.ndarray, u: np.ndarray, h: np.ndarray, r: np.ndarray, after: np.ndarray) -> None:
        """The state after ``h``; the input sums ``a`` become z, q and n, and r[2] the state's part of n."""
        np.matmul(h, u, out=r)
        zq, n = a[:2], a[2]
        np.subtract(r[:2], zq, out=zq)
        np.exp(zq, out=zq)
        zq += 1
        np.reciprocal(zq, out=zq)
        n += np.multiply(a[1], r[2], out=r[0])
        np.tanh(n, out=n)
        np.subtract(h, n, out=after)
        after *= a[0]
        after += n

    def log_probs(self, h: np.ndarray, head: np.ndarray, member: np.ndarray, grads: dict | None = None, weight: float = 1.0) -> np.ndarray | tuple:
        """Natural log P(class) + log P(member | class); rare classes have no member part.

        With ``grads``, to which the gradients times ``weight`` are added: also dL/dh, valid until the next call.
        """
        wide = self.room("wide", len(h), HIDDEN + 1)  # a last unit of ones carries the biases
        wide[:, :HIDDEN] = h
        wide[:, HIDDEN] = 1
        c, back = np.concatenate([self.p["c"], self.p["cb"][None]]), np.ascontiguousarray(self.p["c"].T)
        out, dh = np.empty(len(h), h.dtype), self.room("dh", *h.shape)
        for at in range(0, len(h), ROWS):
            some = wide[at:at + ROWS]
            cut = slice(at, at + len(some))
            e = np.matmul(some, c, out=self.room("heads", len(some), c.shape[1]))
            out[cut], total, chosen = _softmax(e, head[cut])
            if grads is not None:
                scale = _logit_gradients(e, total, chosen, weight)
                g = (some * scale).T @ e
                grads["c"] += g[:HIDDEN]
                grads["cb"] += g[HIDDEN]
                np.matmul(e, back, out=dh[cut])
                dh[cut] *= scale
        # The members in the order of their classes: the products are taken class by class, all else for all rows at once.
        sizes = np.bincount(head, minlength=CLASSES)[:CLASSES]
        ends = np.cumsum(sizes)
        at = np.argsort(head.astype(np.uint16), kind="stable")[:ends[-1]]
        cuts = [(k, slice(ends[k] - sizes[k], ends[k])) for k in np.flatnonzero(sizes)]
        states = wide.take(at, axis=0, out=self.room("states of members", len(at), HIDDEN + 1), mode="clip")
        o = np.concatenate([self.p["o"], self.p["ob"][:, None]], axis=1)
        e = self.room("members", len(at), o.shape[2])
        for k, cut in cuts:
            np.matmul(states[cut], o[k], out=e[cut])
        inner, total, chosen = _softmax(e, member[at])
        out[at] += inner
        if grads is None:
            return out
        scale = _logit_gradients(e, total, chosen, weight)
        states *= scale
        d, back = self.room("back", len(at), HIDDEN), np.ascontiguousarray(self.p["o"].transpose(0, 2, 1))
        g = self.room("members' gradients", *o.shape)
        g[sizes == 0] = 0
        for k, cut in cuts:
            np.matmul(states[cut].T, e[cut], out=g[k])
            np.matmul(e[cut], back[k], out=d[cut])
        grads["o"] += g[:, :HIDDEN]
        grads["ob"] += g[:, HIDDEN]
        d *= scale
        dh[at] += d
        return out, dh

    def train_window(self, x: np.ndarray, head: np.ndarray, member: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean loss of one window (time, lanes), backpropagated to its start, views of the room "gradients"; the state after it."""
        g = self.room("gradients", sum(v.size for v in self.p.values()))
        g[:] = 0
        g = self.views(g)
        (times, lanes), (rows, u) = x.shape, self.sums()
        a, r = self.inputs(rows, x), self.room("r", 3, lanes, HIDDEN)
        rn, states = self.room("rn", times, lanes, HIDDEN), self.room("states", times + 1, lanes, HIDDEN)
        states[0] = h
        for t in range(times):
            self.advance(a[t], u, states[t], r, states[t + 1])
            rn[t] = r[2]
        # State before token t predicts token t.
        flat = states[:-1].reshape(-1, HIDDEN)
        where = np.flatnonzero(live.ravel())
        if len(where) == len(flat):
            dout = self.log_probs(flat, head.ravel(), member.ravel(), g, 1 / len(where))[1]
        else:
            dout = np.zeros_like(flat)
            dout[where] = self.log_probs(flat[where], head.ravel()[where], member.ravel()[where], g, 1 / max(1, len(where)))[1]
        dout = dout.reshape(times, lanes, HIDDEN)
        # Local derivatives: only what depends on the carried gradient is left to the loop.
        z, q, n = a[:, 0], a[:, 1], a[:, 2]
        local, by_n, some = self.room("local", times, lanes, 3, HIDDEN), self.room("by n", *z.shape), self.room("some", *z.shape)
        np.subtract(states[:-1], n, out=some)
        some *= z
        np.subtract(1, z, out=by_n)
        np.multiply(some, by_n, out=local[:, :, 0])
        n *= n
        np.subtract(1, n, out=n)
        by_n *= n
        rn *= by_n
        rn *= q
        np.multiply(by_n, q, out=local[:, :, 2])
        np.subtract(1, q, out=q)
        np.multiply(rn, q, out=local[:, :, 1])
        back = np.ascontiguousarray(self.p["u"].T)
        carry, by_u = np.zeros_like(h), np.empty_like(h)
        for t in range(times - 1, -1, -1):
            local[t] *= carry[:, None, :]
            by_n[t] *= carry
            carry *= z[t]
            carry += np.matmul(local[t].reshape(lanes, -1), back, out=by_u)
            carry += dout[t]
        sums = local.reshape(len(flat), -1)
        g["u"] += flat.T @ sums
        local[:, :, 2] = by_n
        x = x.ravel()
        order = np.argsort(x.astype(np.uint16), kind="stable")
        keys = x[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        by_input = np.add.reduceat(sums.take(order, axis=0, out=self.room("sorted", *sums.shape), mode="clip"), begin)
        g["x"][keys[begin]] = by_input
        g["b"] += by_input.sum(axis=0)
        return g, states[-1].copy()


def _softmax(logits: np.ndarray, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities of the choices, sums of the rows' exponentials, flat places of the choices; ``logits`` become exponentials."""
    chosen = np.arange(len(logits)) * logits.shape[1] + choice
    if max(logits.max(initial=0), -logits.min(initial=0)) > 60:  # below, no exponential and no sum leaves the range of float32
        logits -= logits.max(axis=1, keepdims=True)
    out = logits.take(chosen)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    out -= np.log(total)
    return out, total, chosen


def _logit_gradients(e: np.ndarray, total: np.ndarray, chosen: np.ndarray, weight: float) -> np.ndarray:
    """Makes the exponentials the gradients of the logits but for a scale of each row, which it returns."""
    e.reshape(-1)[chosen] -= total
    return (weight / total).astype(e.dtype)[:, None]


class Coder:
    """Token hashes -> rank among the given ones, input row, output class and member of a class."""

    def __init__(self, ranked: np.ndarray):
        self.rank = np.argsort(ranked, kind="stable")
        self.keys = ranked[self.rank]
        # Keys by their first bits: about four places for a key, so most hashes meet one key or none.
        self.shift = _U(64 - max(1, (4 * len(ranked)).bit_length()))
        self.begin = np.searchsorted(self.keys, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift)
        self.begin = np.append(self.begin, len(ranked))

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each hash, -1 for others."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        out = np.full(len(hashes), -1, np.int64)
        bucket = (hashes >> self.shift).view(np.int64)
        at, end, left = self.begin.take(bucket), self.begin.take(bucket + 1), np.arange(len(hashes))
        while True:
            more = np.flatnonzero(at < end)
            if not len(more):
                return out
            at, end, left = at[more], end[more], left[more]
            hit = self.keys.take(at) == hashes.take(left)
            out[left[hit]] = self.rank.take(at[hit])
            at += 1
            at[hit] = end[hit]

    def inputs(self, hashes: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(input, rank) of the tokens."""
        rank = self.ranks(hashes)
        return np.where((rank >= 0) & (rank < FREQUENT), rank, FREQUENT + rare).astype(np.int16), rank

    def __call__(self, hashes: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(input, class, member, rank); frequent tokens are dealt to the classes in turn, by rank."""
        x, rank = self.inputs(hashes, rare)
        return x, *outputs(x), rank


def outputs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and member of the inputs ``x``."""
    return np.where(x < FREQUENT, x % CLASSES, x + (CLASSES - FREQUENT)), np.where(x < FREQUENT, x // CLASSES, 0)


def _train_replica(weights: dict, frequent: np.ndarray, texts: list[str]) -> tuple[dict, int]:
    """Adam over all windows of the texts dealt to lanes, the state carried from window to window; and the tokens trained on."""
    model, code = Gru(), Coder(frequent)
    model.p = {k: v.copy() for k, v in weights.items()}
    parts: list[np.ndarray] = []
    for _, _, w in word_slices(pa.array(texts, pa.large_string()), BLANKS, WORD_BYTES):
        hashes, rare, first = _tokens(w)
        parts += np.split(code.inputs(hashes, rare)[0], first[1:-1])
    tokens = sum(len(p) for p in parts)
    lanes = min(MOST_LANES, max(LANES, tokens // (WINDOW * DEPTH)))
    streams: list[list[np.ndarray]] = [[] for _ in range(lanes)]
    sizes = np.zeros(lanes, np.int64)
    for part in parts:
        lane = int(sizes.argmin())
        streams[lane].append(part)
        sizes[lane] += len(part)
    longest = np.argsort(-sizes, kind="stable")  # lanes that end early are the last ones and drop out
    streams, sizes = [streams[k] for k in longest], sizes[longest]
    width = max(WINDOW, int(np.ceil(sizes.max() / WINDOW)) * WINDOW)
    grid = np.zeros((width, lanes), np.int16)
    for k, stream in enumerate(streams):
        if stream:
            grid[:sizes[k], k] = np.concatenate(stream)
    # All weights in one vector, of which the model's arrays are views: Adam steps in place.
    flat = np.concatenate([model.p[k].ravel() for k in sorted(model.p)])
    model.p = model.views(flat)
    first_moment, second_moment, scale = (np.zeros_like(flat) for _ in range(3))
    h = np.zeros((lanes, HIDDEN), np.float32)
    for n in range(1, width // WINDOW + 1):
        begin = (n - 1) * WINDOW
        on = max(1, int(np.searchsorted(-sizes, -begin, side="left")))
        x = grid[begin:begin + WINDOW, :on]
        _, h = model.train_window(x, *outputs(x), np.arange(begin, begin + WINDOW)[:, None] < sizes[:on], h[:on])
        g = model.room("gradients", len(flat))
        for at in range(0, len(flat), PIECE):
            some = slice(at, at + PIECE)
            m, v, by, to = first_moment[some], second_moment[some], g[some], scale[some]
            m *= 0.9  # of all gradients: 10 times their decaying mean
            m += by
            v *= 0.99  # of all squares: 100 times
            v += np.multiply(by, by, out=by)
            np.sqrt(v, out=to)
            to *= np.float32(0.1 / np.sqrt(1 - 0.99 ** n))
            to += np.float32(1e-8)
            np.divide(m, to, out=to)
            to *= np.float32(0.1 * RATE / (1 - 0.9 ** n))
            flat[some] -= to
    return model.p, tokens


def _pack(weights: dict) -> bytes:
    return b"".join(np.ascontiguousarray(weights[k], np.float32).tobytes() for k in sorted(weights))


def _unpack(data: bytes, like: dict) -> dict:
    flat, out, at = np.frombuffer(data, np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def train(texts: DataFrame, frequent: np.ndarray, start: Gru) -> dict:
    """Weights after one pass over ``texts(row, t, slot)`` in rounds of replicated training and averaging.

    Shards hold about ``SHARD_BYTES`` of text, so their number grows with the corpus and none outgrows a
    task; Spark averages the replicas' weights, and one set of weights reaches the driver.
    """
    spark = texts.sparkSession
    weights = start.p
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    rounds = LEAST_ROUNDS + int(np.log2(1 + size / SHARD_BYTES))
    shards = max(1, round(size / rounds / SHARD_BYTES))
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(shards)))
    edges = [turn * SLOTS // rounds for turn in range(rounds + 1)]
    for turn in range(rounds if size else 0):
        mine = (F.col("slot") >= edges[turn]) & (F.col("slot") < edges[turn + 1])
        rows = (dealt.where(mine).select("shard", "row", "t").groupBy("shard")
                .applyInArrow(_replica(spark.sparkContext.broadcast((_pack(weights), frequent))), "i int, w double, n long")
                .groupBy("i").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).toArrow())
        if rows.num_rows:
            flat = np.zeros(rows.num_rows, np.float32)
            flat[rows.column("i").to_numpy()] = rows.column("w").to_numpy()
            weights = _unpack(flat.tobytes(), weights)
    return weights


def _replica(shared):
    def run(table: pa.Table) -> pa.Table:
        data, common = shared.value
        got, tokens = _train_replica(_unpack(data, Gru().p), common, table.sort_by("row").column("t").to_pylist())
        flat = np.frombuffer(_pack(got), np.float32).astype(np.float64)
        return pa.table({"i": pa.array(np.arange(len(flat), dtype=np.int32)), "w": pa.array(flat),
                         "n": pa.array(np.full(len(flat), tokens, np.int64))})

    return run


def _lanes(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lane, place in it) of texts of these lengths, and the lanes' sizes, largest first; the longest text first, each into the emptiest lane."""
    n = int(min(SCORE_LANES, max(1, len(length)), length.sum() // max(1, length.max(initial=0)) + 2))
    lane, place, heap = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), [(0, k) for k in range(n)]
    for i in np.argsort(-length, kind="stable").tolist():
        place[i], lane[i] = heap[0]
        heapq.heapreplace(heap, (int(place[i] + length[i]), int(lane[i])))
    sizes = np.zeros(n, np.int64)
    for size, k in heap:
        sizes[k] = size
    order = np.argsort(-sizes, kind="stable")
    return np.argsort(order)[lane], place, sizes[order]


def _log_text(model: Gru, x: np.ndarray, head: np.ndarray, member: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural-log probability per text of its frequent tokens and of its rare words' classes, all texts side by side.

    A lane takes one text after another; its state is carried until the text ends and starts at 0 for the next one.
    """
    length = np.diff(first)
    lane, place, sizes = _lanes(length)
    steps = int(sizes.max(initial=0))
    grid = np.full((steps, len(sizes)), -1, np.int32)
    grid[np.arange(len(x)) + np.repeat(place - first[:-1], length), np.repeat(lane, length)] = np.arange(len(x))
    by_place = np.argsort(place, kind="stable")
    lane, starts = lane[by_place], np.searchsorted(place[by_place], np.arange(steps + 1))
    out = np.zeros(len(x), np.float32)
    rows, u = model.sums()
    h = np.zeros((len(sizes), HIDDEN), np.float32)
    for at in range(0, steps, WINDOW):
        live = int(np.searchsorted(-sizes, -at, side="left"))
        tokens = grid[at:at + WINDOW, :live]
        a, r = model.inputs(rows, x.take(tokens, mode="clip")), model.room("r", 3, live, HIDDEN)
        states = model.room("states", len(tokens) + 1, live, HIDDEN)
        states[0] = h[:live]
        for t in range(len(tokens)):
            new = lane[starts[at + t]:starts[at + t + 1]]
            if len(new):
                states[t, new] = 0
            model.advance(a[t], u, states[t], r, states[t + 1])
        h = states[-1].copy()
        where = np.flatnonzero(tokens.ravel() >= 0)
        token = tokens.ravel()[where]
        out[token] = model.log_probs(states[:-1].reshape(-1, HIDDEN).take(where, axis=0), head.take(token), member.take(token))
    return row_sums(out.astype(np.float64), first)


_TEXT = pa.struct([("n", pa.int64()), ("k", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
_PART = ["row", "h", "times", "text"]


def _scored(model: Gru, waiting: list[tuple]) -> pa.RecordBatch:
    """One row per text: all but the words that go to the join.  A hash of the row spreads these rows in the join, where they add nothing."""
    x, ids, n, k, base, rest = (np.concatenate(some) for some in zip(*waiting))
    score = _log_text(model, x, *outputs(x), np.concatenate([[0], np.cumsum(n)])) / np.log(10) + rest
    text = pa.StructArray.from_arrays([pa.array(n), pa.array(k), pa.array(base), pa.array(score)], fields=list(_TEXT))
    return pa.RecordBatch.from_arrays([pa.array(ids), _signed(mix(ids.astype(np.uint64) + _U(1))), pa.array(np.zeros(len(ids), np.int64)), text], names=_PART)


def _most_frequent(counts: DataFrame) -> pa.Table:
    """Words with the largest counts, at most KNOWN of them: all from a least count on, found on a scale of logarithms."""
    step = F.floor(F.log2("c") * STEPS).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)  # a few hundred steps
    least, so_far = None, 0
    for at, n in sizes:
        so_far += n
        if so_far > KNOWN:
            break
        least = at
    top = counts.where(step >= least) if least is not None else counts.limit(0)
    return top.toArrow().sort_by([("c", "descending"), ("h", "ascending")])


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """row, id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    spark = docs.sparkSession
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("t"),
                             (fold_of(doc_id) == HELD_OUT_FOLD).alias("held_out"))
                 .withColumn("slot", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(SLOTS)).cast("int")).sortWithinPartitions("slot"), "gru-rows")
    counts = stage(rows.where("not held_out").select("t").mapInArrow(_count, "h long, c long")
                   .groupBy("h").agg(F.sum("c").alias("c")), "gru-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = _most_frequent(counts)
    top_h, top_c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    frequent = top_h[:FREQUENT].copy()
    # Mass and number of the words of each rare class: all counted words less the frequent ones.
    mass, kinds = np.zeros(RARE), np.zeros(RARE)
    for r in counts.groupBy(F.col("h").bitwiseAND(RARE - 1).alias("r")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        mass[r.r], kinds[r.r] = r.c, r.v
    for r, c in zip((frequent & _U(RARE - 1)).view(np.int64), top_c):
        mass[r] -= c
        kinds[r] -= 1
    weights = train(rows.where("not held_out").select("row", "t", "slot"), frequent, Gru().start_from(top_c[:FREQUENT], mass))
    shared = spark.sparkContext.broadcast({
        "weights": _pack(weights), "top": top_h, "counts": top_c,
        "base": np.log10(total + 0.5 * (distinct + 1)), "rare": np.log10(mass + 0.5 * (kinds + 1))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        model, code = Gru(), Coder(s["top"])
        model.p = _unpack(s["weights"], model.p)
        log_count = np.append(np.log10(s["counts"] + 0.5), 0)  # the last one is that of rank -1
        waiting, tokens = [], 0
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for at, end, w in word_slices(batch.column(1), BLANKS, WORD_BYTES):
                hashes, rare, first = _tokens(w)
                x, rank = code.inputs(hashes, rare)
                logs, known, n = log_count.take(rank), rank >= 0, np.diff(first)
                waiting.append((x, ids[at:end], n, row_sums(known.astype(np.int64), first), row_sums(logs, first) - n * s["base"],
                                row_sums(np.where(x >= FREQUENT, logs - s["rare"].take(rare), 0), first)))
                tokens += len(x)
                # Words outside the broadcast counts go out once per text, to meet their counts in a join.
                unknown = np.flatnonzero(~known)
                owner = np.searchsorted(first, unknown, side="right") - 1
                _, index, times = np.unique(mix(hashes[unknown] + _U(0x9E3779B97F4A7C15) * owner.astype(np.uint64)),
                                            return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + owner[index]]), _signed(hashes[unknown[index]]), pa.array(times),
                                                  pa.nulls(len(times), _TEXT)], names=_PART)
                if tokens >= SCORE_TOKENS:
                    yield _scored(model, waiting)
                    waiting, tokens = [], 0
        if waiting:
            yield _scored(model, waiting)

    parts = rows.select("row", "t").mapInArrow(run, "row long, h long, times long, text struct<n: long, k: long, base: double, score: double>")
    log = F.col("times") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)
    summed = (parts.join(counts, "h", "left").groupBy("row").agg(
        F.sum("text.n").alias("n_tokens"),
        (F.sum("text.k") + F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        (F.sum("text.base") + F.sum(log)).alias("base_score"), (F.sum("text.score") + F.sum(log)).alias("score")))
    return (rows.select("row", "id", "held_out").join(summed, "row")
            .select("row", "id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the query."""
    return score(docs.select("doc_id", "text")).drop("row").withColumnRenamed("id", "doc_id")
