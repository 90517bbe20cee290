"""Operator 8, main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks: text between block-level tags, with the path of open elements (tags,
classes, ids) it stands in.  A numpy bidirectional LSTM reads the page's sequence of blocks, each as the
sum of its hashed path vectors, the mean of its hashed word vectors, and its length, link share and
place, and labels every block with the whole page as context.

There are no labelled pages, so the network learns from pages that say what their parts are: a
block's label follows from semantic elements and usual class names (``ROLES``), on at most
``TRAIN_PAGES`` different pages of at most ``PAGE_BYTES``, those with the least hashes (documented bounds; hashes are
compared first, then these pages are read).  Each page is also read in variants with other container
names and inserted notices, forms, adverts, sidebars and comments, and each of those again without its names: paths in
which semantic elements are ``div`` or table cells and classes are random.  There only words, lengths, links, places and the
neighbours tell main text, and so they do on pages whose names say nothing.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined by two line feeds in page order; scripts, styles, comments and the head are
no blocks.  Edge cases: null and empty pages, and pages without text, give an empty text; unclosed and truncated tags,
comments and scripts end with the page; the content of a ``textarea`` is no text; very long pages are read whole; repeated rows are extracted as they come; added columns that
clash with input columns get a trailing underscore; without training pages every block is kept.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import BLANKS, Words, free_name, mix

TRAIN_PAGES, PAGE_BYTES, EPOCHS, RATE = 200, 256 << 10, 24, 0.01
PATH_ROWS, PATH_DIM, WORD_ROWS, WORD_DIM, HIDDEN = 512, 24, 1024, 12, 24
#: Weight of a page without names beside the same page with them.
UNNAMED = 0.5

# Elements that do not end a block, elements whose content is no text, elements
# without content, and the roles that element and class names usually mark.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
             "sub sup time tt u var wbr".split())
RAW = "script|style|noscript|template|svg|iframe|head|object|canvas|textarea"
SEMANTIC = set("article main section header nav footer aside form figure".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ROLES = {
    "main": set("article main content post entry story".split()),
    "other": set("nav footer aside form button select textarea dialog menu ad ads advert advertisement banner sponsor sponsored promo navbar "
                 "navigation breadcrumb breadcrumbs sidebar widget related share social cookie cookies consent notice alert popup modal "
                 "newsletter subscribe signup login search comment comments reply respond disqus masthead copyright legal pagination".split()),
}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(" + RAW + r")\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[a-z]+")
_CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in page order.  A path names each open element and its classes and ids."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(tuple(x for _, names in stack for x in names), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    for m in _TAG.finditer(page):
        if m.start() > at:
            pieces.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m[2] else links + 1
            elif tag == "br":
                pieces.append(" ")
            continue
        flush()
        links = 0
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if tag in _CLOSES_P and stack and stack[-1][0] == "p" or tag == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            if tag not in VOID and not m[4].endswith("/"):
                marks = [x for g in _MARK.findall(m[4]) for x in _PART.findall("".join(g).lower())] if m[4] else []
                stack.append((tag, (tag, *(f".{x}" for x in dict.fromkeys(marks)))))
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


def role(path: tuple[str, ...]) -> int | None:
    """1 for main text, 0 for the rest, None where no name says."""
    names = [x.lstrip(".") for x in path]
    main = any(x in ROLES["main"] for x in names)
    if any(x in ROLES["other"] for x in names) or "header" in names and not main:
        return 0
    return 1 if main else None


def variants(page: str, rng: np.random.Generator) -> Iterator[str]:
    """The page, and one with other container names and inserted parts that are no main text."""
    yield page
    texts = [b.text for b in blocks(page)] or [""]

    def some() -> str:
        return html.escape(texts[rng.integers(len(texts))][:int(rng.integers(10, 400))])

    opened, closed = [('<main id="main">', "</main>"), ('<div class="post-content">', "</div>"), ('<div id="content" class="entry">', "</div>"),
                      ("<article>", "</article>"), ('<section class="article story">', "</section>")][rng.integers(5)]
    page = re.sub(r"<article[^>]*>", opened, page, flags=re.I)
    page = re.sub(r"</article\s*>", closed, page, flags=re.I)
    above = [f'<header><h2>{some()}</h2><p>{some()}</p></header>', f'<div class="cookie-notice"><p>{some()}</p><button>{some()}</button></div>',
             f'<div class="banner ad"><p>{some()}</p></div>', f'<ul class="menu"><li><a href="/">{some()}</a></li><li>{some()}</li></ul>',
             f'<form class="search"><label>{some()}</label><input></form>', f'<div class="breadcrumbs"><a href="/">{some()}</a></div>']
    below = [f'<aside><h3>{some()}</h3><p>{some()}</p></aside>', f'<div id="sidebar"><div class="widget"><p>{some()}</p></div></div>',
             f'<section class="comments"><div class="comment"><p>{some()}</p></div><div class="comment"><p>{some()}</p></div></section>',
             f'<div class="newsletter"><form><p>{some()}</p></form></div>', f'<div class="related"><h4>{some()}</h4><ul><li>{some()}</li></ul></div>',
             f'<div class="sponsored"><p>{some()}</p></div>']
    page = page.replace(opened, "".join(x for x in above if rng.random() < 0.4) + opened, 1)
    if rng.random() < 0.5:
        inside = below[rng.integers(len(below))]
        middle = page.find("<p>", page.find(opened) + len(opened) + int(rng.integers(0, 2000)))
        if middle > 0:
            page = page[:middle] + inside + page[middle:]
    yield page.replace(closed, closed + "".join(x for x in below if rng.random() < 0.4), 1)


def unnamed(page: list[Block], rng: np.random.Generator) -> list[Block]:
    """The blocks with paths that name nothing: each container gets one element, each class one random name.

    Containers are nested by chance: around everything, around parts, around the paragraphs of a part; or paragraphs are containers.
    """
    plain, classes = [("div",), ("div",), ("section",), ("table", "tr", "td"), ("center",)][rng.integers(5)], {}
    around, parts, inside = plain * int(rng.integers(0, 3)), {}, rng.random(3) < (0.4, 0.4, 0.3)

    def nested(path: tuple[str, ...]) -> tuple[str, ...]:
        cut = max((k for k, x in enumerate(path) if x[0] != "."), default=0)
        part = path[:cut]
        wrap = parts.setdefault(part, plain * int(rng.integers(0, 3)))
        wrap += plain * int(inside[0] and path[cut:cut + 1] == ("p",)) + plain * int(inside[1])
        return around + part + wrap + path[cut:]

    def part(name: str) -> tuple[str, ...]:
        if name.startswith("."):
            return (classes.setdefault(name, "." + "".join(chr(97 + c) for c in rng.integers(0, 26, 3))),)
        return plain if name in SEMANTIC or name == "p" and inside[2] else (name,)

    return [Block(tuple(y for x in nested(b.path) if x[0] != "." or rng.random() < 0.7 for y in part(x)), b.text, b.linked) for b in page]


def _row(name: str) -> int:
    return zlib.crc32(name.encode()) % PATH_ROWS


class Features:
    """Blocks of some pages as arrays: hashed path parts and words with their owners, and four numbers."""

    def __init__(self, pages: list[list[Block]], drop: float = 0.0, rng: np.random.Generator | None = None):
        every = [b for p in pages for b in p]
        self.n = len(every)
        self.sizes = np.array([len(p) for p in pages], np.int64)
        known: dict[str, int] = {}
        parts = [[known.get(x) or known.setdefault(x, _row(x)) for x in b.path] for b in every]
        self.path_owner = np.repeat(np.arange(self.n), [len(p) for p in parts])
        self.path = np.array([x for p in parts for x in p], np.int64)
        if drop:
            keep = rng.random(len(self.path)) >= drop
            self.path_owner, self.path = self.path_owner[keep], self.path[keep]
        data = [b.text.encode() for b in every]
        w = Words(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64), BLANKS)
        self.words, self.word_first = (mix(w.hash) % np.uint64(WORD_ROWS)).astype(np.int64), w.first
        if drop:  # words too, and all words of some blocks: a short block must not hang on its words
            keep = (rng.random(len(self.words)) >= 0.4) & (rng.random(self.n) >= 0.3)[w.row]
            self.words = self.words[keep]
            self.word_first = np.concatenate([[0], np.cumsum(np.bincount(w.row[keep], minlength=self.n))]).astype(np.int64)
        chars = np.array([len(b.text) for b in every], np.float32)
        at = np.concatenate([np.arange(n) / n for n in self.sizes if n]) if self.n else np.zeros(0)
        self.numbers = np.stack([np.log1p(chars) / 5, np.array([b.linked for b in every], np.float32) / np.maximum(chars, 1), at, 1 - at], 1).astype(np.float32) \
            if self.n else np.zeros((0, 4), np.float32)


class Labeller:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        width = PATH_DIM + WORD_DIM + 4
        self.p = {"path": rng.standard_normal((PATH_ROWS, PATH_DIM)) * 0.2, "word": rng.standard_normal((WORD_ROWS, WORD_DIM)) * 0.1,
                  "out": rng.standard_normal(2 * HIDDEN) * 0.1, "outb": np.zeros(1)}
        for d in "fb":
            self.p |= {f"w{d}": rng.standard_normal((width, 4 * HIDDEN)) * 0.15, f"u{d}": rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.15,
                       f"c{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, f: Features) -> np.ndarray:
        x = np.zeros((f.n, PATH_DIM + WORD_DIM + 4), np.float32)
        np.add.at(x[:, :PATH_DIM], f.path_owner, self.p["path"][f.path])
        filled = np.flatnonzero(np.diff(f.word_first))
        if len(filled):
            sums = np.add.reduceat(self.p["word"][f.words], f.word_first[filled], axis=0)
            x[filled, PATH_DIM:-4] = sums / np.diff(f.word_first)[filled, None]
        x[:, -4:] = f.numbers
        return x

    @staticmethod
    def grid(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(time, page) -> block number, -1 past a page's end; forwards and backwards."""
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        t = np.arange(int(sizes.max()) if len(sizes) else 0)[:, None]
        live = t < sizes[None, :]
        return np.where(live, first + t, -1), np.where(live, first + sizes - 1 - t, -1)

    def scan(self, x: np.ndarray, order: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden state at every block, in the direction of ``order``."""
        out = np.zeros((len(x), HIDDEN), np.float32)
        pre = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
        h = c = np.zeros((order.shape[1], HIDDEN), np.float32)
        for at in order:
            live = at >= 0
            z = pre[at] + h @ self.p[f"u{d}"]
            s = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((at, live, i, f, o, g, c, tanh, h))
            c = np.where(live[:, None], new, c)
            h = np.where(live[:, None], o * tanh, h)
            out[at[live]] = h[live]
        return out

    def back(self, x: np.ndarray, d: str, steps: list, dout: np.ndarray, g: dict) -> np.ndarray:
        dpre = np.zeros((len(x), 4 * HIDDEN), np.float32)
        dh = dc = np.zeros_like(steps[0][8])
        for at, live, i, f, o, gg, c, tanh, h in reversed(steps):
            dht = (dh + dout[at]) * live[:, None]
            dct = dc * live[:, None] + dht * o * (1 - tanh * tanh)
            dz = np.concatenate([dct * gg * i * (1 - i), dct * c * f * (1 - f), dht * tanh * o * (1 - o), dct * i * (1 - gg * gg)], 1)
            dpre[at[live]] = dz[live]
            g[f"u{d}"] += h.T @ dz
            dh = np.where(live[:, None], dz @ self.p[f"u{d}"].T, dh)
            dc = np.where(live[:, None], dct * f, dc)
        g[f"w{d}"] += x.T @ dpre
        g[f"c{d}"] += dpre.sum(axis=0)
        return dpre @ self.p[f"w{d}"].T

    def probabilities(self, f: Features) -> np.ndarray:
        if not f.n:
            return np.zeros(0)
        x = self.inputs(f)
        there, back = self.grid(f.sizes)
        h = np.concatenate([self.scan(x, there, "f"), self.scan(x, back, "b")], 1)
        return 1 / (1 + np.exp(-(h @ self.p["out"] + self.p["outb"])))

    def gradients(self, f: Features, y: np.ndarray, weight: np.ndarray) -> dict:
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        x = self.inputs(f)
        steps: dict[str, list] = {"f": [], "b": []}
        orders = dict(zip("fb", self.grid(f.sizes)))
        h = np.concatenate([self.scan(x, orders[d], d, steps[d]) for d in "fb"], 1)
        e = ((1 / (1 + np.exp(-(h @ self.p["out"] + self.p["outb"]))) - y) * weight / max(1, weight.sum())).astype(np.float32)
        g["out"], g["outb"] = h.T @ e, e.sum(keepdims=True)
        dh = e[:, None] * self.p["out"]
        dx = sum(self.back(x, d, steps[d], dh[:, k * HIDDEN:(k + 1) * HIDDEN], g) for k, d in enumerate("fb"))
        np.add.at(g["path"], f.path, dx[f.path_owner, :PATH_DIM])
        count = np.diff(f.word_first)
        np.add.at(g["word"], f.words, np.repeat(dx[:, PATH_DIM:-4] / np.maximum(count, 1)[:, None], count, axis=0))
        return g


def fit(pages: list[str], seed: int = 5) -> dict:
    """Weights learned from the pages' own semantic names."""
    rng = np.random.default_rng(seed)
    model = Labeller()
    parsed: list[tuple[list[Block], list[int | None], float]] = []
    for page in pages:
        for v in variants(page, rng):
            found = blocks(v)
            labels = [role(b.path) for b in found]
            if 1 in labels:
                parsed += [(found, labels, 1.0), (unnamed(found, rng), labels, UNNAMED)]
    if not parsed:
        model.p["outb"][:] = 50.0
        model.p["out"][:] = 0
        return model.p
    one = {k: np.zeros_like(v) for k, v in model.p.items()}
    two = {k: np.zeros_like(v) for k, v in model.p.items()}
    n, steps = 0, EPOCHS * -(-len(parsed) // 16)
    for _ in range(EPOCHS):
        order = rng.permutation(len(parsed))
        for at in range(0, len(order), 16):
            batch = [parsed[i][0] for i in order[at:at + 16]]
            labels = [x for i in order[at:at + 16] for x in parsed[i][1]]
            # On a page that names its main part, unnamed blocks are outside it.
            y, weight = np.array([x or 0 for x in labels], np.float32), np.array([0.3 if x is None else 1.0 for x in labels], np.float32)
            weight *= np.repeat([parsed[i][2] for i in order[at:at + 16]], [len(p) for p in batch]).astype(np.float32)
            grads = model.gradients(Features(batch, 0.1, rng), y, weight)
            n += 1
            for k, g in grads.items():
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.99 * two[k] + 0.01 * g * g
                rate = RATE * (1 - n / (steps + 1))
                model.p[k] -= (rate * (one[k] / (1 - 0.9 ** n)) / (np.sqrt(two[k] / (1 - 0.99 ** n)) + 1e-8)).astype(np.float32)
    return model.p


def train(pages: DataFrame, page_id: str = "page_id", page: str = "html") -> dict:
    rows = pages.select(F.col(page).alias("p"), F.xxhash64(page_id, page).alias("k")).where(F.octet_length("p").between(1, PAGE_BYTES))
    chosen = [r.k for r in rows.select("k").distinct().orderBy("k").limit(TRAIN_PAGES).collect()]
    picked = rows.where(F.col("k").isin(chosen)).groupBy("k").agg(F.first("p").alias("p")).collect()
    return fit([r.p for r in sorted(picked)])


def extract(pages: DataFrame, weights: dict, page: str = "html", drop_page: bool = False) -> tuple[DataFrame, str]:
    """``pages`` plus the main text, and the added column's name."""
    name = free_name(pages.columns, "text")
    kept = [f for f in pages.schema.fields if not (drop_page and f.name == page)]
    schema = T.StructType([*kept, T.StructField(name, T.StringType(), False)])
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    where, places = pages.columns.index(page), [pages.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller()
        model.p = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cut = [blocks(x or "") for x in part.column(where).to_pylist()]
                main = model.probabilities(Features(cut)) >= 0.5
                texts, k = [], 0
                for p in cut:
                    texts.append("\n\n".join(b.text for b, ok in zip(p, main[k:k + len(p)]) if ok))
                    k += len(p)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in places), pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema), name


def digest(pages: DataFrame) -> DataFrame:
    """Contract columns of the query."""
    out, name = extract(pages.select("page_id", "url", "html"), train(pages), drop_page=True)
    return out.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))
