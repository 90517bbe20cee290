"""Operator 6, BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens; its words are exactly the token sequences that the merges produce.  It
starts with the base symbols, every one of which may follow every other, and each merge (u, v) -> t
in order of rank applies one gadget: wherever an arc u is followed by an arc v, a new arc t leads
past both, into a state of its own that copies the state behind v, and the state behind u loses
its arc v.  A state is therefore named by the token read last, and whether it has an arc t
follows from the gadgets alone (``MergeAutomaton.arc``): nothing but the merge table is stored.

Since all states accept and the automaton knows one tokenization of each symbol string, exactly one
token ends at each position of a word.  Composed with the token trie this gives a deterministic
automaton over symbols: a state is the set of unfinished tokens with the states they left from.  Its
transition table is filled as words need it and then only looked up; walking back over the token
that ended at each position yields the ids.  Decoding emits the arc labels.

Words are split, normalised and joined as the tokenizer file says (NFC, lower case, white space
dropped; special tokens are found in the raw text; decoded tokens are joined by one blank).  The file's path is a parameter; its
vocabulary and merges are broadcast (bounded by the file, 49k entries).

Edge cases: null and empty texts have no ids and decode to the empty text; repeated rows are encoded
as they come; very long texts are encoded whole; empty tables give no rows; added columns that clash with input columns get a trailing underscore.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import free_name

#: Entries that a worker keeps at most of its word table and of its transition table.
WORD_ENTRIES, TRANSITIONS = 200_000, 400_000
WORD_END = "</w>"


# Code points that the tokenizers library's Unicode table leaves unassigned, while the tables of this
# Python's pattern module make them letters or numbers.  There they split words as any other sign.
UNASSIGNED = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F""".split()
#: Lower case of the capitals that the library knows beyond this Python's table (first, last: distance).
LOWER = {(0x1C89, 0x1C89): 1, (0xA7CB, 0xA7CB): 0x264 - 0xA7CB, (0xA7CC, 0xA7CC): 1, (0xA7CE, 0xA7CE): 1, (0xA7D2, 0xA7D2): 1, (0xA7D4, 0xA7D4): 1,
         (0xA7DA, 0xA7DA): 1, (0xA7DC, 0xA7DC): 0x19B - 0xA7DC, (0x10D50, 0x10D65): 0x20, (0x16EA0, 0x16EB8): 0x1B}


def byte_symbols() -> list[str]:
    """The visible character of each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class MergeAutomaton:
    """Arcs of the merge automaton, and its composition with the token trie as a lazily filled table."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for k, (a, b) in enumerate(merges):
            u, v, t = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault((u, v), k)
            self.made.setdefault(t, (u, v, k))
        symbols = byte_symbols()
        self.inner = [vocab.get(s, -1) for s in symbols]
        self.last = [vocab.get(s + WORD_END, -1) for s in symbols]
        base = {*self.inner, *self.last} - {-1}
        #: Trie over base symbols: child by (node, symbol); token and length at a node.
        self.child: dict[tuple[int, int], int] = {}
        self.token, self.depth, self.inside = [-1], [0], [False]
        for t in [*base, *self.made]:
            node = 0
            for s in self._spell(t):
                self.inside[node] = True
                step = self.child.get((node, s))
                if step is None:
                    step = self.child[node, s] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.inside.append(False)
                node = step
            self.token[node] = t
        self.clear()

    def _spell(self, token: int) -> list[int]:
        stack, out = [token], []
        while stack:
            t = stack.pop()
            if t in self.made:
                u, v, _ = self.made[t]
                stack += [v, u]
            else:
                out.append(t)
        return out

    def clear(self) -> None:
        self.arcs: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = [((0, -1),)]
        self.number: dict[tuple, int] = {((0, -1),): 0}
        self.table: dict[int, tuple[int, int, int]] = {}

    def arc(self, x: int, t: int) -> bool:
        """Does the state behind token ``x`` (-1: the start) have an arc ``t`` after all gadgets?"""
        if x < 0:
            return True
        known = self.arcs.get((x, t))
        if known is None:
            known = self.arcs[x, t] = self._arc(x, t, len(self.rank) + 1)
        return known

    def _arc(self, x: int, t: int, before: int) -> bool:
        """The same after the gadgets of ranks below ``before``."""
        while True:
            removed = self.rank.get((x, t))
            if removed is not None and removed < before:
                return False
            _, copied, kx = self.made.get(x, (0, 0, -1))
            first, _, kt = self.made.get(t, (0, 0, -1))
            if kx < 0 and kt < 0:
                return True
            if kx == kt:
                # x = t = uv: behind the new state t can go on where the state behind v had an arc u.
                x, t, before = copied, first, kx
            elif kx > kt:
                # The state behind x copied the one behind its right part when x was made.
                x, before = copied, kx
            else:
                # Arc t was laid where an arc to its left part stood; the leftmost of equal pairs merges first.
                if self.rank.get((x, first)) == kt:
                    return False
                t, before = first, kt

    def step(self, state: int, symbol: int) -> tuple[int, int, int]:
        """(next state, token that ends here, its length in symbols)."""
        found, open_ = (-1, 0), []
        for node, behind in self.states[state]:
            node = self.child.get((node, symbol), -1)
            if node < 0:
                continue
            t = self.token[node]
            if t >= 0 and found[0] < 0 and self.arc(behind, t):
                found = t, self.depth[node]
            if self.inside[node]:
                open_.append((node, behind))
        threads = (*open_, (0, found[0]))
        number = self.number.get(threads)
        if number is None:
            number = self.number[threads] = len(self.states)
            self.states.append(threads)
        out = self.table[state * 65536 + symbol] = (number, *found)
        return out

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-split word."""
        if len(self.table) > TRANSITIONS:
            self.clear()
        inner, table = self.inner, self.table
        state, ended = 0, []
        for s in [*(inner[b] for b in word[:-1]), self.last[word[-1]]]:
            step = table.get(state * 65536 + s) or self.step(state, s)
            state = step[0]
            ended.append(step)
        out, at = [], len(ended)
        while at:
            _, t, n = ended[at - 1]
            if n == 0:
                raise ValueError(f"no tokenization of {word!r}")
            out.append(t)
            at -= n
        return out[::-1]


class Tokenizer:
    """Splits whole texts and keeps the ids of words seen before."""

    def __init__(self, spec: dict):
        import regex

        self.automaton = MergeAutomaton(spec["vocab"], spec["merges"])
        self.special = spec["special"]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.split_words = regex.compile(spec["pattern"])
        ranges = [[chr(int(x, 16)) for x in r.split("-")] for r in UNASSIGNED]
        self.unassigned = regex.compile("[" + "".join("-".join(r) for r in ranges) + "]")
        self.lower = {c: c + by for (a, b), by in LOWER.items() for c in range(a, b + 1)}
        self.rare = regex.compile("[" + "".join("-".join(r) for r in ranges) + "".join(map(chr, self.lower)) + "]")
        self.words: dict[str, bytes] = {}
        labels = {i: t for t, i in [*spec["vocab"].items(), *self.special.items()]}
        self.labels = [labels.get(i, "").encode() for i in range(max(labels) + 1)]

    def _segment(self, text: str) -> bytes:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower-cased by character, without the rule for word ends
            if self.rare.search(text):
                text = text.translate(self.lower).lower()
                # A non-character, which is a sign in every table, stands in while words are found.
                spans = [m.span() for m in self.split_words.finditer(self.unassigned.sub("\uFFFF", text))]
                return self._ids([text[a:b] for a, b in spans])
        return self._ids(self.split_words.findall(text.lower()))

    def _ids(self, found: list[str]) -> bytes:
        words, known = self.words, []
        for w in found:
            ids = words.get(w)
            if ids is None:
                if len(words) >= WORD_ENTRIES:
                    words.clear()
                ids = words[w] = np.array(self.automaton.encode(w.encode()), "<u4").tobytes()
            known.append(ids)
        return b"".join(known)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.split_special is None or "<" not in text:
            return self._segment(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._segment(p)
                        for p in self.split_special.split(text))

    def decode(self, ids: bytes) -> bytes:
        return b" ".join([self.labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


def read_spec(path: str) -> dict:
    """Vocabulary, merges, special tokens and split pattern of a tokenizer file of the word-end kind."""
    with open(path, encoding="utf-8") as f:
        full = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in full["model"]["merges"]]
    split = full["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return {"vocab": full["model"]["vocab"], "merges": merges, "pattern": split.replace("\\s", "\\p{White_Space}"),
            "special": {t["content"]: t["id"] for t in full["added_tokens"]}}


def _worker(shared) -> Tokenizer:
    """One tokenizer per worker process: it lives with the broadcast value."""
    value = shared.value
    if "tokenizer" not in value:
        value["tokenizer"] = Tokenizer(value)
    return value["tokenizer"]


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False,
           drop_text: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus ids (binary, little-endian unsigned 32-bit), and on request the decoded text.

    ``drop_text`` leaves out the input text.  Returns the frame and the added columns' names.
    """
    names = {c: free_name(docs.columns, c) for c in ("ids", "decoded")}
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    schema = T.StructType([*kept, T.StructField(names["ids"], T.BinaryType(), False),
                           *([T.StructField(names["decoded"], T.StringType(), False)] if decoded else [])])
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    where, places = docs.columns.index(text), [docs.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _worker(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [t.encode(x or "") for x in part.column(where).to_pylist()]
                columns = [*(part.column(k) for k in places), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([t.decode(x) for x in ids], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema), names


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> tuple[DataFrame, str]:
    """``tokens`` plus the text of the packed ids (null: empty), and the added column's name."""
    name = free_name(tokens.columns, "decoded")
    schema = T.StructType([*tokens.schema.fields, T.StructField(name, T.StringType(), False)])
    shared = tokens.sparkSession.sparkContext.broadcast(read_spec(path))
    where = tokens.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _worker(shared)
        for batch in batches:
            text = pa.array([t.decode(x or b"") for x in batch.column(where).to_pylist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=schema.names)

    return tokens.mapInArrow(run, schema), name


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Contract columns of the query."""
    out, names = encode(docs.select("doc_id", "text"), path, decoded=True, drop_text=True)
    ids = F.col(names["ids"])
    return out.select("doc_id", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
                      F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col(names["decoded"]).cast("binary"), 256).alias("decoded_sha256"))
