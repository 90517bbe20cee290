"""Operator 11, spelling variants grouped by asymmetric q-chunks.

Words.  Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.  In the counted vocabulary of ``digest``
a run whose crc32("<doc_id>:<run>") divides by ``MISSPELL`` loses one code point (a planted slip).  Words have
at least ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences.  Every task sums its own occurrences in a
table of bounded size, so a word that fills a third of the corpus is shuffled as a few partial counts.

Near words (one inserted, deleted or replaced code point).  The longer word of a pair (either, if equally long)
gives two disjoint chunks, its halves; one edit leaves one of them whole.  The other word gives its
positional grams of the chunks' lengths; a pair that one edit separates shares a chunk and a gram whose
positions differ by at most one: by none if the kept half is the first one or the lengths are equal, by the
difference of lengths if it is the second.  So the join is an equality of (chunked length, chunk, text).

Chunks that many words share (an ending, a common stem) would make a bucket's pairs grow with its square.
The kept chunk says nothing about the rest of both words, which again differ by one edit, so the rest is
chunked likewise: ``LEVELS`` times for all words (keys then hold three quarters of the word, all but a *hole*),
and further, halving the hole, in buckets with more than ``BUCKET_PAIRS`` pairs.  A hole of one code point
can't be split; its bucket holds one word per letter, all near each other.  No candidate is dropped.
Candidates are verified inside the join by the edit distance itself.

Forms.  A word's form is its near word of largest count (ties: smallest in code-point order) if that count is at
least ``DOMINANCE`` times the word's; counts grow along forms, so following them ends.  Roots are found by pointer doubling.

Edge cases.  Null and empty texts have no words; a null doc_id counts as the empty text in the crc32; repeated rows
count as often as they occur; very long texts are read in pieces cut between words; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage

MISSPELL = 97
MIN_CHARS, MIN_COUNT = 5, 3
DOMINANCE = 2
#: Times that every word is halved before the join.
LEVELS = 2
#: Pairs of a bucket up to which it is compared as it is; beyond, its words' holes are halved again.
BUCKET_PAIRS = 20_000
#: Distinct words a task sums before it passes them on, and bytes of text it splits at once.
TABLE_WORDS, PIECE_BYTES = 200_000, 1 << 20

#: Runs of at least MIN_CHARS letters in lower-cased UTF-8: U+00C0 to U+00FF are C3 80 to C3 BF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % MIN_CHARS)
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` in pieces of about PIECE_BYTES, cut where no run goes on."""
    at = 0
    while len(raw) - at > PIECE_BYTES:
        gap = _GAP.search(raw, at + PIECE_BYTES)
        if gap is None:
            break
        yield raw[at:gap.start()]
        at = gap.start()
    yield raw[at:]


def _words_of(doc_id: object, text: str) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of one text, slips included."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for piece in _pieces(text.encode().lower()):
        for run, n in Counter(_RUN.findall(piece)).items():
            h = zlib.crc32(run, seed)
            if h % MISSPELL == 0:
                chars = run.decode()
                at = h % len(chars)
                chars = chars[:at] + chars[at + 1:]
                if len(chars) < MIN_CHARS:
                    continue
                run = chars.encode()
            yield run, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (word, n) partial counts, a bounded table at a time."""
    table: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in table], pa.string()), pa.array(list(table.values()), pa.int64())],
                                         names=["word", "n"])
        table.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if text.is_valid:
                for word, n in _words_of(doc_id.as_py(), text.as_py()):
                    table[word] += n
                if len(table) >= TABLE_WORDS:
                    yield flush()
    if table:
        yield flush()


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n) of the words with at least MIN_COUNT occurrences in all texts."""
    parts = docs.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _key() -> Column:
    """What a word shows of a chunked word of length ``whole`` with the hole [lo, hi): its head and its tail."""
    return F.xxhash64("whole", "lo", "hi", F.expr("left(word, lo)"), F.expr("right(word, whole - hi)"))


def _halved(lo: Column, hi: Column) -> Column:
    """The two holes that are left when one half of the hole [lo, hi) is a kept chunk."""
    middle = lo + ((hi - lo) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def _refined(rows: DataFrame) -> DataFrame:
    return (rows.select("word", "n", "whole", F.explode(_halved(F.col("lo"), F.col("hi"))).alias("hole"))
            .select("word", "n", "whole", "hole.lo", "hole.hi"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of all unordered pairs of ``words(word, n)`` that one edit separates, each once.

    Words are distinct.  Rows of the working table stand for (word, length of the chunked word, hole): a word
    is chunked at its own length and gives grams to words of its length and one longer.
    """
    size = F.char_length("word")
    rows = (words.select("word", "n", F.explode(F.array(size, size + 1)).alias("whole"))
            .select("*", F.lit(0).alias("lo"), F.col("whole").alias("hi")))
    for _ in range(LEVELS):
        rows = _refined(rows)
    found = []
    while True:
        rows = stage(rows.where("hi > lo").withColumn("key", _key()), "spelling-grams")
        chunked = F.count_if(size == F.col("whole"))
        hot = (rows.groupBy("key", "whole", "lo", "hi").agg(chunked.alias("c"), F.count("*").alias("g"))
               .where((F.col("c") * F.col("g") > BUCKET_PAIRS) & (F.col("hi") - F.col("lo") > 1)).select("key"))
        hot = stage(hot.distinct(), "spelling-hot")
        again = not hot.isEmpty()
        cold = rows.join(hot, "key", "left_anti") if again else rows
        a = cold.where(size == F.col("whole")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        b = cold.select(F.col("key").alias("gram_key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
        # Of two equally long words the smaller one is chunked; a longer one is chunked in any case.
        once = (F.char_length("b") < F.char_length("a")) | (F.col("a") < F.col("b"))
        match = (F.col("key") == F.col("gram_key")) & once & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
        found.append(a.join(b, match).select("a", "a_n", "b", "b_n"))
        if not again:
            break
        rows = _refined(rows.join(hot, "key", "left_semi").drop("key"))
    return reduce(DataFrame.unionAll, found).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: pointers are doubled until all lead to a word without a form."""
    up = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not up.where("moved").isEmpty():
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = stage(up.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return up.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of every row of ``words(word, n)``."""
    pairs = stage(near_pairs(words), "spelling-pairs")
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    chosen = -F.col("best.less") >= DOMINANCE * F.col("n")
    made = stage(words.join(best, "word", "left").select(
        "word", "n", F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")), "spelling-forms")
    roots = _roots(made.where("form is not null"))
    return made.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs(doc_id, text)``: word, form, root, n, n_near, form_n."""
    words = stage(vocabulary(docs), "spelling-words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
