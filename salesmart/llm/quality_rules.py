"""Operator 5, quality rules as a short-circuit cascade; DataFrame functions only.

Every rule is a Column that is true where a document fails.  A cascade first measures the rules on a
random sample of all rows (about ``SAMPLE_ROWS``, a documented bound, drawn and kept inside Spark; only times and
counts reach the driver): its cost, the time one pass of the rule over the sample takes beyond a
pass without rules, and its selectivity, the share of sampled rows that it rejects.  Rules are then
evaluated in descending order of rejection per cost inside one CASE expression, which stops at a
document's first failed rule.  The order changes the work and never the verdict, so nothing but speed depends on the sample.

Words are ``[^\\x20\\x09-\\x0D]+``.  Edge cases: null is an empty text; texts of fewer than ten words
fail the base rule; texts of fewer than five words have no repeated windows; rows may repeat, and
columns with clashing names stay: added columns get a trailing underscore.  Texts of any length are judged
whole; an empty table gives no rows (its rules keep their listed order).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import free_name

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS, SEED = 1000, 17
WINDOW = 5

#: name -> failing condition over words (array), text and base columns; SQL that both engines read.
RULES = {
    "symbols": lambda w, t, b: 10 * b["n_symbols"] > 3 * b["n_words"],
    "duplicate_lines": lambda w, t, b: 2 * b["n_dup_lines"] > F.size(F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANK[1:]}"))),
    "word_length": lambda w, t, b: (b["word_chars"] < 2 * b["n_words"]) | (b["word_chars"] > 15 * b["n_words"]),
    "shouting": lambda w, t, b: 2 * (F.length(t) - F.length(F.translate(t, "!", ""))) > b["n_words"],
    "vocabulary": lambda w, t, b: 10 * F.size(F.array_distinct(w)) < 3 * b["n_words"],
    "stutter": lambda w, t, b: 10 * F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))) > 3 * b["n_words"],
}
BASE = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus n_words, the base columns, base_failed and (for rules) the words and the text."""
    names = {c: free_name(docs.columns, c) for c in ("n_words", *BASE, "base_failed", "_t", "_w", "_h", "_g", "_s")}
    n = {k: F.col(v) for k, v in names.items()}
    out = docs.withColumn(names["_t"], F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn(names["_w"], F.filter(F.split(n["_t"], f"{BLANK}+"), lambda x: x != ""))
    out = out.withColumn(names["_h"], F.transform(n["_w"], lambda x: F.xxhash64(x)))
    windows = F.transform(F.sequence(F.lit(0), F.size(n["_h"]) - WINDOW), lambda i: F.xxhash64(*(F.get(n["_h"], i + k) for k in range(WINDOW))))
    out = out.withColumn(names["_g"], F.when(F.size(n["_h"]) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn(names["_s"], F.sort_array(n["_g"]))
    repeated = F.exists(F.zip_with(F.slice(n["_s"], 1, F.greatest(F.size(n["_s"]) - 1, F.lit(0))),
                                   F.slice(n["_s"], 2, F.greatest(F.size(n["_s"]) - 1, F.lit(0))), lambda a, b: a == b), lambda x: x)
    lines = F.filter(F.split(n["_t"], "\n"), lambda x: x.rlike(f"[^{BLANK[1:]}"))
    plain = docs.columns
    out = out.select(
        *plain, n["_t"], n["_w"], F.size(n["_w"]).cast("long").alias(names["n_words"]),
        F.length(F.regexp_replace(n["_t"], f"{BLANK}+", "")).cast("long").alias(names["word_chars"]),
        (F.length(n["_t"]) - F.length(F.translate(n["_t"], SYMBOLS, ""))).cast("long").alias(names["n_symbols"]),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(names["n_dup_lines"]),
        # Most texts repeat no window; only the others have their windows sorted with positions.
        F.when(repeated, n["_g"]).alias(names["_g"]))
    out = out.withColumn(names["_g"], F.sort_array(F.transform(n["_g"], lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    out = out.withColumn(names["_g"], F.sort_array(F.transform(
        F.filter(n["_g"], lambda x, i: ((i > 0) & (x["g"] == F.get(n["_g"], F.greatest(i - 1, F.lit(0)))["g"]))
                 | F.coalesce(x["g"] == F.get(n["_g"], i + 1)["g"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(F.transform(n["_g"], lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(n["_g"], i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    out = out.withColumn(names["n_repeat_words"], F.coalesce(covered, F.lit(0).cast("long"))).drop(names["_g"])
    out = out.withColumn(names["base_failed"], (n["n_words"] < 10) | (100 * n["n_repeat_words"] > 20 * n["n_words"]))
    return out, names


def _failing(names: dict[str, str], rule: str) -> Column:
    return RULES[rule](F.col(names["_w"]), F.col(names["_t"]), {k: F.col(v) for k, v in names.items()})


def rule_order(docs: DataFrame, text: str = "text") -> list[tuple[str, float, float]]:
    """(rule, cost in seconds, rejected share) on the sample, by rejection per cost."""
    share = SAMPLE_ROWS / max(1, docs.count())
    rows = docs.select(text)
    sample, names = measured(rows if share >= 1 else rows.sample(share, seed=SEED), text)
    sample = sample.cache()
    try:
        n = max(1, sample.count())

        def timed(failing: Column) -> tuple[float, int]:
            begun = time.perf_counter()
            found = sample.agg(F.sum(failing.cast("int"))).first()[0] or 0
            return time.perf_counter() - begun, found

        empty = min(timed(F.lit(False))[0] for _ in range(2))
        found = []
        for rule in RULES:
            spent, rejected = timed(_failing(names, rule))
            found.append((rule, max(spent - empty, 1e-4), rejected / n))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: -x[2] / x[1])


def judge(docs: DataFrame, text: str = "text", order: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus the base columns, base_failed, kept and failed_rule (null where kept)."""
    order = order or [rule for rule, _, _ in rule_order(docs, text)]
    out, names = measured(docs, text)
    names |= {c: free_name([*docs.columns, *names.values()], c) for c in ("kept", "failed_rule")}
    verdict = F.when(F.col(names["base_failed"]), "base")
    for rule in order:
        verdict = verdict.when(_failing(names, rule), rule)
    out = out.withColumn(names["failed_rule"], verdict).withColumn(names["kept"], F.col(names["failed_rule"]).isNull())
    return out.drop(names["_t"], names["_w"]), names


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the query."""
    out, names = judge(docs.select("doc_id", "text"))
    return out.select("doc_id", *(F.col(names[c]).alias(c) for c in ("n_words", *BASE, "base_failed", "kept")))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS five FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, five) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(0, 5) AS o(k) GROUP BY rid),
b AS (SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN c ON d.rid = c.rid),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > len(l)
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * (length(t) - length(replace(t, '!', ''))) > n_words OR 10 * len(list_distinct(w)) < 3 * n_words
            OR 10 * len(list_filter(list_zip(w[2:], w[:-2]), lambda p: p[1] = p[2])) > 3 * n_words) AS kept
FROM f
"""
