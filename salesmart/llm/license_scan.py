"""Operator 1, license scan by patience alignment.

Notices of common licenses are templates.  A place in a text matches a template if an alignment of their
words covers at least ``COVERAGE`` of the template and matched words make at least ``COVERAGE`` of the
place.  Alignment is patience: anchor on words that are unique in both sequences, keep the longest
increasing subsequence of anchors, and align the gaps between anchors the same way (in a gap more
words are unique); a gap without anchors is aligned by its equal beginning and end.

Beside whole notices there are their short forms: identifier lines, abbreviations with a version, names of clauses.

What tells licenses apart must be there: of each word of ``MARKS`` (name and version) of a template a place
is matched, and no word of ``QUALIFIERS`` stands unmatched inside the place ("NonCommercial" in the sentence of
CC BY).  Of overlapping places only the best is reported, the one with the most matched words.

Candidates are exact.  A place that matches shares at least ``_need`` adjacent word pairs with the
template (each unmatched template word breaks two pairs, each foreign word one); all pairs of all
templates are looked up in one vectorised pass over whole texts, and only windows with so many hits are aligned.
The template table is a parameter of bounded size and travels with the task.

Words are letters, digits and non-ASCII characters, A-Z lower-cased.  Edge cases: null, empty and
wordless texts match nothing; a notice that repeats is reported at each place; overlapping places of
one template are taken leftmost first; a license that is in no template matches nothing; rows may repeat; added columns that clash get a trailing underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import LETTERS, Words, free_name, lookup, mix, word_slices

COVERAGE = 0.75

# Public license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "Released under the BSD License.",
    "isc": "Released under the ISC License.",
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
}
#: Words that a place must have, by template.
MARKS = {"apache-2.0": "apache 2 0", "apache-2.0-notice": "apache 2 0", "mit": "mit", "mpl-2.0": "mozilla 2 0", "bsd": "bsd", "isc": "isc",
         "unlicense": "unencumbered", "cc0-1.0": "cc0 1 0", "epl-2.0": "eclipse 2 0"}
#: Words that make another license of a template's.
QUALIFIERS = "affero lesser library nc nd sa noncommercial noderivatives noderivs sharealike"

# The GNU and Creative Commons families differ by name and version only.
for _kind, _title, _versions in (("gpl", "", ("2", "3")), ("lgpl", "Lesser ", ("2.1", "3")), ("agpl", "Affero ", ("3",))):
    for _v in _versions:
        _name = f"{_kind}-{_v if '.' in _v else _v + '.0'}"
        TEMPLATES[_name] = f"This work is licensed under the GNU {_title}General Public License, version {_v}."
        TEMPLATES[f"{_name}-notice"] = (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {_title}General Public License as "
            f"published by the Free Software Foundation, either version {_v} of the License, or (at your option) any later version.")
        MARKS[_name] = MARKS[f"{_name}-notice"] = f"{_title}general public {_v}"
for _kind, _title in (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"),
                      ("by-nc", "Attribution-NonCommercial"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
                      ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives")):
    for _v, _port in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES[f"cc-{_kind}-{_v}"] = f"This work is licensed under a Creative Commons {_title} {_v} {_port} License."
        MARKS[f"cc-{_kind}-{_v}"] = f"creative commons {_title} {_v}"
        TEMPLATES[f"cc-{_kind}-{_v}-short"] = f"Licensed under CC {_kind.upper()} {_v}."
        MARKS[f"cc-{_kind}-{_v}-short"] = f"cc {_kind} {_v}"


        TEMPLATES[f"cc-{_kind}-{_v}/name"] = f"CC {_kind.upper()} {_v}"
        MARKS[f"cc-{_kind}-{_v}/name"] = f"cc {_kind} {_v}"
#: Identifiers of the SPDX list, by license; "only" and "or later" are one license here.
IDENTIFIERS = {
    "apache-2.0": ["Apache-2.0"], "mit": ["MIT"], "bsd-2-clause": ["BSD-2-Clause"], "bsd-3-clause": ["BSD-3-Clause"], "isc": ["ISC"],
    "mpl-2.0": ["MPL-2.0"], "unlicense": ["Unlicense"], "cc0-1.0": ["CC0-1.0"], "epl-2.0": ["EPL-2.0"],
    **{f"{k}-{v}": [f"{k.upper()}-{v}{end}" for end in ("", "-only", "-or-later")]
       for k, v in (("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0"))},
    **{f"cc-{k}-{v}": [f"CC-{k.upper()}-{v}"] for k in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd") for v in ("4.0", "3.0")}}
for _name, _ids in IDENTIFIERS.items():
    for _id in _ids:
        TEMPLATES[f"{_name}/{_id}"], MARKS[f"{_name}/{_id}"] = f"SPDX-License-Identifier: {_id}", f"spdx {_id}"
# Short forms: clauses of the BSD family, and the GNU family by abbreviation or by name with "v".
for _v in ("2", "3"):
    TEMPLATES[f"bsd-{_v}-clause"], MARKS[f"bsd-{_v}-clause"] = f"Released under the BSD {_v}-Clause License.", f"bsd {_v} clause"
    TEMPLATES[f"bsd-{_v}-clause/name"], MARKS[f"bsd-{_v}-clause/name"] = f"BSD {_v}-Clause License", f"bsd {_v} clause"
for _kind, _title, _versions in (("gpl", "", ("2", "3")), ("lgpl", "Lesser ", ("2.1", "3")), ("agpl", "Affero ", ("3",))):
    for _v in _versions:
        _name = f"{_kind}-{_v if '.' in _v else _v + '.0'}"
        for _form in (f"{_kind.upper()} v{_v}", f"{_kind.upper()}v{_v}", f"{_kind.upper()} version {_v}", f"{_kind.upper()} {_v}"):
            TEMPLATES[f"{_name}/{_form}"], MARKS[f"{_name}/{_form}"] = f"Released under the {_form} license.", _form
        TEMPLATES[f"{_name}/name"], MARKS[f"{_name}/name"] = f"GNU {_title}General Public License v{_v}", f"{_title}general public v{_v}"


def license_of(template: str) -> str:
    """The license that a template stands for, in whatever wording."""
    return template.partition("/")[0].removesuffix("-short")


def _rising(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    behind = [-1] * len(values)
    for i, v in enumerate(values):
        at = int(np.searchsorted(tops, v))
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
        behind[i] = piles[at - 1] if at else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = behind[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched (index in a, index in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        place_a: dict = {}
        for i in range(a0, a1):
            place_a[a[i]] = -1 if a[i] in place_a else i
        place_b: dict = {}
        for j in range(b0, b1):
            place_b[b[j]] = -1 if b[j] in place_b else j
        both = [(i, place_b[w]) for w, i in place_a.items() if i >= 0 and place_b.get(w, -1) >= 0]
        both.sort()
        anchors = [both[k] for k in _rising([j for _, j in both])]
        if anchors:
            out += anchors
            marks = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(marks, marks[1:])]
            continue
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
    return sorted(out)


def _need(n: int) -> int:
    """Adjacent pairs that a matching place surely shares with a template of ``n`` words."""
    missing = n - int(np.ceil(COVERAGE * n - 1e-9))
    return max(1, n - 1 - 2 * missing - int(n / COVERAGE - n))


def _compact(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The alignment without outlying ends: matched words make ``COVERAGE`` of their span."""
    lo, hi = 0, len(pairs) - 1
    while lo < hi and hi - lo + 1 < COVERAGE * (pairs[hi][0] - pairs[lo][0] + 1):
        if pairs[lo + 1][0] - pairs[lo][0] >= pairs[hi][0] - pairs[hi - 1][0]:
            lo += 1
        else:
            hi -= 1
    return pairs[lo:hi + 1]


def _hashes(texts: list[str]) -> tuple[Words, list[list[int]]]:
    """Words of the texts and their hashes by text."""
    data = [t.encode() for t in texts]
    w = Words(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64), LETTERS)
    return w, [w.hash[w.first[k]:w.first[k + 1]].tolist() for k in range(len(data))]


class _Scanner:
    def __init__(self, templates: dict[str, str], marks: dict[str, str]):
        self.names = list(templates)
        data = list(templates)
        w, self.words = _hashes(list(templates.values()))
        self.marks = [set(x) for x in _hashes([marks.get(name, "") for name in data])[1]]
        self.qualifiers = set(_hashes([QUALIFIERS])[1][0])
        at, pair = self.pairs(w)
        self.keys = np.unique(pair)
        #: Place of each pair in each template, -1 where it has none.
        self.place = np.full((len(self.keys), len(data)), -1, np.int64)
        for i, p in zip(at[::-1], pair[::-1]):
            self.place[int(np.searchsorted(self.keys, p)), int(w.row[i])] = int(i - w.first[w.row[i]])

    @staticmethod
    def pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(w.row[1:] == w.row[:-1]) if len(w.row) else np.zeros(0, np.int64)
        return at, mix(w.hash[at] * np.uint64(0x9E3779B97F4A7C15) + w.hash[at + 1])

    def same(self, place: list[int], pairs: list[tuple[int, int]], k: int) -> bool:
        """Whether the matched words have what tells template ``k`` from other licenses."""
        matched = {i for i, _ in pairs}
        foreign = {place[i] for i in range(pairs[0][0], pairs[-1][0]) if i not in matched}
        return self.marks[k] <= {place[i] for i in matched} and not foreign & self.qualifiers

    def best(self, w: Words) -> list[tuple[int, str, int, int, float]]:
        """``matches`` without places that overlap a better one of any template."""
        size = {name: len(x) for name, x in zip(self.names, self.words)}
        out: dict[int, list[tuple[int, str, int, int, float]]] = {}
        for m in sorted(self.matches(w), key=lambda m: (-round(m[4] * size[m[1]]), -m[4], m[3] - m[2], m[2], m[1])):
            kept = out.setdefault(m[0], [])
            if all(m[3] <= x[2] or x[3] <= m[2] for x in kept):
                kept.append(m)
        return [m for kept in out.values() for m in kept]

    def matches(self, w: Words) -> Iterator[tuple[int, str, int, int, float]]:
        """(row, license, first word, word behind the last, coverage)."""
        at, pair = self.pairs(w)
        found = lookup(self.keys, pair)
        hit, place = at[found >= 0], self.place[found[found >= 0]]
        for k, name in enumerate(self.names):
            here = hit[place[:, k] >= 0]
            n, template = len(self.words[k]), self.words[k]
            if n == 1 or not len(here):
                continue
            reach, slack = int(np.ceil(n / COVERAGE)), int(np.ceil(n / COVERAGE)) - n + 1
            within = np.searchsorted(here, here + reach) - np.arange(len(here))
            behind = 0
            for i in np.flatnonzero(within >= _need(n)):
                p = int(here[i])
                if p < behind:
                    continue
                row = int(w.row[p])
                begin = p - int(place[np.searchsorted(hit, p), k])
                lo = max(int(w.first[row]), begin - slack, behind)
                hi = min(int(w.first[row + 1]), begin + n + slack)
                pairs = align(w.hash[lo:hi].tolist(), template)
                pairs = _compact(pairs) if pairs else []
                if len(pairs) >= COVERAGE * n and self.same(w.hash[lo:hi].tolist(), pairs, k):
                    behind = lo + pairs[-1][0] + 1
                    yield row, name, lo + pairs[0][0], behind, len(pairs) / n


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         marks: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` plus an array of (license, start, end, coverage), characters [start, end); and its name."""
    name = free_name(docs.columns, "licenses")
    match = T.StructType([T.StructField("license", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
                          T.StructField("end", T.IntegerType(), False), T.StructField("coverage", T.DoubleType(), False)])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(match, False), False)])
    where = docs.columns.index(text)
    table = dict(templates or TEMPLATES)
    needed = dict(marks or {}) if templates else dict(MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(table, needed)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for at, _, w in word_slices(batch.column(where), LETTERS):
                for row, license_, lo, hi, coverage in scanner.best(w):
                    base = int(w.offsets[row])
                    chars = [int(np.count_nonzero((w.raw[base:x] & 0xC0) != 0x80)) for x in (int(w.start[lo]), int(w.end[hi - 1]))]
                    found[at + row].append({"license": license_of(license_), "start": chars[0], "end": chars[1], "coverage": coverage})
            for x in found:
                x.sort(key=lambda m: (m["start"], m["license"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=schema.names)

    return docs.mapInArrow(run, schema), name


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, number of matches, licenses found (sorted, comma-joined), best coverage, matched characters."""
    out, name = scan(docs.select("doc_id", "text"))
    found = F.col(name)
    return out.select("doc_id", F.size(found).cast("long").alias("n_matches"),
                      F.array_join(F.array_sort(F.array_distinct(found["license"])), ",").alias("licenses"),
                      F.coalesce(F.array_max(found["coverage"]), F.lit(0.0)).alias("best_coverage"),
                      F.aggregate(found, F.lit(0).cast("long"), lambda a, m: a + m["end"] - m["start"]).alias("matched_chars"))
