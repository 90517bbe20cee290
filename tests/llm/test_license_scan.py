import random
import re

from brute import letters

from salesmart.llm import license_scan as ls

LINES = {"gpl-3.0": r"This work is licensed under the GNU General Public License, version 3\.", "cc-by-nc-4.0": r"Licensed under CC BY-NC 4\.0\.",
         "mit": r"Released under the MIT License\.", "apache-2.0": r"Licensed under the Apache License, Version 2\.0\."}


def found(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, Licenses string")
    out, name = ls.scan(docs, **options)
    assert name == "licenses_"
    return [[(m.license, r.text[m.start:m.end], round(m.coverage, 2)) for m in r[name]] for r in out.orderBy("doc_id").collect()]


def test_whole_table_against_the_lines_in_it(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: set(r.licenses.split(",")) - {""} for r in ls.digest(docs).collect()}
    want = {r.doc_id: {k for k, p in LINES.items() if re.search(p, r.text, re.I)} for r in docs.select("doc_id", "text").collect()}
    assert {i: g & set(LINES) for i, g in got.items()} == want and sum(map(bool, want.values())) > 5


def test_edited_repeated_and_partial_notices(spark):
    mit = ls.TEMPLATES["mit-text"]
    words = mit.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 9)
    strewn = " filler filler filler filler ".join(words)
    got = found(spark, [None, "", "!?", f"é {mit} tail", f"{mit} {mit}", edited, " ".join(words[:30]), strewn,
                        "x " * 5000 + "Released under the MIT License.", "released, under THE mit licence", "under the licensed version"])
    assert got[0] == got[1] == got[2] == got[6] == got[7] == got[10] == []
    assert [m[0] for m in got[3]] == ["mit-text"] and got[3][0][1] == mit.rstrip(".") and got[3][0][2] == 1.0
    assert [m[0] for m in got[4]] == ["mit-text"] * 2
    assert got[5][0][0] == "mit-text" and 0.8 < got[5][0][2] < 0.95
    assert got[8] == [("mit", "Released under the MIT License", 1.0)] and got[9] == [("mit", "released, under THE mit", 0.8)]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_alignment_is_a_common_subsequence_close_to_the_longest():
    rng = random.Random(4)
    for _ in range(50):
        b = letters(rng.choice(list(ls.TEMPLATES.values())))
        a = [w for w in b if rng.random() > 0.1]
        for _ in range(3):
            a.insert(rng.randrange(len(a)), "new")
        pairs = ls.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.9 * longest_common(a, b)


def test_empty_table(spark):
    assert ls.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_whole_license_set_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: set(r.licenses.split(",")) - {""} for r in ls.digest(docs).collect()}
    want = {r.doc_id: {k for k, p in LINES.items() if re.search(p, r.text, re.I)} for r in docs.select("doc_id", "text").collect()}
    assert got == want


def test_licenses_that_differ_by_a_word_are_told_apart(spark):
    gpl2 = ls.TEMPLATES["gpl-3.0-notice"].replace("version 3", "version 2")
    sentence = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    cases = {"Licensed under CC BY-NC 4.0.": ["cc-by-nc-4.0"], "Licensed under CC BY-SA 4.0.": ["cc-by-sa-4.0"], "Licensed under CC BY 4.0.": ["cc-by-4.0"],
             "Licensed under CC BY-NC-ND 4.0.": ["cc-by-nc-nd-4.0"], "Licensed under CC BY 2.5.": [], "Released under the BSD License": ["bsd"],
             "Released under the XYZ License": [], gpl2: ["gpl-2.0-notice"], ls.TEMPLATES["gpl-3.0-notice"]: ["gpl-3.0-notice"],
             sentence.format(""): ["cc-by-4.0"], sentence.format("-NonCommercial"): ["cc-by-nc-4.0"],
             sentence.format("-NonCommercial-ShareAlike"): ["cc-by-nc-sa-4.0"], ls.TEMPLATES["apache-2.0-notice"]: ["apache-2.0-notice"],
             "This work is licensed under the GNU Lesser General Public License, version 3.": ["lgpl-3.0"],
             "Licensed under the Apache License, Version 1.1.": [],
             "Released under the MIT License. Licensed under CC BY 4.0.": ["mit", "cc-by-4.0"]}
    assert [[m[0] for m in g] for g in found(spark, list(cases))] == list(cases.values())


def test_identifiers_short_forms_and_clauses(spark):
    cases = {"# SPDX-License-Identifier: MIT": ["mit"], "SPDX-License-Identifier: GPL-2.0-or-later": ["gpl-2.0"], "SPDX-License-Identifier: XYZ-1": [],
             "SPDX-License-Identifier: BSD-3-Clause": ["bsd-3-clause"], "SPDX-License-Identifier: LGPL-2.1-only": ["lgpl-2.1"],
             "SPDX-License-Identifier: CC-BY-NC-SA-4.0": ["cc-by-nc-sa-4.0"], "SPDX-License-Identifier: AGPL-3.0": ["agpl-3.0"],
             "Released under the GPL v3": ["gpl-3.0"], "Released under the GPLv2 license.": ["gpl-2.0"], "released under the LGPL v2.1": ["lgpl-2.1"],
             "Released under the GPL v4": [], "GNU Affero General Public License v3": ["agpl-3.0"], "the GNU General Public License v2 applies": ["gpl-2.0"],
             "photo: CC BY-SA 3.0": ["cc-by-sa-3.0"], "CC BY 2.5": [], "BSD 2-Clause License": ["bsd-2-clause"], "the BSD 3-Clause": ["bsd-3-clause"],
             "Released under the BSD 3-Clause License.": ["bsd-3-clause"], "Released under the BSD License.": ["bsd"], "clause 3 of the license": [],
             "a license by nature": []}
    assert {t: [m[0] for m in g] for t, g in zip(cases, found(spark, list(cases)))} == cases


def test_null_ids_repeated_rows_and_very_long_texts(spark):
    long_text = "filler words " * 100000 + "Released under the MIT License. " + "more words " * 100000
    rows = [(None, "SPDX-License-Identifier: MIT"), (None, "SPDX-License-Identifier: MIT"), (1, long_text), (1, "nothing")]
    got = ls.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_matches, r.licenses) for r in got) == [(0, 1, "mit"), (0, 1, "mit"), (1, 0, ""), (1, 1, "mit")]


def test_every_template_is_found_as_itself_only(spark):
    got = found(spark, list(ls.TEMPLATES.values()))
    assert [[m[0] for m in g] for g in got] == [[ls.license_of(name)] for name in ls.TEMPLATES]
