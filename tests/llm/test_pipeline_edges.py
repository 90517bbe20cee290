"""Each stage of the corpus pipeline on nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

import pytest

import corpus_pipeline

CLEAN = "the quick words of a plain text that nobody minds, number "
ROWS = [(None, None), (None, ""), (1, None), (1, ""), (2, CLEAN + "two and more of it here"), (2, CLEAN + "two and more of it here"),
        (None, CLEAN + "two and more of it here"), (3, CLEAN + "three with other ends entirely, as can be seen by all"), (4, "one"), (5, "\x00 \t\n"),
        (6, " ".join(f"w{i}" for i in range(60000))), (7, "Mr. John Smith wrote to jo@mail.example, then John left"), (8, "中文 слова ñandú \U0001F600"),
        (9, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi")]
EXTRA = ["n_words", "items", "toxicity", "Rid", "n_entities", "ids", "_row_of_scan", "TOKENS", "class"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("edges"))
    docs = spark.createDataFrame([(i, t, len(t or ""), *["x"] * len(EXTRA)) for i, t in ROWS],
                                 "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA))
    docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(3, 0, 0), (9, 1, 1), (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    items = [("a", " ".join(ROWS[-1][1].split()[:13])), (None, None), ("b", ""), ("b", "one two")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_edge_cases(spark, tables, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = stage(spark, docs, tables)
    rows = out.collect()
    if name == "bpe":
        assert out.columns == ["doc_id", "n_tokens", "ids"] and len(rows) == len(ROWS)
    else:
        assert out.schema == docs.schema
        got, want = sorted((str(r.doc_id), r.text or "-") for r in rows), sorted((str(i), t or "-") for i, t in ROWS)
        if name == "toxicity":
            assert got == want                      # nothing to learn from: no document goes
        elif name == "decontamination":
            assert [x for x in want if x not in got] == [("9", ROWS[-1][1])] and len(got) == len(want) - 1
        elif name == "near_dedup":
            # null and empty texts are one class, the repeated text another; the smallest id stays
            assert len(got) == len(want) - 5 and ("2", ROWS[4][1]) in got and ("None", ROWS[4][1]) not in got
        else:
            assert len(got) == len(want) and sum(x not in got for x in want) == 1
            changed = next(r for r in rows if r.doc_id == 7)
            assert "Smith" not in changed.text and "John" not in changed.text and changed.n_chars == len(changed.text)
    assert stage(spark, docs.limit(0), tables).count() == 0


def test_run_on_edge_cases_and_on_empty_tables(spark, tables, tmp_path):
    assert corpus_pipeline.run(spark, tables).count() == len(ROWS) - 6
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
