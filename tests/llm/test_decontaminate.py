from brute import contamination, sha

from salesmart.llm import decontaminate

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards brew strong coffee at dawn"


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_whole_table_against_brute_force(spark):
    base = "/root/testdata/sf0.001"
    docs, tests = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in tests.collect()]
    got = {r.doc_id: r for r in decontaminate.digest(docs, tests).collect()}
    for r in docs.collect():
        words, hit, found = contamination(r.text, items)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.items_sha256) == (words, hit, len(found), sha(",".join(found)))
        assert g.contaminated == (hit > 0 and 20 * hit >= words)


def test_edges_blocks_and_clashing_columns(spark):
    items = [(1, ITEM), (2, "Short  item"), (2, "short, ITEM"), (None, "lonely"), (4, None), (5, "..."), (6, ITEM.upper())]
    tests = docs_of(spark, items, "item_id long, text string")
    texts = [ITEM, ITEM.lower() + " tail", "a short item, b", "lonely", None, "", "?!", "x " * 3000 + ITEM, ITEM, "other words",
             "é" * 5 + " short item é " + "many " * 60]
    docs = docs_of(spark, [(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, N_words string")
    for block in (1 << 20, 40):
        marked, names = decontaminate.scan(docs, tests, block_bytes=block)
        assert names["n_words"] == "n_words_"
        got = {r.doc_id: r for r in marked.collect()}
        for i, t in enumerate(texts):
            assert (got[i][names["n_words"]], got[i].n_hit, got[i]["items"]) == contamination(t, items), (i, block)
            assert got[i].N_words == "kept"
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, tests).collect()} == {4, 5, 6, 7, 9, 10}
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, tests).collect()}
    assert cut[2] == "a , b" and cut[0] == "" and cut[10].startswith("é" * 5 + "  é many") and cut[4] is None


def test_empty_tables(spark):
    tests, docs = docs_of(spark, [(1, ITEM)], "item_id long, text string"), docs_of(spark, [(1, ITEM)])
    assert decontaminate.digest(docs, tests.limit(0)).collect()[0].n_hit == 0
    assert decontaminate.digest(docs.limit(0), tests).count() == 0
