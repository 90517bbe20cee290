"""Registered llm queries: the SQL oracle, and the pipeline against plain Python over the whole smallest tables."""

import re

import duckdb
import numpy as np
import pytest
from brute import contamination, near_classes

import __spark_entry__ as entry
import corpus_pipeline
from salesmart.llm import toxicity
from salesmart.llm.queries import ORACLE, QUERIES
from tools.compare import digest

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    res = con.execute(ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([c[0] for c in res.description], res.fetchall())[0]


def test_pipeline_against_plain_python(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored, name = toxicity.score(docs, model)
    clean = sorted((r.doc_id, r.text) for r in scored.where(f"{name} < 0.5").collect())
    first = {}
    for (i, _), c in zip(clean, near_classes([t for _, t in clean])):
        first.setdefault(c, i)
    want = set()
    for i, t in clean:
        if i in first.values():
            words, hit, _ = contamination(t, [(x.item_id, x.text) for x in items])
            if not (hit and 20 * hit >= words):
                want.add(i)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in rows)
