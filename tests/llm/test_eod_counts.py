import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from salesmart.llm import eod_counts as e

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_query_against_the_encoder(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(None, None), (-1, ""), (-2, " "), (-2, "same"), (-2, "same"), (-3, "a </s> <s> \x02\x00 b"), (-4, "long " * 20000)]
    docs.unionAll(spark.createDataFrame(odd, docs.schema)).repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    encode = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode
    got = sorted((r.doc_id or 0, r.n_tokens) for r in e.digest(docs, MODEL).collect())
    assert got == sorted((r.doc_id or 0, len(encode(r.text or ""))) for r in docs.collect())
    assert e.digest(docs.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    want = set()
    for k, n in enumerate((0, 1, 40, 300)):
        ids = rng.choice([2, 5, 512, 2 * 256], n, p=[0.2, 0.4, 0.2, 0.2]).astype("<u2")
        (tmp_path / f"f{k}.bin").write_bytes(ids.tobytes())
        at = 0
        ends = np.flatnonzero(ids == 2)
        for j, x in enumerate(ends):
            want.add((f"f{k}", j, int(x) - at, True))
            at = int(x) + 1
        if at < n:
            want.add((f"f{k}", len(ends), n - at, False))
    got = {(r.file.rsplit("/", 1)[1][:2], r.ordinal, r.n_tokens, r.ended) for r in e.scan(spark, str(tmp_path), block=block).collect()}
    assert got == want


def test_a_document_over_many_blocks_and_separators_only(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(np.array([2, 2] + [7] * 50 + [2, 2], "<u2").tobytes())
    assert [r.n_tokens for r in e.scan(spark, str(tmp_path), block=8).orderBy("ordinal").collect()] == [0, 0, 50, 0]
