"""The corpus pipeline: toxicity, near-dedup, decontamination, surrogates, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next stage's ``docs``.  All stages but the last return the columns of ``documents``.

Edge cases: null and empty texts pass every filter, except that equal ones are near copies of each other;
rows may repeat, also with equal or null ids, and of copies the one with the smallest id stays; very long texts pass whole;
further columns are carried along, whatever their names (the last stage returns doc_id, n_tokens and ids);
without usable labels no document is toxic, without benchmark items none is contaminated; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bagminhash, bpe, decontaminate, pii, toxicity
from salesmart.llm.common import small_arrow_batches, stage
from salesmart.llm.settings import PII_KEY, tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below a half by models fitted on the labelled rows of the table."""
    small_arrow_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    small_arrow_batches(spark)
    return bagminhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    small_arrow_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return pii.replace(docs, PII_KEY)[0].select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens and packed ids (little-endian unsigned 32-bit) of all documents."""
    small_arrow_batches(spark)
    tokens, names = bpe.encode(docs.select("doc_id", "text"), tokenizer_path(), drop_text=True)
    ids = F.col(names["ids"])
    return tokens.select("doc_id", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [("toxicity", toxicity_stage), ("near_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("pii", pii_stage), ("bpe", bpe_stage)]

#: No stage but decontamination can be expressed in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
