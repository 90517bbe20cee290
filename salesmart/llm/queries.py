"""Registered queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import (bagminhash, bpe, decontaminate, eod_counts, gru_lm, hard_negatives, html_blocks, license_scan, pii, pstable,
                           quality_rules, spelling, toxicity)
from salesmart.llm.common import small_arrow_batches
from salesmart.llm.settings import PII_KEY, tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(_table(spark, sf_dir, "documents"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"), PII_KEY)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.digest(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.digest(_table(spark, sf_dir, "documents"))


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.digest(_table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_eod_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eod_counts.digest(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(_table(spark, sf_dir, "documents"))


def op12_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.digest(_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(_table(spark, sf_dir, "embeddings"))


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_arrow_batches(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _prepared(f) for f in (op1_license_scan, op2_surrogates, op3_toxicity, op4_gru_lm, op5_quality_rules, op6_bpe, op7_bagminhash, op8_html_blocks, op9_decontaminate, op10_eod_counts,
                                       op11_spelling, op12_pstable, op13_hard_negatives)}

ORACLE: dict[str, str] = {"op5_quality_rules": quality_rules.ORACLE, "op9_decontaminate": decontaminate.ORACLE, "op12_pstable": pstable.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
