"""Table-wide audits of two per-row business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ERP_MAPPINGS
from ..functions.taxid import tax_id_is_valid


def item_value_mismatches(items: DataFrame, qty: str = "qtd_vendida", price: str = "vlr_unitario",
                          total: str = "vlr_total") -> DataFrame:
    """R1 rows: items whose total differs from quantity x price rounded HALF_UP to cents."""
    expected = F.round(F.col(qty) * F.col(price), 2)
    return items.filter(F.col(total) != expected)


def item_value_audit(items: DataFrame, qty: str = "qtd_vendida", price: str = "vlr_unitario",
                     total: str = "vlr_total") -> DataFrame:
    """R1 summary in one scan: items checked and items whose total is off."""
    expected = F.round(F.col(qty) * F.col(price), 2)
    return items.agg(
        F.count(F.lit(1)).alias("qtd_itens"),
        F.count(F.when(F.col(total) != expected, 1)).alias("qtd_divergentes"),
        F.coalesce(F.sum(F.when(F.col(total) != expected, F.col(total) - expected)),
                   F.lit(0)).cast("decimal(38,2)").alias("vlr_diferenca"))


def tax_id_audit(df: DataFrame, column: str) -> DataFrame:
    """R2 in one scan: documents seen, well-formed ones and ones with valid check digits."""
    valid = tax_id_is_valid(column)
    return df.agg(
        F.count(F.col(column)).alias("qtd_documentos"),
        F.count(F.when(F.col(column).rlike(r"^[0-9]{14}$"), 1)).alias("qtd_formato_ok"),
        F.count(F.when(valid, 1)).alias("qtd_validos"))


def silver_document_columns(mappings: dict = ERP_MAPPINGS, document_columns=("a1_cgc",)) -> list[str]:
    """R2 privacy rule: source document columns that a Silver mapping would carry (must be empty)."""
    return [f"{t}.{c}" for t, m in mappings.items() for c in m if c in document_columns]
