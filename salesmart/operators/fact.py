"""The order fact at order-item grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FACT_HEADER_COLUMNS, FACT_KEYS, STATUS_INVOICED, STATUS_OPEN, STATUS_PARTIAL
from ..functions.conversions import MONEY
from .versions import sort_keys

FACT_COLUMNS = [
    "cod_empresa", "cod_filial", "cod_pedido", "cod_item", "dat_emissao", "cod_cliente", "cod_loja",
    "cod_vendedor", "cod_produto", "qtd_vendida", "qtd_entregue", "qtd_saldo", "vlr_unitario", "vlr_total",
    "vlr_saldo", "des_status", "dat_atualizacao",
]


def live(df: DataFrame, flag: str = "flg_deletado") -> DataFrame:
    """G1: rows not logically deleted; a NULL flag drops the row too."""
    return df.filter(~F.col(flag))


def open_quantity() -> Column:
    return F.col("qtd_vendida") - F.col("qtd_entregue")


def item_status(balance: Column) -> Column:
    """Invoiced when nothing is open, partial when something was delivered, else open."""
    return (F.when(balance <= 0, F.lit(STATUS_INVOICED))
            .when(F.col("qtd_entregue") > 0, F.lit(STATUS_PARTIAL))
            .otherwise(F.lit(STATUS_OPEN)))


def order_fact(headers: DataFrame, items: DataFrame, keys: Sequence[str] = FACT_KEYS,
               header_columns: Sequence[str] = FACT_HEADER_COLUMNS, loaded_at=None) -> DataFrame:
    """Live items INNER JOIN live headers on ``keys``.

    ``header_columns`` are the attributes taken from the header; every other
    fact column comes from the item.  ``loaded_at`` fixes the load timestamp
    (a literal or Column); by default it is the query's current timestamp.
    """
    keys = sort_keys(items, keys)
    heads = live(headers).select(*keys, *header_columns)
    fact = live(items).join(heads, keys, "inner")
    balance = open_quantity()
    if loaded_at is None:
        stamp = F.current_timestamp()
    elif isinstance(loaded_at, Column):
        stamp = loaded_at
    else:
        stamp = F.lit(loaded_at).cast("timestamp")
    derived = {
        "qtd_saldo": balance.cast(MONEY),
        "vlr_saldo": (balance * F.col("vlr_unitario")).cast(MONEY),
        "des_status": item_status(balance),
        "dat_atualizacao": stamp,
    }
    return fact.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS])
