"""V1-V7: the commercial dashboard's dataset and measures.

The dataset (V1) is the fact INNER JOIN unit, LEFT JOIN product, seller and
customer.  Measures keep every join of the dataset, because a repeated dimension key
repeats fact rows in it.  Joins are unhinted: AQE broadcasts a dimension by its
measured size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import REFRESH_FORMAT

TOTAL = "decimal(38,2)"

# dimension -> (join keys, {output column: dimension column})
_LEFT_DIMS = {
    "product": (["cod_empresa", "cod_produto"], {"des_produto": "des_produto"}),
    "seller": (["cod_empresa", "cod_vendedor"], {"des_vendedor": "des_nome"}),
    "customer": (["cod_empresa", "cod_cliente", "cod_loja"], {"des_cliente": "des_nome"}),
}
DATASET_COLUMNS = ["dat_emissao", "des_status", "vlr_total", "vlr_saldo", "qtd_vendida", "des_unidade",
                   "des_produto", "des_vendedor", "des_cliente"]


@dataclass
class SalesStar:
    fact: DataFrame
    unit: DataFrame
    product: DataFrame
    seller: DataFrame
    customer: DataFrame

    def _dim(self, name: str) -> DataFrame:
        return getattr(self, name)

    def dataset(self, columns: list[str] | None = None) -> DataFrame:
        """V1 restricted to ``columns`` (all nine by default)."""
        wanted = list(columns or DATASET_COLUMNS)
        unit = self.unit.select("cod_empresa", "cod_filial", "des_unidade")
        df = self.fact.join(unit, ["cod_empresa", "cod_filial"], "inner")
        # Every join stays, also where no column is wanted: a repeated dimension key repeats fact rows.
        for name, (keys, outputs) in _LEFT_DIMS.items():
            dim = self._dim(name).select(*keys, *[F.col(src).alias(dst) for dst, src in outputs.items()])
            df = df.join(dim, keys, "left")
        return df.select(*wanted)

    # V2
    def last_refresh(self) -> DataFrame:
        return self.fact.agg(
            F.date_format(F.max("dat_atualizacao"), REFRESH_FORMAT).alias("des_ultima_carga"))

    # V3
    def value_sold(self) -> DataFrame:
        return self.dataset(["vlr_total"]).agg(F.sum("vlr_total").cast(TOTAL).alias("vlr_vendido"))

    # V4
    def open_value(self) -> DataFrame:
        return self.dataset(["vlr_saldo"]).agg(F.sum("vlr_saldo").cast(TOTAL).alias("vlr_carteira"))

    # V5
    def sales_by_month(self) -> DataFrame:
        month = F.date_trunc("MONTH", F.col("dat_emissao")).cast("date")
        return (self.dataset(["dat_emissao", "vlr_total"])
                .groupBy(month.alias("mes"))
                .agg(F.sum("vlr_total").cast(TOTAL).alias("vlr_vendido")))

    # V6
    def sales_by_unit(self) -> DataFrame:
        return (self.dataset(["des_unidade", "vlr_total"])
                .groupBy("des_unidade")
                .agg(F.sum("vlr_total").cast(TOTAL).alias("vlr_vendido")))

    # V7
    def open_by_seller(self) -> DataFrame:
        return (self.dataset(["des_vendedor", "vlr_saldo"])
                .groupBy("des_vendedor")
                .agg(F.sum("vlr_saldo").cast(TOTAL).alias("vlr_carteira")))
