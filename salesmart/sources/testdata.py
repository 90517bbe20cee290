"""Role mapping of the TPC-H-like test tables onto the ERP sales domain.

Each function returns a Bronze-shaped frame (source columns plus the change
tracking columns ``_empresa d_e_l_e_t_ r_e_c_n_o_ s_t_a_m_p_ _lote``) so the
operators run on the test tables exactly as on ERP extracts.  This is our own
design, not source-system data:

* one company ``01``; branch = the customer's nation (two digits);
* orders = order headers, ``o_orderstatus = 'F'`` marks a logically deleted header;
* lineitem = order items, several versions per (order, line); the record id is
  ``l_orderkey * 100 + l_linenumber``; the version stamp is the ship date;
  delivered quantity: return flag R -> all, A -> 1, N -> 0; unit price =
  extended price; total = quantity x price net of discount;
* customer / supplier / part = customer / seller / product; a customer with a
  negative balance is blocked, a supplier with a negative balance is deleted;
* nation (+ region) = business units;
* events = a change stream: company = event type, batch = day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BATCH_FORMAT, DELETED_MARKER
from ..functions.conversions import MONEY

COMPANY = "01"
SNAPSHOT_BATCH = "20010801T000000Z"     # the one FULL extract of the master tables

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def two_digits(col: str) -> Column:
    return F.lpad(F.col(col).cast("string"), 2, "0")


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(DELETED_MARKER)).otherwise(F.lit(" "))


def _batch_of(ts: Column) -> Column:
    return F.date_format(ts, BATCH_FORMAT)


# Mappings of the test tables (same shape as config.ERP_MAPPINGS).
ORDER_MAP = {
    "c5_filial": ("cod_filial", "texto"),
    "o_orderkey": ("cod_pedido", "texto"),
    "o_orderpriority": ("des_tipo", "texto"),
    "o_custkey": ("cod_cliente", "texto"),
    "c5_lojacli": ("cod_loja", "texto"),
    "o_orderdate": ("dat_emissao", "data"),
    "c5_nota": ("num_nota", "texto"),
}
LINE_MAP = {
    "l_orderkey": ("cod_pedido", "texto"),
    "l_linenumber": ("cod_item", "texto"),
    "l_partkey": ("cod_produto", "texto"),
    "l_suppkey": ("cod_vendedor", "texto"),
    "l_quantity": ("qtd_vendida", "decimal"),
    "c6_prcven": ("vlr_unitario", "decimal"),
    "c6_valor": ("vlr_total", "decimal"),
    "c6_qtdent": ("qtd_entregue", "decimal"),
    "l_returnflag": ("num_nota", "texto"),
}
CUSTOMER_MAP = {
    "c_custkey": ("cod_cliente", "texto"),
    "a1_loja": ("cod_loja", "texto"),
    "c_name": ("des_nome", "texto"),
    "c_mktsegment": ("des_nome_reduzido", "texto"),
    "a1_est": ("sig_uf", "texto"),
    "c_mktsegment_": ("des_municipio", "texto"),
    "a1_vend": ("cod_vendedor", "texto"),
    "a1_msblql": ("flg_bloqueado", "bloqueio"),
}
SELLER_MAP = {
    "s_suppkey": ("cod_vendedor", "texto"),
    "s_name": ("des_nome", "texto"),
}
PRODUCT_MAP = {
    "p_partkey": ("cod_produto", "texto"),
    "p_name": ("des_produto", "texto"),
    "p_type": ("des_tipo", "texto"),
    "b1_um": ("des_unidade_medida", "texto"),
    "p_brand": ("cod_grupo", "texto"),
    "p_retailprice": ("vlr_preco_venda", "decimal"),
}
# The fact of the test tables joins on the order only; branch, date and customer
# come from the header and the seller from the item (suppliers are per line).
FACT_KEYS = ("cod_empresa", "cod_pedido")
FACT_HEADER_COLUMNS = ("cod_filial", "dat_emissao", "cod_cliente", "cod_loja")
# Version order of the line items: no two versions of a line tie on it.
LINE_VERSION_ORDER = ("dat_stamp", "_lote", "cod_produto", "cod_vendedor")


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
    return joined.select(
        "o_orderkey", "o_orderpriority", "o_custkey", "o_orderdate",
        two_digits("c_nationkey").alias("c5_filial"),
        F.lit("01").alias("c5_lojacli"),
        F.lit("         ").alias("c5_nota"),
        F.lit(COMPANY).alias("_empresa"),
        _flag(F.col("o_orderstatus") == "F").alias("d_e_l_e_t_"),
        F.col("o_orderkey").alias("r_e_c_n_o_"),
        F.col("o_orderdate").alias("s_t_a_m_p_"),
        _batch_of(F.col("o_orderdate")).alias("_lote"),
    )


def line_record_id() -> Column:
    return F.col("l_orderkey") * F.lit(100) + F.col("l_linenumber")


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast(MONEY)
    price = F.col("l_extendedprice").cast(MONEY)
    gross = qty * price
    net = gross - (gross * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)
    delivered = (F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
                 .when(F.col("l_returnflag") == "A", F.lit(1.0))
                 .otherwise(F.lit(0.0)))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        price.alias("c6_prcven"),
        net.cast(MONEY).alias("c6_valor"),
        delivered.alias("c6_qtdent"),
        F.lit(COMPANY).alias("_empresa"),
        F.lit(" ").alias("d_e_l_e_t_"),
        line_record_id().alias("r_e_c_n_o_"),
        F.col("l_shipdate").alias("s_t_a_m_p_"),
        _batch_of(F.col("l_shipdate")).alias("_lote"),
    )


def _snapshot_columns(deleted: Column | None = None) -> list[Column]:
    return [
        F.lit(COMPANY).alias("_empresa"),
        (deleted if deleted is not None else F.lit(" ")).alias("d_e_l_e_t_"),
        F.lit(None).cast("timestamp").alias("s_t_a_m_p_"),
        F.lit(SNAPSHOT_BATCH).alias("_lote"),
    ]


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.col("c_mktsegment").alias("c_mktsegment_"),
        F.lit("01").alias("a1_loja"),
        two_digits("c_nationkey").alias("a1_est"),
        F.lit("").alias("a1_vend"),
        F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.lit("2")).alias("a1_msblql"),
        F.col("c_custkey").alias("r_e_c_n_o_"),
        *_snapshot_columns(),
    )


def bronze_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    return s.select(
        "s_suppkey", "s_name",
        F.col("s_suppkey").alias("r_e_c_n_o_"),
        *_snapshot_columns(_flag(F.col("s_acctbal") < 0)),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(
        "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice",
        F.lit("UN").alias("b1_um"),
        F.col("p_partkey").alias("r_e_c_n_o_"),
        *_snapshot_columns(),
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business units: one per nation, named after the nation and its region."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.lit(COMPANY).alias("cod_empresa"),
        two_digits("n_nationkey").alias("cod_filial"),
        F.concat_ws(" / ", F.col("r_name"), F.col("n_name")).alias("des_unidade"),
    )


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an ERP-like change stream: company = type, batch = day."""
    e = read(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "ts", "event_type", "value", "props",
        F.col("event_type").alias("_empresa"),
        F.date_format("ts", "yyyyMMdd").alias("_lote"),
    )
