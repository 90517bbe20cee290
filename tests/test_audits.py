from decimal import Decimal

from salesmart.operators import audits
from salesmart.functions.taxid import tax_id_is_valid


def test_item_value_half_up(spark):
    df = spark.createDataFrame([(Decimal("3.00"), Decimal("1.335"), Decimal("4.01")),
                                (Decimal("3.00"), Decimal("1.335"), Decimal("4.00"))],
                               "qtd_vendida decimal(14,2), vlr_unitario decimal(14,3), vlr_total decimal(14,2)")
    r = audits.item_value_audit(df).first()
    assert r.qtd_itens == 2 and r.qtd_divergentes == 1
    assert audits.item_value_mismatches(df).first().vlr_total == Decimal("4.00")


def test_tax_id(spark):
    df = spark.createDataFrame([("11222333000181",), ("11222333000182",), ("1122233300018",), ("abcdefghijklmn",),
                                (None,)], "doc string")
    got = [r.ok for r in df.select(tax_id_is_valid("doc").alias("ok")).collect()]
    assert got == [True, False, False, False, False]
    r = audits.tax_id_audit(df, "doc").first()
    assert (r.qtd_documentos, r.qtd_formato_ok, r.qtd_validos) == (4, 2, 1)


def test_silver_carries_no_document_column():
    assert audits.silver_document_columns() == []
