"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from salesmart.plans.oracle import ORACLE
from salesmart.plans.queries import QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["mes", "vlr_vendido"]
    assert df.count() > 0


def test_comment_coverage(spark):
    rows = {r.tabela: r for r in entry.queries()["comment_coverage"](spark, SF).collect()}
    assert set(rows) == {"fato_pedido_venda", "dim_cliente", "dim_vendedor", "dim_produto", "dim_unidade",
                         "dim_calendario"}
    assert all(r.com_descricao and r.colunas == r.colunas_descritas for r in rows.values())
