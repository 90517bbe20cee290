"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code from the query semantics: the same
role mapping (``sources.testdata``), the window form of the original pipeline for latest
versions, the full dashboard join for the measures.  Tables are the
pre-registered views of the test parquet files.
"""

from __future__ import annotations

from ..config import MONTH_NAMES, TAX_ID_WEIGHTS_1, TAX_ID_WEIGHTS_2

MONEY = "DECIMAL(14,2)"
LOAD_TS = "TIMESTAMP '2001-08-02 06:00:00'"

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "bronze_orders": ([], f"""
        SELECT o.o_orderkey, o.o_orderpriority, o.o_custkey, o.o_orderdate,
               lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS c5_filial,
               '01' AS c5_lojacli, '         ' AS c5_nota, '01' AS _empresa,
               CASE WHEN o.o_orderstatus = 'F' THEN '*' ELSE ' ' END AS d_e_l_e_t_,
               o.o_orderkey AS r_e_c_n_o_, o.o_orderdate AS s_t_a_m_p_,
               strftime(o.o_orderdate, '%Y%m%dT%H%M%SZ') AS _lote
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "silver_orders": (["bronze_orders"], """
        SELECT trim(_empresa) AS cod_empresa, trim(c5_filial) AS cod_filial,
               trim(CAST(o_orderkey AS VARCHAR)) AS cod_pedido, trim(o_orderpriority) AS des_tipo,
               trim(CAST(o_custkey AS VARCHAR)) AS cod_cliente, trim(c5_lojacli) AS cod_loja,
               CAST(o_orderdate AS DATE) AS dat_emissao, trim(c5_nota) AS num_nota,
               trim(d_e_l_e_t_) = '*' AS flg_deletado, CAST(r_e_c_n_o_ AS BIGINT) AS num_recno,
               CAST(s_t_a_m_p_ AS TIMESTAMP) AS dat_stamp, _lote
        FROM bronze_orders"""),
    "bronze_lines": ([], f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
               CAST(l_extendedprice AS {MONEY}) AS c6_prcven,
               CAST(CAST(l_quantity AS {MONEY}) * CAST(l_extendedprice AS {MONEY})
                    - CAST(CAST(l_quantity AS {MONEY}) * CAST(l_extendedprice AS {MONEY})
                           * CAST(l_discount AS DECIMAL(4,2)) AS {MONEY}) AS {MONEY}) AS c6_valor,
               CASE WHEN l_returnflag = 'R' THEN l_quantity WHEN l_returnflag = 'A' THEN 1.0::DOUBLE
                    ELSE 0.0::DOUBLE END AS c6_qtdent,
               '01' AS _empresa, ' ' AS d_e_l_e_t_,
               l_orderkey * 100 + l_linenumber AS r_e_c_n_o_,
               l_shipdate AS s_t_a_m_p_, strftime(l_shipdate, '%Y%m%dT%H%M%SZ') AS _lote
        FROM lineitem"""),
    "std_lines": (["bronze_lines"], f"""
        SELECT trim(_empresa) AS cod_empresa,
               trim(CAST(l_orderkey AS VARCHAR)) AS cod_pedido, trim(CAST(l_linenumber AS VARCHAR)) AS cod_item,
               trim(CAST(l_partkey AS VARCHAR)) AS cod_produto, trim(CAST(l_suppkey AS VARCHAR)) AS cod_vendedor,
               CAST(l_quantity AS {MONEY}) AS qtd_vendida, CAST(c6_prcven AS {MONEY}) AS vlr_unitario,
               CAST(c6_valor AS {MONEY}) AS vlr_total, CAST(c6_qtdent AS {MONEY}) AS qtd_entregue,
               trim(l_returnflag) AS num_nota,
               trim(d_e_l_e_t_) = '*' AS flg_deletado, CAST(r_e_c_n_o_ AS BIGINT) AS num_recno,
               CAST(s_t_a_m_p_ AS TIMESTAMP) AS dat_stamp, _lote
        FROM bronze_lines"""),
    "silver_lines": (["std_lines"], """
        SELECT * EXCLUDE (_rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY cod_empresa, num_recno
                ORDER BY dat_stamp DESC NULLS LAST, _lote DESC NULLS LAST,
                         cod_produto DESC NULLS LAST, cod_vendedor DESC NULLS LAST) AS _rn
            FROM std_lines) WHERE _rn = 1"""),
    "fact": (["silver_orders", "silver_lines"], f"""
        SELECT i.cod_empresa, h.cod_filial, i.cod_pedido, i.cod_item, h.dat_emissao, h.cod_cliente, h.cod_loja,
               i.cod_vendedor, i.cod_produto, i.qtd_vendida, i.qtd_entregue,
               CAST(i.qtd_vendida - i.qtd_entregue AS {MONEY}) AS qtd_saldo, i.vlr_unitario, i.vlr_total,
               CAST((i.qtd_vendida - i.qtd_entregue) * i.vlr_unitario AS {MONEY}) AS vlr_saldo,
               CASE WHEN i.qtd_vendida - i.qtd_entregue <= 0 THEN 'Faturado'
                    WHEN i.qtd_entregue > 0 THEN 'Parcial' ELSE 'Aberto' END AS des_status,
               {LOAD_TS} AS dat_atualizacao
        FROM silver_lines i
        JOIN (SELECT * FROM silver_orders WHERE NOT flg_deletado) h
          ON i.cod_empresa = h.cod_empresa AND i.cod_pedido = h.cod_pedido
        WHERE NOT i.flg_deletado"""),
    "units": ([], """
        SELECT '01' AS cod_empresa, lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS cod_filial,
               concat_ws(' / ', r.r_name, n.n_name) AS des_unidade
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "dim_product": ([], f"""
        SELECT '01' AS cod_empresa, trim(CAST(p_partkey AS VARCHAR)) AS cod_produto, trim(p_name) AS des_produto,
               trim(p_type) AS des_tipo, 'UN' AS des_unidade_medida, trim(p_brand) AS cod_grupo,
               CAST(p_retailprice AS {MONEY}) AS vlr_preco_venda
        FROM part"""),
    "dim_seller": ([], """
        SELECT '01' AS cod_empresa, trim(CAST(s_suppkey AS VARCHAR)) AS cod_vendedor, trim(s_name) AS des_nome
        FROM supplier WHERE NOT (s_acctbal < 0)"""),
    "dim_customer": ([], """
        SELECT '01' AS cod_empresa, trim(CAST(c_custkey AS VARCHAR)) AS cod_cliente, '01' AS cod_loja,
               trim(c_name) AS des_nome, trim(c_mktsegment) AS des_nome_reduzido,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS sig_uf, trim(c_mktsegment) AS des_municipio,
               '' AS cod_vendedor, c_acctbal < 0 AS flg_bloqueado
        FROM customer"""),
    "silver_customers": ([], """
        SELECT '01' AS cod_empresa, CAST(c_custkey AS BIGINT) AS num_recno FROM customer"""),
    "silver_sellers": ([], """
        SELECT '01' AS cod_empresa, CAST(s_suppkey AS BIGINT) AS num_recno FROM supplier"""),
    "silver_products": ([], """
        SELECT '01' AS cod_empresa, CAST(p_partkey AS BIGINT) AS num_recno FROM part"""),
    "ev": ([], """
        SELECT event_id, user_id, ts, event_type, value, props, event_type AS _empresa,
               strftime(ts, '%Y%m%d') AS _lote
        FROM events"""),
    "prev_control": ([], """
        SELECT tabela, empresa, 'INCREMENTAL' AS tipo_carga, true AS ativo,
               TIMESTAMP '2024-01-20 00:00:00' AS ultimo_watermark, 'SUCESSO' AS status_ultima_carga,
               TIMESTAMP '2024-01-20 00:00:00' AS data_ultima_execucao, CAST(NULL AS BIGINT) AS qtd_ultima_carga
        FROM (SELECT DISTINCT 'events' AS tabela, event_type AS empresa FROM events)"""),
    "synced_control": (["prev_control"], """
        SELECT coalesce(p.tabela, i.tabela) AS tabela, coalesce(p.empresa, i.empresa) AS empresa,
               CASE WHEN i.tabela IS NOT NULL THEN i.tipo_carga ELSE p.tipo_carga END AS tipo_carga,
               CASE WHEN i.tabela IS NOT NULL THEN i.ativo ELSE false END AS ativo,
               p.ultimo_watermark, p.status_ultima_carga, p.data_ultima_execucao, p.qtd_ultima_carga
        FROM (
            SELECT tabela, trim(empresa) AS empresa, tipo_carga, ativo, ultimo_watermark, status_ultima_carga,
                   data_ultima_execucao, qtd_ultima_carga FROM prev_control
            UNION ALL
            SELECT 'lineitem', trim(l_returnflag || ' '), 'INCREMENTAL', true, max(l_shipdate), 'SUCESSO',
                   TIMESTAMP '2024-01-31 09:00:00', count(*)
            FROM lineitem GROUP BY l_returnflag) p
        FULL OUTER JOIN (
            SELECT DISTINCT 'events' AS tabela, event_type AS empresa, 'INCREMENTAL' AS tipo_carga, true AS ativo
            FROM events
            UNION ALL
            SELECT DISTINCT 'orders', o_orderpriority, 'FULL', true FROM orders) i
          ON p.tabela = i.tabela AND p.empresa = i.empresa"""),
    "sales_dataset": (["fact", "units", "dim_product", "dim_seller", "dim_customer"], """
        SELECT f.dat_emissao, f.des_status, f.vlr_total, f.vlr_saldo, f.qtd_vendida, u.des_unidade,
               p.des_produto, v.des_nome AS des_vendedor, c.des_nome AS des_cliente
        FROM fact f
        JOIN units u ON f.cod_empresa = u.cod_empresa AND f.cod_filial = u.cod_filial
        LEFT JOIN dim_product p ON f.cod_empresa = p.cod_empresa AND f.cod_produto = p.cod_produto
        LEFT JOIN dim_seller v ON f.cod_empresa = v.cod_empresa AND f.cod_vendedor = v.cod_vendedor
        LEFT JOIN dim_customer c ON f.cod_empresa = c.cod_empresa AND f.cod_cliente = c.cod_cliente
             AND f.cod_loja = c.cod_loja"""),
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(uses: list[str], final: str) -> str:
    names = _order(uses)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in names)
    return f"WITH {body}\n{final}" if names else final


MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"
TOTAL = "DECIMAL(38,2)"


def _key_gate(name: str, cte: str) -> str:
    grouped = f"(SELECT cod_empresa, num_recno, count(*) AS n FROM {cte} GROUP BY cod_empresa, num_recno)"
    return f"""
        SELECT 'chave_nula' AS gate, '{name}' AS objeto,
               CAST(coalesce(sum(n) FILTER (WHERE cod_empresa IS NULL OR num_recno IS NULL), 0) AS BIGINT)
                   AS qtd_falhas, 'registros com chave nula' AS detalhe
        FROM {grouped}
        UNION ALL
        SELECT 'chave_duplicada', '{name}', CAST(count(*) FILTER (WHERE n > 1) AS BIGINT), 'chaves duplicadas'
        FROM {grouped}"""


def _orphans(dim: str, cte: str, keys: list[str]) -> str:
    cond = " AND ".join(f"d.{k} = f.{k}" for k in keys)
    return f"""
        SELECT 'integridade' AS gate, 'fato_pedido_venda->{dim}' AS objeto, CAST(count(*) AS BIGINT) AS qtd_falhas,
               'combinações sem correspondência' AS detalhe
        FROM (SELECT DISTINCT {", ".join(keys)} FROM fact) f
        WHERE NOT EXISTS (SELECT 1 FROM {cte} d WHERE {cond})"""


def _negatives(col: str) -> str:
    return f"""
        SELECT 'valor_negativo' AS gate, 'fato_pedido_venda.{col}' AS objeto,
               CAST(count(*) FILTER (WHERE {col} < 0) AS BIGINT) AS qtd_falhas,
               'registros com valor negativo' AS detalhe
        FROM fact"""


def _weighted(doc: str, weights: list[int]) -> str:
    return " + ".join(f"CAST(substring({doc}, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))


def _tax_id_valid(doc: str) -> str:
    r1 = f"(({_weighted(doc, TAX_ID_WEIGHTS_1)}) % 11)"
    d1 = f"(CASE WHEN {r1} < 2 THEN 0 ELSE 11 - {r1} END)"
    r2 = f"(({_weighted(doc, TAX_ID_WEIGHTS_2[:12])} + {d1} * {TAX_ID_WEIGHTS_2[12]}) % 11)"
    d2 = f"(CASE WHEN {r2} < 2 THEN 0 ELSE 11 - {r2} END)"
    return (f"(regexp_full_match({doc}, '[0-9]{{14}}') AND CAST(substring({doc}, 13, 1) AS INTEGER) = {d1} "
            f"AND CAST(substring({doc}, 14, 1) AS INTEGER) = {d2})")


def _gate_report(names: list[str]) -> str:
    return " UNION ALL ".join(
        [_key_gate(n, c) for n, c in zip(names, ["silver_orders", "silver_lines", "silver_customers",
                                                 "silver_sellers", "silver_products"], strict=True)] + _REST)


_REST = [
    _orphans("dim_cliente", "dim_customer", ["cod_empresa", "cod_cliente", "cod_loja"]),
    _orphans("dim_vendedor", "dim_seller", ["cod_empresa", "cod_vendedor"]),
    _orphans("dim_produto", "dim_product", ["cod_empresa", "cod_produto"]),
    _orphans("dim_unidade", "units", ["cod_empresa", "cod_filial"]),
] + [_negatives(c) for c in ["qtd_vendida", "vlr_unitario", "vlr_total"]]
_GATE_CTES = ["fact", "silver_orders", "silver_lines", "silver_customers", "silver_sellers", "silver_products",
              "dim_customer", "dim_seller", "dim_product", "units"]

_DOC = "(lpad(CAST(c_custkey AS VARCHAR), 12, '0') || lpad(CAST(c_nationkey AS VARCHAR), 2, '0'))"

# the first extraction's watermark per event type
_FEED = """WITH wm AS (SELECT event_type, max(ts) AS w FROM events
                     WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type)"""

ORACLE: dict[str, str] = {
    "standardise_orders": with_ctes(["silver_orders"], "SELECT * FROM silver_orders"),
    "latest_line_version": with_ctes(["silver_lines"], "SELECT * FROM silver_lines"),
    "latest_event_snapshot": with_ctes(["ev"], """
        SELECT * EXCLUDE (_mx) FROM (SELECT *, max(_lote) OVER (PARTITION BY _empresa) AS _mx FROM ev)
        WHERE _lote = _mx"""),
    "snapshot_by_index": """
        SELECT event_id, ts AS s_t_a_m_p_, user_id, event_type, value, props, event_type AS _empresa,
               CASE WHEN event_type = 'error' THEN '20240115T000000Z' ELSE '20240131T090000Z' END AS _lote
        FROM events WHERE event_type <> 'error' OR ts < TIMESTAMP '2024-01-15 00:00:00'""",
    # the upsert of the later versions into the earlier ones equals the latest version overall
    "upsert_lines": with_ctes(["silver_lines"], "SELECT * FROM silver_lines"),
    "upsert_lines_bucketed": with_ctes(["silver_lines"], "SELECT * FROM silver_lines"),
    "incremental_events": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-19 23:50:00'",
    "next_watermark": with_ctes(["prev_control"], """
        SELECT c.tabela, c.empresa, c.tipo_carga, c.ativo,
               CASE WHEN a.mx IS NULL OR a.mx < c.ultimo_watermark THEN c.ultimo_watermark
                    ELSE CAST(a.mx AS TIMESTAMP) END AS ultimo_watermark,
               'SUCESSO' AS status_ultima_carga, TIMESTAMP '2024-01-31 09:00:00' AS data_ultima_execucao,
               CAST(coalesce(a.n, 0) AS BIGINT) AS qtd_ultima_carga
        FROM prev_control c
        LEFT JOIN (SELECT 'events' AS tabela, event_type AS empresa, max(ts) AS mx, count(*) AS n
                   FROM events WHERE ts > TIMESTAMP '2024-01-19 23:50:00' GROUP BY event_type) a
          ON c.tabela = a.tabela AND c.empresa = a.empresa"""),
    "control_sync": with_ctes(["synced_control"], "SELECT * FROM synced_control"),
    "control_active": with_ctes(["synced_control"], """
        SELECT tabela, trim(empresa) AS empresa, tipo_carga, ultimo_watermark FROM synced_control WHERE ativo"""),
    "order_fact": with_ctes(["fact"], "SELECT * FROM fact"),
    "order_fact_stored": with_ctes(["fact"], "SELECT * FROM fact"),
    "dim_customer": with_ctes(["dim_customer"], "SELECT * FROM dim_customer"),
    "dim_seller": with_ctes(["dim_seller"], "SELECT * FROM dim_seller"),
    "dim_product": with_ctes(["dim_product"], "SELECT * FROM dim_product"),
    "dim_unit": with_ctes(["units"], "SELECT * FROM units"),
    "calendar": with_ctes(["fact"], f"""
        , b AS (SELECT coalesce(min(dat_emissao), DATE '2001-08-01') AS s FROM fact)
        , d AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP),
                    CAST(make_date(greatest(2001, CAST(year(s) AS INTEGER)), 12, 31) AS TIMESTAMP),
                    INTERVAL 1 DAY)) AS DATE) AS dat_data FROM b)
        SELECT dat_data, CAST(year(dat_data) AS INTEGER) AS num_ano, CAST(month(dat_data) AS INTEGER) AS num_mes,
               ({MONTHS_SQL})[month(dat_data)] AS des_mes, CAST(quarter(dat_data) AS INTEGER) AS num_trimestre,
               strftime(dat_data, '%Y-%m') AS des_ano_mes, CAST(dayofweek(dat_data) + 1 AS INTEGER) AS num_dia_semana
        FROM d"""),
    "sales_dataset": with_ctes(["sales_dataset"], "SELECT * FROM sales_dataset"),
    "last_refresh": with_ctes(["fact"], """
        SELECT strftime(max(dat_atualizacao), '%d/%m/%Y %H:%M') AS des_ultima_carga FROM fact"""),
    "value_sold": with_ctes(["sales_dataset"], f"""
        SELECT CAST(SUM(vlr_total) AS {TOTAL}) AS vlr_vendido FROM sales_dataset"""),
    "open_value": with_ctes(["sales_dataset"], f"""
        SELECT CAST(SUM(vlr_saldo) AS {TOTAL}) AS vlr_carteira FROM sales_dataset"""),
    "sales_by_month": with_ctes(["sales_dataset"], f"""
        SELECT CAST(date_trunc('month', dat_emissao) AS DATE) AS mes, CAST(SUM(vlr_total) AS {TOTAL}) AS vlr_vendido
        FROM sales_dataset GROUP BY 1"""),
    "sales_by_unit": with_ctes(["sales_dataset"], f"""
        SELECT des_unidade, CAST(SUM(vlr_total) AS {TOTAL}) AS vlr_vendido FROM sales_dataset GROUP BY 1"""),
    "open_by_seller": with_ctes(["sales_dataset"], f"""
        SELECT des_vendedor, CAST(SUM(vlr_saldo) AS {TOTAL}) AS vlr_carteira FROM sales_dataset GROUP BY 1"""),
    "maintained_measures": with_ctes(["sales_dataset"], f"""
        SELECT 'valor_vendido' AS medida, CAST(NULL AS VARCHAR) AS chave, CAST(SUM(vlr_total) AS {TOTAL}) AS valor FROM sales_dataset
        UNION ALL SELECT 'valor_em_carteira', NULL, CAST(SUM(vlr_saldo) AS {TOTAL}) FROM sales_dataset
        UNION ALL SELECT 'vendas_por_mes', CAST(CAST(date_trunc('month', dat_emissao) AS DATE) AS VARCHAR), CAST(SUM(vlr_total) AS {TOTAL})
            FROM sales_dataset GROUP BY 2
        UNION ALL SELECT 'vendas_por_unidade', des_unidade, CAST(SUM(vlr_total) AS {TOTAL}) FROM sales_dataset GROUP BY 2
        UNION ALL SELECT 'carteira_por_vendedor', des_vendedor, CAST(SUM(vlr_saldo) AS {TOTAL}) FROM sales_dataset GROUP BY 2"""),
    "gate_duplicates": with_ctes(["std_lines"], """
        SELECT count(*) AS qtd_duplicadas FROM (
            SELECT 1 FROM std_lines GROUP BY cod_empresa, num_recno HAVING count(*) > 1)"""),
    "gate_nulls": with_ctes(["sales_dataset"], """
        SELECT count(*) FILTER (WHERE des_produto IS NULL OR des_vendedor IS NULL OR des_cliente IS NULL)
               AS qtd_nulos
        FROM sales_dataset"""),
    "gate_orphans": with_ctes(["fact", "dim_seller"], """
        SELECT count(*) AS qtd_orfaos FROM (SELECT DISTINCT cod_empresa, cod_vendedor FROM fact) f
        WHERE NOT EXISTS (SELECT 1 FROM dim_seller s
                          WHERE s.cod_empresa = f.cod_empresa AND s.cod_vendedor = f.cod_vendedor)"""),
    "gate_negatives": """
        SELECT count(*) FILTER (WHERE c_acctbal < 0) AS c_acctbal,
               count(*) FILTER (WHERE c_nationkey < 0) AS c_nationkey
        FROM customer""",
    "gate_reconcile": with_ctes(["ev"], """
        , declared AS (SELECT _lote AS lote, 'events' AS tabela, _empresa AS empresa, count(*) AS registros
                       FROM ev GROUP BY 1, 3)
        , landed AS (SELECT _lote AS lote, 'events' AS tabela, _empresa AS empresa, count(*) AS qtd_bronze
                     FROM ev WHERE NOT (_empresa = 'error' AND _lote = (SELECT max(_lote) FROM ev))
                     GROUP BY 1, 3)
        SELECT d.lote, d.tabela, d.empresa, d.registros, coalesce(l.qtd_bronze, 0) AS qtd_bronze
        FROM declared d LEFT JOIN landed l ON d.lote = l.lote AND d.tabela = l.tabela AND d.empresa = l.empresa
        WHERE d.registros > 0 AND coalesce(l.qtd_bronze, 0) <> d.registros"""),
    "gate_reconcile_null_keys": with_ctes(["ev"], """
        , c AS (SELECT _lote AS lote, 'events' AS tabela, nullif(_empresa, 'error') AS empresa, count(*) AS n FROM ev GROUP BY 1, 3)
        SELECT d.lote, d.tabela, d.empresa, d.n AS registros, coalesce(l.n, 0) AS qtd_bronze
        FROM c d LEFT JOIN c l ON d.lote = l.lote AND d.tabela = l.tabela AND d.empresa = l.empresa
        WHERE d.n > 0 AND coalesce(l.n, 0) <> d.n"""),
    "gate_report": with_ctes(_GATE_CTES, _gate_report(
        ["silver.orders", "silver.lines", "silver.customers", "silver.sellers", "silver.products"])),
    "daily_load": with_ctes(_GATE_CTES, _gate_report(
        ["silver.orders", "silver.lineitem", "silver.customer", "silver.supplier", "silver.part"])),
    "bronze_load_once": _FEED + """
        , landed AS (
            SELECT *, '20240115T000000Z' AS _lote FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
            UNION ALL
            SELECT e.*, '20240131T090000Z' FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
            WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE)
        SELECT event_id, ts AS s_t_a_m_p_, user_id, event_type, value, props, _lote, event_type AS _empresa,
               event_type AS empresa_arquivo, true AS tem_ingestao, CAST(0 AS BIGINT) AS recarga
        FROM landed""",
    "manifest_items": _FEED + """
        SELECT '20240115T000000Z' AS lote, 'events' AS tabela, event_type AS empresa, count(*) AS registros
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type
        UNION ALL
        SELECT '20240131T090000Z', 'events', e.event_type, count(*)
        FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
        WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE GROUP BY e.event_type""",
    "manifests_since": _FEED + """
        SELECT '20240131T090000Z' AS lote, 'events' AS tabela, e.event_type AS empresa, count(*) AS registros
        FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
        WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE GROUP BY e.event_type""",
    "bronze_reconcile": _FEED + """
        SELECT '20240115T000000Z' AS lote, 'events' AS tabela, event_type AS empresa, count(*) AS registros,
               count(*) AS qtd_bronze, false AS divergente
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type
        UNION ALL
        SELECT '20240131T090000Z', 'events', e.event_type, count(*), count(*), false
        FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
        WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE GROUP BY e.event_type""",
    "reprocess_lines_bucketed": with_ctes(["std_lines"], """
        SELECT * EXCLUDE (_rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY cod_empresa, num_recno
                ORDER BY dat_stamp DESC NULLS LAST, _lote DESC NULLS LAST,
                         cod_produto DESC NULLS LAST, cod_vendedor DESC NULLS LAST) AS _rn
            FROM std_lines WHERE dat_stamp < TIMESTAMP '1999-01-01 00:00:00') WHERE _rn = 1"""),
    "upsert_conditions": with_ctes(["silver_lines"], """
        , t AS (SELECT CASE WHEN cod_item <> '5' THEN cod_empresa END AS cod_empresa, num_recno,
                       CASE WHEN cod_item <> '6' THEN dat_stamp END AS dat_stamp, cod_item, 'destino' AS origem
                FROM silver_lines WHERE cod_item <> '7')
        , s AS (SELECT CASE WHEN cod_item <> '5' THEN cod_empresa END AS cod_empresa, num_recno,
                       CASE WHEN cod_item = '2' THEN dat_stamp - INTERVAL 1 DAY
                            WHEN cod_item = '4' AND num_nota = 'A' THEN NULL
                            WHEN cod_item = '4' THEN dat_stamp + INTERVAL 1 DAY ELSE dat_stamp END AS dat_stamp,
                       cod_item, 'origem' AS origem
                FROM silver_lines WHERE cod_item <> '1')
        SELECT t.* FROM t WHERE NOT EXISTS (
            SELECT 1 FROM s WHERE s.cod_empresa = t.cod_empresa AND s.num_recno = t.num_recno
                              AND s.dat_stamp >= t.dat_stamp)
        UNION ALL
        SELECT s.* FROM s JOIN t ON s.cod_empresa = t.cod_empresa AND s.num_recno = t.num_recno
        WHERE s.dat_stamp >= t.dat_stamp
        UNION ALL
        SELECT s.* FROM s WHERE NOT EXISTS (
            SELECT 1 FROM t WHERE s.cod_empresa = t.cod_empresa AND s.num_recno = t.num_recno)"""),
    "date_texts": with_ctes(["silver_orders"], """
        SELECT * REPLACE (CASE WHEN flg_deletado THEN NULL ELSE dat_emissao END AS dat_emissao) FROM silver_orders"""),
    "control_failure": with_ctes(["prev_control"], """
        SELECT p.tabela, p.empresa, p.tipo_carga, p.ativo,
               CASE WHEN p.empresa = 'error' THEN p.ultimo_watermark ELSE e.mx END AS ultimo_watermark,
               CASE WHEN p.empresa = 'error' THEN 'FALHA' ELSE 'SUCESSO' END AS status_ultima_carga,
               TIMESTAMP '2024-01-31 09:00:00' AS data_ultima_execucao,
               CASE WHEN p.empresa = 'error' THEN NULL ELSE e.n END AS qtd_ultima_carga
        FROM prev_control p
        JOIN (SELECT event_type, CAST(max(ts) AS TIMESTAMP) AS mx, count(*) AS n FROM events GROUP BY event_type) e
          ON p.empresa = e.event_type"""),
    "config_items": """
        SELECT DISTINCT 'events' AS tabela, event_type AS empresa, 'INCREMENTAL' AS tipo_carga, false AS ativo FROM events
        UNION ALL
        SELECT DISTINCT 'orders', o_orderpriority, 'FULL', true FROM orders""",
    "control_switches": with_ctes(["synced_control"], """
        SELECT tabela, empresa, tipo_carga,
               CASE WHEN tabela = 'orders' OR (tabela = 'events' AND empresa = 'error') THEN false ELSE ativo END AS ativo,
               CASE WHEN tabela = 'events' THEN NULL
                    WHEN tabela = 'lineitem' AND empresa = 'A' THEN TIMESTAMP '2024-01-20 00:00:00'
                    ELSE ultimo_watermark END AS ultimo_watermark,
               status_ultima_carga, data_ultima_execucao, qtd_ultima_carga
        FROM synced_control"""),
    "extract_and_load": with_ctes(["fact", "units"], f"""
        SELECT s.s_name AS des_vendedor, count(*) AS itens, CAST(sum(vlr_total) AS {TOTAL}) AS vlr_vendido,
               CAST(sum(vlr_saldo) AS {TOTAL}) AS vlr_carteira, CAST(sum(vlr_saldo) AS {TOTAL}) AS vlr_carteira_mantida
        FROM fact f JOIN units u ON f.cod_empresa = u.cod_empresa AND f.cod_filial = u.cod_filial
        LEFT JOIN supplier s ON f.cod_vendedor = CAST(s.s_suppkey AS VARCHAR)
        GROUP BY 1"""),
    "extract_isolated": with_ctes(["prev_control"], """
        , e AS (SELECT event_type, CAST(max(ts) AS TIMESTAMP) AS mx, count(*) AS n FROM events
                WHERE event_type <> 'error' AND ts > TIMESTAMP '2024-01-19 23:50:00' GROUP BY event_type)
        SELECT p.tabela, p.empresa, p.tipo_carga, p.ativo, greatest(p.ultimo_watermark, e.mx) AS ultimo_watermark,
               CASE WHEN p.empresa = 'error' THEN 'FALHA' ELSE 'SUCESSO' END AS status_ultima_carga,
               TIMESTAMP '2024-01-31 09:00:00' AS data_ultima_execucao, e.n AS qtd_ultima_carga,
               e.n AS qtd_pouso, e.n AS qtd_manifesto
        FROM prev_control p LEFT JOIN e ON p.empresa = e.event_type"""),
    "bronze_table": _FEED + """
        SELECT event_type AS _empresa, '20240115T000000Z' AS _lote, count(*) AS registros, count(value) AS com_valor,
               'Events as received: it''s append-only' AS descricao
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type
        UNION ALL
        SELECT e.event_type, '20240131T090000Z', count(*), count(value), 'Events as received: it''s append-only'
        FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
        WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE GROUP BY e.event_type""",
    "bronze_schema_history": """
        SELECT CAST(event_id AS BIGINT) AS event_id, ts AS s_t_a_m_p_, event_type,
               CASE WHEN ts < TIMESTAMP '2024-01-21' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value,
               CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN CAST(user_id AS BIGINT) END AS user_id,
               CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN props END AS props,
               CASE WHEN ts < TIMESTAMP '2024-01-11' THEN '1' WHEN ts < TIMESTAMP '2024-01-21' THEN '2' ELSE '3' END AS _lote,
               '01' AS _empresa, CAST(3 AS INTEGER) AS versoes
        FROM events""",
    "footer_counts": with_ctes(["fact"], """
        , wm AS (SELECT event_type, max(ts) AS w FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type)
        SELECT '20240115T000000Z' AS lote, count(*) AS linhas, 'events' AS tabela, CAST(NULL AS DATE) AS dat_inicio
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
        UNION ALL
        SELECT '20240131T090000Z', count(*), 'events', NULL
        FROM events e LEFT JOIN wm w ON e.event_type = w.event_type
        WHERE w.w IS NULL OR e.ts > w.w - INTERVAL 10 MINUTE
        UNION ALL
        SELECT NULL, count(*), 'fato_pedido_venda', min(dat_emissao) FROM fact"""),
    "key_gate_incremental": with_ctes(["std_lines"], """
        SELECT 'chave_nula' AS gate, 'silver.lines' AS objeto, CAST(0 AS BIGINT) AS qtd_falhas, 'registros com chave nula' AS detalhe
        UNION ALL
        SELECT 'chave_duplicada', 'silver.lines', count(DISTINCT num_recno), 'chaves duplicadas'
        FROM std_lines WHERE dat_stamp >= TIMESTAMP '1999-01-01 00:00:00' AND cod_item = '7'"""),
    "restored_version": with_ctes(["dim_product"], "SELECT * FROM dim_product"),
    "comment_coverage": with_ctes(["fact", "dim_customer", "dim_seller", "dim_product", "units"], """
        , b AS (SELECT coalesce(min(dat_emissao), DATE '2001-08-01') AS s FROM fact)
        , n AS (SELECT 'fato_pedido_venda' AS tabela, 17 AS colunas, count(*) AS registros FROM fact
                UNION ALL SELECT 'dim_cliente', 9, count(*) FROM dim_customer
                UNION ALL SELECT 'dim_vendedor', 3, count(*) FROM dim_seller
                UNION ALL SELECT 'dim_produto', 7, count(*) FROM dim_product
                UNION ALL SELECT 'dim_unidade', 3, count(*) FROM units
                UNION ALL SELECT 'dim_calendario', 7,
                    date_diff('day', s, make_date(greatest(2001, CAST(year(s) AS INTEGER)), 12, 31)) + 1 FROM b)
        SELECT tabela, true AS com_descricao, CAST(colunas AS INTEGER) AS colunas,
               CAST(colunas AS INTEGER) AS colunas_descritas, registros FROM n"""),
    "item_value_audit": with_ctes(["silver_lines"], f"""
        SELECT count(*) AS qtd_itens,
               count(*) FILTER (WHERE vlr_total <> round(qtd_vendida * vlr_unitario, 2)) AS qtd_divergentes,
               CAST(coalesce(sum(vlr_total - round(qtd_vendida * vlr_unitario, 2))
                    FILTER (WHERE vlr_total <> round(qtd_vendida * vlr_unitario, 2)), 0) AS {TOTAL}) AS vlr_diferenca
        FROM silver_lines"""),
    "tax_id_audit": f"""
        SELECT count({_DOC}) AS qtd_documentos,
               count(*) FILTER (WHERE regexp_full_match({_DOC}, '[0-9]{{14}}')) AS qtd_formato_ok,
               count(*) FILTER (WHERE {_tax_id_valid(_DOC)}) AS qtd_validos
        FROM customer""",
}

ORACLE["bronze_load_listed"] = ORACLE["bronze_load_once"]      # the same rows by another way of discovery
