"""Configuration of the ERP sales domain.

FIXED VALUES — these must equal the source system's conventions and the
published data dictionary for results to be right.  They are stated plainly
and in their natural order; nothing here is computed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: load type per source table alias.
LOAD_TYPES: dict[str, str] = {
    "sc5": "INCREMENTAL",
    "sc6": "INCREMENTAL",
    "sa1": "FULL",
    "sa3": "FULL",
    "sb1": "FULL",
}

# FIXED VALUES: source column -> (silver column, conversion), per table.
# The customer document number (a1_cgc) is deliberately not mapped.
ERP_MAPPINGS: dict[str, dict[str, tuple[str, str]]] = {
    "sc5": {
        "c5_filial": ("cod_filial", "texto"),
        "c5_num": ("cod_pedido", "texto"),
        "c5_tipo": ("des_tipo", "texto"),
        "c5_cliente": ("cod_cliente", "texto"),
        "c5_lojacli": ("cod_loja", "texto"),
        "c5_vend1": ("cod_vendedor", "texto"),
        "c5_emissao": ("dat_emissao", "data"),
        "c5_nota": ("num_nota", "texto"),
    },
    "sc6": {
        "c6_filial": ("cod_filial", "texto"),
        "c6_num": ("cod_pedido", "texto"),
        "c6_item": ("cod_item", "texto"),
        "c6_produto": ("cod_produto", "texto"),
        "c6_qtdven": ("qtd_vendida", "decimal"),
        "c6_prcven": ("vlr_unitario", "decimal"),
        "c6_valor": ("vlr_total", "decimal"),
        "c6_qtdent": ("qtd_entregue", "decimal"),
        "c6_nota": ("num_nota", "texto"),
    },
    "sa1": {
        "a1_cod": ("cod_cliente", "texto"),
        "a1_loja": ("cod_loja", "texto"),
        "a1_nome": ("des_nome", "texto"),
        "a1_nreduz": ("des_nome_reduzido", "texto"),
        "a1_est": ("sig_uf", "texto"),
        "a1_mun": ("des_municipio", "texto"),
        "a1_vend": ("cod_vendedor", "texto"),
        "a1_msblql": ("flg_bloqueado", "bloqueio"),
    },
    "sa3": {
        "a3_cod": ("cod_vendedor", "texto"),
        "a3_nome": ("des_nome", "texto"),
    },
    "sb1": {
        "b1_cod": ("cod_produto", "texto"),
        "b1_desc": ("des_produto", "texto"),
        "b1_tipo": ("des_tipo", "texto"),
        "b1_um": ("des_unidade_medida", "texto"),
        "b1_grupo": ("cod_grupo", "texto"),
        "b1_prv1": ("vlr_preco_venda", "decimal"),
    },
}

# FIXED VALUES: business units (company, branch, name).
BUSINESS_UNITS: list[tuple[str, str, str]] = [
    ("01", "01", "Matriz"),
    ("05", "01", "Acessórios"),
    ("08", "01", "Nordeste"),
    ("08", "02", "Centro-Oeste"),
    ("13", "01", "TopMax"),
]

# FIXED VALUES: month names, January first.
MONTH_NAMES: list[str] = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]

# FIXED VALUES: status labels of an order item.
STATUS_INVOICED = "Faturado"
STATUS_PARTIAL = "Parcial"
STATUS_OPEN = "Aberto"

# FIXED VALUES: source-system conventions.
DELETED_MARKER = "*"        # d_e_l_e_t_ of a logically deleted row
BLOCKED_MARKER = "1"        # a1_msblql of a blocked customer
BATCH_FORMAT = "yyyyMMdd'T'HHmmss'Z'"   # batch id, UTC; lexical order = time order
BATCH_FORMAT_PY = "%Y%m%dT%H%M%SZ"
SOURCE_DATE_FORMAT = "yyyyMMdd"
DEFAULT_OVERLAP_MINUTES = 10
DEFAULT_RECONCILE_DAYS = 7
COMPANY_PATH_PATTERN = r"empresa=([0-9]{2})"
LANDING_FILE_GLOB = "*.parquet"
REFRESH_FORMAT = "dd/MM/yyyy HH:mm"

# FIXED VALUES: extraction configuration (tables x companies).
EXTRACTION_CONFIG: dict = {
    "sistema": "PROTHEUS",
    "tabelas": [
        {"tabela": "sc5", "tipo_carga": "INCREMENTAL", "ativo": True, "empresas": ["01", "05", "08", "13"]},
        {"tabela": "sc6", "tipo_carga": "INCREMENTAL", "ativo": True, "empresas": ["01", "05", "08", "13"]},
        {"tabela": "sa1", "tipo_carga": "FULL", "ativo": True, "empresas": ["01", "05", "08", "13"]},
        {"tabela": "sa3", "tipo_carga": "FULL", "ativo": True, "empresas": ["01", "05", "08", "13"]},
        {"tabela": "sb1", "tipo_carga": "FULL", "ativo": True, "empresas": ["01", "05", "08", "13"]},
    ],
}

# FIXED VALUES: weights of the 14-digit company tax id check digits.
TAX_ID_WEIGHTS_1: list[int] = [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
TAX_ID_WEIGHTS_2: list[int] = [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]

# FIXED VALUES: Gold data dictionary (table description, column descriptions).
GOLD_COMMENTS: dict[str, tuple[str, dict[str, str]]] = {
    "fato_pedido_venda": (
        "Pedidos de venda no grão item do pedido, sem registros excluídos logicamente. Fonte: SC5 e SC6.",
        {
            "cod_empresa": "Código da empresa no Protheus",
            "cod_filial": "Código da filial",
            "cod_pedido": "Número do pedido de venda (C5_NUM)",
            "cod_item": "Item do pedido (C6_ITEM)",
            "dat_emissao": "Data de emissão do pedido",
            "cod_cliente": "Código do cliente",
            "cod_loja": "Loja do cliente",
            "cod_vendedor": "Código do vendedor do pedido",
            "cod_produto": "Código do produto",
            "qtd_vendida": "Quantidade vendida",
            "qtd_entregue": "Quantidade já faturada/entregue",
            "qtd_saldo": "Quantidade em carteira (vendida menos entregue)",
            "vlr_unitario": "Preço unitário de venda",
            "vlr_total": "Valor total do item",
            "vlr_saldo": "Valor em carteira (saldo × preço unitário)",
            "des_status": "Situação do item: Aberto, Parcial ou Faturado",
            "dat_atualizacao": "Data e hora da última carga da Gold",
        },
    ),
    "dim_cliente": (
        "Clientes ativos por empresa (cadastro compartilhado entre filiais). Fonte: SA1.",
        {
            "cod_empresa": "Código da empresa",
            "cod_cliente": "Código do cliente",
            "cod_loja": "Loja do cliente",
            "des_nome": "Razão social",
            "des_nome_reduzido": "Nome fantasia",
            "sig_uf": "UF",
            "des_municipio": "Município",
            "cod_vendedor": "Vendedor responsável pelo cliente",
            "flg_bloqueado": "Cliente bloqueado para novos pedidos",
        },
    ),
    "dim_vendedor": (
        "Vendedores por empresa. Fonte: SA3.",
        {"cod_empresa": "Código da empresa", "cod_vendedor": "Código do vendedor", "des_nome": "Nome do vendedor"},
    ),
    "dim_produto": (
        "Produtos por empresa. Fonte: SB1.",
        {
            "cod_empresa": "Código da empresa",
            "cod_produto": "Código do produto",
            "des_produto": "Descrição do produto",
            "des_tipo": "Tipo do produto (ex.: PA — produto acabado)",
            "des_unidade_medida": "Unidade de medida",
            "cod_grupo": "Grupo do produto",
            "vlr_preco_venda": "Preço de venda de referência",
        },
    ),
    "dim_unidade": (
        "Unidades de negócio: combinação de empresa e filial.",
        {"cod_empresa": "Código da empresa", "cod_filial": "Código da filial", "des_unidade": "Nome da unidade"},
    ),
    "dim_calendario": (
        "Calendário diário do período dos pedidos.",
        {
            "dat_data": "Data",
            "num_ano": "Ano",
            "num_mes": "Mês (1 a 12)",
            "des_mes": "Nome do mês",
            "num_trimestre": "Trimestre",
            "des_ano_mes": "Ano e mês (yyyy-MM)",
            "num_dia_semana": "Dia da semana (1 = domingo)",
        },
    ),
}
# ---------------------------------------------------------------------------

# Our own defaults (not reference values).
SILVER_KEYS: tuple[str, ...] = ("cod_empresa", "num_recno")
VERSION_ORDER: tuple[str, ...] = ("dat_stamp", "_lote")
FACT_KEYS: tuple[str, ...] = ("cod_empresa", "cod_filial", "cod_pedido")
FACT_HEADER_COLUMNS: tuple[str, ...] = ("dat_emissao", "cod_cliente", "cod_loja", "cod_vendedor")
# Dimension key per fact relation, checked by the integrity gate (calendar excluded).
FACT_RELATIONS: dict[str, list[str]] = {
    "dim_cliente": ["cod_empresa", "cod_cliente", "cod_loja"],
    "dim_vendedor": ["cod_empresa", "cod_vendedor"],
    "dim_produto": ["cod_empresa", "cod_produto"],
    "dim_unidade": ["cod_empresa", "cod_filial"],
}
FACT_NON_NEGATIVE: list[str] = ["qtd_vendida", "vlr_unitario", "vlr_total"]
