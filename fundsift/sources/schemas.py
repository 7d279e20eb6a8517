"""Declared schemas of the raw files (fixed values: the names and types on file).

Columns are given by their newer names; ``OLD_NAMES`` maps what older files call them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Old column name -> new column name.
OLD_NAMES = {
    "TP_FUNDO": "TP_FUNDO_CLASSE",
    "CNPJ_FUNDO": "CNPJ_FUNDO_CLASSE",
}

_TEXT, _NUMBER = T.StringType(), T.DoubleType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# Columns and types of each kind of file, in file order.
MONTHLY_NAV = _schema(
    ("TP_FUNDO_CLASSE", _TEXT),
    ("CNPJ_FUNDO_CLASSE", _TEXT),
    ("DENOM_SOCIAL", _TEXT),
    ("DT_COMPTC", _TEXT),
    ("VL_PATRIM_LIQ", _NUMBER),
)

DAILY_QUOTAS = _schema(
    ("TP_FUNDO_CLASSE", _TEXT),
    ("CNPJ_FUNDO_CLASSE", _TEXT),
    ("ID_SUBCLASSE", _TEXT),
    ("DT_COMPTC", _TEXT),
    ("VL_QUOTA", _NUMBER),
    ("VL_PATRIM_LIQ", _NUMBER),
)

# Every holdings family begins with these.
_HOLDINGS = (
    ("TP_FUNDO_CLASSE", _TEXT),
    ("CNPJ_FUNDO_CLASSE", _TEXT),
    ("DENOM_SOCIAL", _TEXT),
    ("DT_COMPTC", _TEXT),
    ("TP_APLIC", _TEXT),
    ("TP_ATIVO", _TEXT),
    ("EMISSOR_LIGADO", _TEXT),
    ("TP_NEGOC", _TEXT),
    ("QT_VENDA_NEGOC", _NUMBER),
    ("VL_VENDA_NEGOC", _NUMBER),
    ("QT_AQUIS_NEGOC", _NUMBER),
    ("VL_AQUIS_NEGOC", _NUMBER),
    ("QT_POS_FINAL", _NUMBER),
    ("VL_MERC_POS_FINAL", _NUMBER),
    ("VL_CUSTO_POS_FINAL", _NUMBER),
    ("DT_CONFID_APLIC", _TEXT),
)

HOLDINGS = {
    # government bonds
    "blc_1": _schema(
        *_HOLDINGS,
        ("TP_TITPUB", _TEXT),
        ("CD_ISIN", _TEXT),
        ("CD_SELIC", _TEXT),
        ("DT_EMISSAO", _TEXT),
        ("DT_VENC", _TEXT),
    ),
    # fund shares
    "blc_2": _schema(
        *_HOLDINGS,
        ("CNPJ_FUNDO_COTA", _TEXT),
        ("NM_FUNDO_COTA", _TEXT),
    ),
    # swaps
    "blc_3": _schema(
        *_HOLDINGS,
        ("CD_SWAP", _TEXT),
        ("DS_SWAP", _TEXT),
    ),
    # coded assets
    "blc_4": _schema(
        *_HOLDINGS,
        ("CD_ATIVO", _TEXT),
        ("DS_ATIVO", _TEXT),
        ("CD_ISIN", _TEXT),
        ("DT_INI_VIGENCIA", _TEXT),
        ("DT_FIM_VIGENCIA", _TEXT),
    ),
    # rated credit instruments
    "blc_5": _schema(
        *_HOLDINGS,
        ("CNPJ_EMISSOR", _TEXT),
        ("EMISSOR", _TEXT),
        ("DT_VENC", _TEXT),
        ("TITULO_POSFX", _TEXT),
        ("CD_INDEXADOR_POSFX", _TEXT),
        ("DS_INDEXADOR_POSFX", _TEXT),
        ("PR_INDEXADOR_POSFX", _NUMBER),
        ("PR_CUPOM_POSFX", _NUMBER),
        ("PR_TAXA_PREFX", _NUMBER),
        ("RISCO_EMISSOR", _TEXT),
        ("AG_RISCO", _TEXT),
        ("DT_RISCO", _TEXT),
        ("GRAU_RISCO", _TEXT),
    ),
    # unrated credit
    "blc_6": _schema(
        *_HOLDINGS,
        ("PF_PJ_EMISSOR", _TEXT),
        ("CPF_CNPJ_EMISSOR", _TEXT),
        ("EMISSOR", _TEXT),
        ("DT_VENC", _TEXT),
        ("TITULO_POSFX", _TEXT),
        ("CD_INDEXADOR_POSFX", _TEXT),
        ("DS_INDEXADOR_POSFX", _TEXT),
        ("PR_INDEXADOR_POSFX", _NUMBER),
        ("PR_CUPOM_POSFX", _NUMBER),
        ("PR_TAXA_PREFX", _NUMBER),
        ("TITULO_CETIP", _TEXT),
        ("TITULO_GARANTIA", _TEXT),
        ("CNPJ_INSTITUICAO_FINANC_COOBR", _TEXT),
    ),
    # foreign assets
    "blc_7": _schema(
        *_HOLDINGS,
        ("INVEST_COLETIVO", _TEXT),
        ("INVEST_COLETIVO_GESTOR", _TEXT),
        ("EMISSOR", _TEXT),
        ("DT_VENC", _TEXT),
        ("CD_PAIS", _TEXT),
        ("PAIS", _TEXT),
        ("CD_BV_MERC", _TEXT),
        ("BV_MERC", _TEXT),
        ("CD_ATIVO_BV_MERC", _TEXT),
        ("RISCO_EMISSOR", _TEXT),
        ("AG_RISCO", _TEXT),
        ("DT_RISCO", _TEXT),
        ("GRAU_RISCO", _TEXT),
        ("DS_ATIVO_EXTERIOR", _TEXT),
        ("QT_ATIVO_EXTERIOR", _NUMBER),
        ("VL_ATIVO_EXTERIOR", _NUMBER),
    ),
    # declared, but not part of the analysis
    "blc_8": _schema(
        *_HOLDINGS,
        ("DS_ATIVO", _TEXT),
        ("PF_PJ_EMISSOR", _TEXT),
        ("CPF_CNPJ_EMISSOR", _TEXT),
        ("EMISSOR", _TEXT),
    ),
}

# The families that make up a fund's portfolio.
PORTFOLIO_FAMILIES = tuple(f"blc_{i}" for i in range(1, 8))

REGISTRY = T.StructType(
    [
        T.StructField("CNPJ do Fundo", T.LongType()),
        T.StructField("Categoria ANBIMA", T.StringType()),
        T.StructField("nivel_1_categoria", T.StringType()),
        T.StructField("nivel_2_categoria", T.StringType()),
        T.StructField("nivel_3_subcategoria", T.StringType()),
        T.StructField("Característica do Investidor", T.StringType()),
        T.StructField("Tipo ANBIMA", T.StringType()),
        T.StructField("Tipo de Investidor", T.StringType()),
        T.StructField("Gestor Principal", T.StringType()),
        T.StructField("Nome Comercial", T.StringType()),
        T.StructField("Prazo Pagamento Resgate em dias", T.DoubleType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Data de Início de Atividade", T.StringType()),
    ]
)


def with_old_names(names: list[str]) -> dict[str, str]:
    """The renames a file with these columns needs: old name there, new name not."""
    return {
        old: new for old, new in OLD_NAMES.items() if old in names and new not in names
    }


def for_header(header: list[str], declared: T.StructType) -> T.StructType:
    """Schema of a file by its own header: declared types, text for other columns."""
    renamed = with_old_names(header)
    types = {f.name: f.dataType for f in declared.fields}
    return T.StructType(
        [
            T.StructField(name, types.get(renamed.get(name, name), T.StringType()))
            for name in header
        ]
    )
