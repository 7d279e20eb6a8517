"""Fund characteristics and fund managers from the registry."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsift.functions.columns import as_date, safe_label
from fundsift.operators.ranking import top_n

# Registry column -> column of the characteristics table.
CHARACTERISTICS = {
    "Categoria ANBIMA": "anbima_category_main",
    "nivel_1_categoria": "anbima_category_level_1",
    "nivel_2_categoria": "anbima_category_level_2",
    "nivel_3_subcategoria": "anbima_category_level_3",
    "Característica do Investidor": "target_investor_type",
    "Tipo ANBIMA": "fund_subtype",
    "Tipo de Investidor": "accessability",
    "Gestor Principal": "fund_manager",
    "Nome Comercial": "commercial_name",
    "Prazo Pagamento Resgate em dias": "redemption_days",
    "Status": "status",
    "Data de Início de Atividade": "inception_date",
}
LEVELS = ("anbima_category_level_1", "anbima_category_level_2", "anbima_category_level_3")
ACTIVE_STATUS = "Ativo"
DEFAULT_REDEMPTION_DAYS = 90.0


def first_registration(registry: DataFrame) -> DataFrame:
    """One row per fund: the earliest inception; one without a date goes first."""
    named = registry.select(
        F.col("CNPJ do Fundo").cast("long").alias("cnpj"),
        *[F.col(old).alias(new) for old, new in CHARACTERISTICS.items()],
    )
    rest = [F.asc(c) for c in named.columns if c not in ("cnpj", "inception_date")]
    return top_n(named, ["cnpj"], [F.asc_nulls_first("inception_date"), *rest], 1)


def category_flags(df: DataFrame, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(cnpj, level, label, flag): the ``is_*`` flags that are set, in long form."""
    pairs = F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("label")) for c in levels])
    named = df.select("cnpj", F.inline(pairs)).filter(F.col("label").isNotNull())
    return named.withColumn("flag", safe_label("label"))


class Category(NamedTuple):
    level: str
    label: str
    flag: str


def one_hot_categories(df: DataFrame, categories: Iterable[Category]) -> DataFrame:
    """One ``is_*`` column per given category; unknown category, unknown flag.

    Columns must be known when the plan is made, so the caller names the categories,
    for instance from ``category_flags``. Labels that give the same column name share
    it; the last one given wins.
    """
    flags = {c.flag: (F.col(c.level) == c.label).cast("byte") for c in categories}
    return df.withColumns(flags) if flags else df


def fund_characteristics(registry: DataFrame, scope: DataFrame) -> DataFrame:
    """Every fund in scope with its registry data, null where it has none."""
    wide = scope.select("cnpj").join(first_registration(registry), "cnpj", "left")
    return wide.withColumns(
        {
            "is_active": (F.col("status") == ACTIVE_STATUS).cast("byte"),
            "redemption_days": F.coalesce(
                F.col("redemption_days").cast("double"), F.lit(DEFAULT_REDEMPTION_DAYS)
            ),
        }
    ).drop("status")


def assert_unique(df: DataFrame, key: str = "cnpj") -> DataFrame:
    """``df`` itself, or an error when a key occurs twice. Null counts as a key."""
    repeated = df.groupBy(key).count().filter("count > 1").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("count").alias("rows")
    )
    found = repeated.first()
    if found["keys"]:
        raise ValueError(f"{found['keys']} values of {key} share {found['rows']} rows")
    return df


def unique_key_report(df: DataFrame, key: str = "cnpj") -> DataFrame:
    """The two numbers the assertion compares: rows, and distinct keys with null as one."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )


def fund_managers(characteristics: DataFrame) -> DataFrame:
    """Per manager of active funds: number of funds, earliest and latest inception."""
    inception = as_date(characteristics, "inception_date")
    return (
        characteristics.filter((F.col("is_active") == 1) & F.col("fund_manager").isNotNull())
        .groupBy("fund_manager")
        .agg(
            F.count_distinct("cnpj").alias("num_funds"),
            F.min(inception).alias("earliest_inception"),
            F.max(inception).alias("latest_inception"),
        )
    )
