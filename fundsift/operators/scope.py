"""Which funds are analysed, and raw tables restricted to them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.config import Settings
from fundsift.functions.columns import as_date, cnpj_to_numeric, one_of, period_end
from fundsift.operators.keys import keep_keys, match_keys
from fundsift.operators.ranking import top_n
from fundsift.session import materialize
from fundsift.sources.files import recent_periods, unify_names

RAW_ID = "CNPJ_FUNDO_CLASSE"


def filter_fund_types(nav: DataFrame, settings: Settings) -> DataFrame:
    return nav.filter(one_of("TP_FUNDO_CLASSE", settings.fund_types, settings.collation))


def filter_registry(registry: DataFrame, settings: Settings) -> DataFrame:
    """Registry rows of the wanted category that the wanted investors may buy."""
    return registry.filter(
        one_of("Categoria ANBIMA", settings.registry_categories, settings.collation)
        & one_of("Tipo de Investidor", settings.accessability, settings.collation)
    )


def _nonpositive_at_end(nav: DataFrame, latest_period: int) -> Column:
    return (as_date(nav, "DT_COMPTC") == period_end(latest_period)) & (F.col("VL_PATRIM_LIQ") <= 0)


def exclude_nonpositive_nav(nav: DataFrame, latest_period: int) -> DataFrame:
    """Drop all rows of funds whose NAV is zero or less on the last day of the period.

    Funds are told apart by the id as written. Rows without an id are dropped.
    """
    removed = nav.filter(_nonpositive_at_end(nav, latest_period)).select(RAW_ID).distinct()
    return match_keys(nav.filter(F.col(RAW_ID).isNotNull()), removed, [RAW_ID], "left_anti")


def _nav_ids(nav: DataFrame, latest_period: int, settings: Settings) -> DataFrame:
    """Distinct numeric ids of the NAV table after the type and NAV rules.

    Only ids are wanted, so both rules fit in one aggregate per written id.
    """
    nav = filter_fund_types(unify_names(nav), settings)
    removed = F.lit(False)
    if settings.remove_funds_w_negative_nav:
        removed = F.coalesce(
            F.bool_or(_nonpositive_at_end(nav, latest_period)), F.lit(False)
        )
        nav = nav.filter(F.col(RAW_ID).isNotNull())
    by_id = nav.groupBy(RAW_ID).agg(removed.alias("removed"))
    return by_id.filter(~F.col("removed")).select(cnpj_to_numeric(RAW_ID).alias("cnpj")).distinct()


def funds_in_scope(
    nav: DataFrame, registry: DataFrame, latest_period: int, settings: Settings
) -> DataFrame:
    """Ids that pass the rules in both the NAV table and the registry."""
    registered = (
        filter_registry(registry, settings)
        .select(F.col("CNPJ do Fundo").cast("long").alias("cnpj"))
        .distinct()
    )
    return _nav_ids(nav, latest_period, settings).join(registered, "cnpj", "left_semi")


def normalize(table: DataFrame, scope: DataFrame) -> DataFrame:
    """New column names, numeric ``cnpj``, rows of in-scope funds only."""
    table = unify_names(table).withColumn("cnpj", cnpj_to_numeric(RAW_ID))
    return keep_keys(table, scope, "cnpj")


def normalize_monthly_nav(
    nav: DataFrame, scope: DataFrame
) -> DataFrame:
    return normalize(nav, scope)


def normalize_daily_quotas(
    quotas: DataFrame, scope: DataFrame
) -> DataFrame:
    return normalize(quotas, scope)


def normalize_holdings(
    families: Mapping[str, DataFrame] | DataFrame, scope: DataFrame
) -> DataFrame:
    """All holdings families in one table, marked by ``blc_type``; or such a table as it is."""
    if isinstance(families, DataFrame):
        return normalize(families, scope)
    marked = [
        unify_names(df).withColumn("blc_type", F.lit(family)) for family, df in families.items()
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return normalize(together, scope)


class FixedIncome(NamedTuple):
    nav: DataFrame
    registry: DataFrame
    scope: DataFrame


def filter_fixed_income(
    nav: DataFrame, registry: DataFrame, latest_period: int, settings: Settings
) -> FixedIncome:
    """NAV rows (one per fund and date), registry rows and ids of the funds in scope.

    Of several NAV rows per fund and date the one with the highest NAV is kept.
    """
    nav = unify_names(recent_periods(nav, settings.num_period_months))
    scope = materialize(funds_in_scope(nav, registry, latest_period, settings))
    rows = filter_fund_types(nav, settings)
    if settings.remove_funds_w_negative_nav:
        rows = exclude_nonpositive_nav(rows, latest_period)
    rows = top_n(
        rows.select(
            cnpj_to_numeric(RAW_ID).alias("cnpj"),
            "DENOM_SOCIAL",
            "DT_COMPTC",
            "VL_PATRIM_LIQ",
            "TP_FUNDO_CLASSE",
        ),
        ["cnpj", "DT_COMPTC"],
        [F.desc_nulls_last("VL_PATRIM_LIQ"), F.asc("DENOM_SOCIAL"), F.asc("TP_FUNDO_CLASSE")],
        1,
    )
    listed = filter_registry(registry, settings).withColumn(
        "cnpj", F.col("CNPJ do Fundo").cast("long")
    )
    return FixedIncome(
        keep_keys(rows, scope, "cnpj"), keep_keys(listed, scope, "cnpj"), scope
    )
