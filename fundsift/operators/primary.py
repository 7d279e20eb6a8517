"""NAV and return series, one row per fund and day or month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundsift.functions.columns import as_date, is_finite, month_index, period_of
from fundsift.operators.keys import match_keys
from fundsift.operators.ranking import top_n


def monthly_nav(nav: DataFrame) -> DataFrame:
    """(cnpj, period, price), duplicate rows removed."""
    date = as_date(nav, "DT_COMPTC")
    return nav.select(
        "cnpj",
        period_of(date).alias("period"),
        F.col("VL_PATRIM_LIQ").cast("double").alias("price"),
    ).distinct()


def valid_quotas(quotas: DataFrame) -> DataFrame:
    """Rows whose quota is a finite number above zero."""
    return quotas.filter(is_finite("VL_QUOTA") & (F.col("VL_QUOTA") > 0))


def _highest_nav_first():
    return [F.desc_nulls_first("VL_PATRIM_LIQ"), F.desc("VL_QUOTA")]


def _classed(quotas: DataFrame) -> DataFrame:
    return quotas.filter(F.col("ID_SUBCLASSE").isNotNull())


def primary_classes(quotas: DataFrame) -> DataFrame:
    """(cnpj, ID_SUBCLASSE): per fund the class with the highest NAV on its latest date."""
    latest_first = [F.desc("DT_COMPTC"), *_highest_nav_first(), F.asc("ID_SUBCLASSE")]
    return top_n(_classed(quotas), ["cnpj"], latest_first, 1).select("cnpj", "ID_SUBCLASSE")


def primary_share_class(quotas: DataFrame) -> DataFrame:
    """Rows of each fund's primary share class, on all its dates."""
    return match_keys(_classed(quotas), primary_classes(quotas), ["cnpj", "ID_SUBCLASSE"])


def dedup_highest_nav(quotas: DataFrame) -> DataFrame:
    """One row per fund and date, the one with the highest NAV, where no class is given."""
    return top_n(
        quotas.filter(F.col("ID_SUBCLASSE").isNull()),
        ["cnpj", "DT_COMPTC"],
        _highest_nav_first(),
        1,
    )


def daily_nav(quotas: DataFrame) -> DataFrame:
    """(cnpj, date, period, quota_value), one row per fund and date.

    A row of the primary share class goes before a row without class. The input is
    first cut to one row per fund, date and class, on the map side too; after that a
    fund has at most one row per day and class, whatever its share of the input, and one
    exchange by fund serves the choice of class, the cut by date and the return windows.
    """
    valid = valid_quotas(quotas).select(
        "cnpj", "DT_COMPTC", "VL_QUOTA", "VL_PATRIM_LIQ", "ID_SUBCLASSE"
    )
    slim = top_n(valid, ["cnpj", "DT_COMPTC", "ID_SUBCLASSE"], _highest_nav_first(), 1)
    classed = F.col("ID_SUBCLASSE").isNotNull()
    latest_first = [F.desc("DT_COMPTC"), *_highest_nav_first(), F.asc("ID_SUBCLASSE")]
    of_fund = Window.partitionBy("cnpj").orderBy(classed.desc(), *latest_first)
    chosen = slim.repartition("cnpj").withColumn("_primary", F.first("ID_SUBCLASSE").over(of_fund))
    series = chosen.filter(~classed | (F.col("ID_SUBCLASSE") == F.col("_primary"))).select(
        "cnpj",
        as_date(quotas, "DT_COMPTC").alias("date"),
        F.col("VL_QUOTA").cast("double").alias("quota_value"),
        classed.alias("classed"),
    )
    of_day = Window.partitionBy("cnpj", "date").orderBy(F.desc("classed"), F.desc("quota_value"))
    return (
        series.withColumn("_place", F.row_number().over(of_day))
        .filter("_place = 1")
        .withColumn("period", period_of("date"))
        .select("cnpj", "date", "period", "quota_value")
    )


def daily_returns(nav: DataFrame) -> DataFrame:
    """Return on the fund's previous row, whatever the gap, with rank by latest date.

    ``nav`` has one row per fund and date, so a fund's window is bounded by the
    calendar. ``date_rank`` counts all rows, also the first, which has no return. It
    is taken from the ascending row number, so one sort serves everything.
    """
    by_date = Window.partitionBy("cnpj").orderBy("date")
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous = F.lag("quota_value").over(by_date)
    return (
        nav.withColumns(
            {
                "quota_value_previous": previous,
                "date_rank": F.count(F.lit(1)).over(whole) - F.row_number().over(by_date) + 1,
            }
        )
        .withColumn(
            "daily_return",
            F.try_divide(
                F.col("quota_value") - F.col("quota_value_previous"), "quota_value_previous"
            ),
        )
        .filter(is_finite("daily_return"))
        .select(
            "cnpj",
            "date",
            "period",
            "quota_value",
            "quota_value_previous",
            "daily_return",
            F.col("date_rank").cast("int").alias("date_rank"),
        )
    )


def monthly_returns(nav: DataFrame) -> DataFrame:
    """Return on the previous calendar month; none where that month is missing.

    A month with several prices has a return on each price of the month before.
    """
    dated = nav.withColumn("_month", month_index("period"))
    before = dated.select(
        "cnpj", (F.col("_month") + 1).alias("_month"), F.col("price").alias("price_previous")
    )
    latest_first = Window.partitionBy("cnpj").orderBy(
        F.desc("_month"), "price", "price_previous"
    )
    return (
        dated.join(before, ["cnpj", "_month"], "left")
        .withColumn("period_rank", F.row_number().over(latest_first))
        .withColumn(
            "monthly_return",
            F.try_divide(F.col("price") - F.col("price_previous"), "price_previous"),
        )
        .filter(is_finite("monthly_return"))
        .select("cnpj", "period", "price", "price_previous", "monthly_return", "period_rank")
    )
