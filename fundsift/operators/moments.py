"""Volatility and Sharpe ratios at the end of every month from mergeable monthly moments.

Per fund and month there are the number of returns, their mean, the sum of squared deviations from
it, and the returns themselves, latest first: at most one a day. Moments of two sets give those of
both, so whole months are merged as they are, and only of the month in which a window of
trading days begins are single returns taken. A new month adds its own row to each fund.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.config import Settings
from fundsift.operators.features import _sharpe

def _moments(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), mean.cast("double").alias("mean"), m2.cast("double").alias("m2"))


def nothing() -> Column:
    return _moments(F.lit(0), F.lit(0.0), F.lit(0.0))


def merged(a: Column, b: Column) -> Column:
    """Moments of two sets together, by the pairwise formula; either may be empty."""
    n = a["n"] + b["n"]
    step = b["mean"] - a["mean"]
    share = F.when(n > 0, b["n"] / n).otherwise(0.0)
    return _moments(n, a["mean"] + step * share, a["m2"] + b["m2"] + step * step * a["n"] * share)


def with_value(a: Column, value: Column) -> Column:
    """Moments of a set and one more number."""
    n = a["n"] + 1
    step = value - a["mean"]
    return _moments(n, a["mean"] + step / n, a["m2"] + step * step * a["n"] / n)


def monthly_moments(returns: DataFrame) -> DataFrame:
    """(cnpj, period, moments, latest_first) of daily returns: one row per fund and month with returns.

    Takes the columns cnpj, date, period and daily_return; null returns do not count. Rows of the same day
    count one by one, the larger return as the later one.
    """
    value = F.col("daily_return").cast("double")
    dated = F.sort_array(F.collect_list(F.struct("date", value.alias("value"))), asc=False)
    grouped = returns.filter("daily_return IS NOT NULL").groupBy("cnpj", "period")
    n = F.count(F.lit(1))
    found = grouped.agg(_moments(n, F.avg(value), F.var_pop(value) * n).alias("moments"), dated.alias("dated"))
    return found.select("cnpj", "period", "moments", F.col("dated.value").alias("latest_first"))


def _so_far(moments: Column) -> Column:
    """Moments of all months up to each one, from an array of months in order; one more in front."""
    start = F.array(nothing())
    return F.aggregate(moments, start, lambda found, m: F.array_append(found, merged(F.element_at(found, -1), m)))


def _last(days: int, months: Column, counts: Column, place: Column) -> Column:
    """Moments of the last ``days`` returns up to the month at ``place``, from 1.

    ``counts``, of returns up to each month, tell where the window begins, so that no earlier month is merged.
    """

    def begin(left_out: Column) -> Column:
        outside = F.size(F.filter(counts, lambda n: n < left_out))
        return F.struct(outside.alias("outside"), left_out.alias("left_out"))

    def add_up(window: Column) -> Column:
        outside = window["outside"]
        whole = F.reverse(F.slice(months, outside + 1, place - outside))
        found = F.aggregate(whole, nothing(), lambda found, month: merged(found, month["moments"]))
        # Of the month in which the window begins, only the latest returns.
        some = (F.element_at(counts, outside + 1) - window["left_out"]).cast("int")
        first = F.slice(F.element_at(months, outside)["latest_first"], 1, some)
        return F.when(outside > 0, F.aggregate(first, found, with_value)).otherwise(found)

    # Arrays of one, so that what is used several times is worked out once.
    windows = F.transform(F.array(F.element_at(counts, place + 1) - days), begin)
    return F.transform(windows, add_up)[0]


def with_windows(months: DataFrame, settings: Settings) -> DataFrame:
    """(cnpj, period, all, long, short) from monthly moments: moments up to each month's end.

    ``long`` and ``short`` are those of the last 252 and 63 returns (``Settings``). One exchange brings
    a fund's months together: at most one number for each day of its history.
    """
    sizes = {"long": settings.trading_days_12m, "short": settings.trading_days_3m}
    in_order = F.array_sort(F.collect_list(F.struct("period", "moments", "latest_first")))
    funds = months.groupBy("cnpj").agg(in_order.alias("months"))
    funds = funds.withColumn("so_far", _so_far(F.col("months.moments"))).withColumn("counts", F.col("so_far.n"))

    def at(place: Column) -> Column:
        return F.struct(
            F.element_at("months", place)["period"].alias("period"),
            F.element_at("so_far", place + 1).alias("all"),
            *[_last(days, F.col("months"), F.col("counts"), place).alias(name) for name, days in sizes.items()],
        )

    ends = F.transform(F.sequence(F.lit(1), F.size("months")), at)
    return funds.select("cnpj", F.inline(ends))


def by_month(months: DataFrame, settings: Settings) -> DataFrame:
    """Annualised volatilities and capped Sharpe ratios of each fund at the end of each of its months.

    (cnpj, period, volatility, volatility_12m, volatility_3m, sharpe_12m, sharpe_3m), for each period as
    ``features.volatility`` and ``features.sharpe_ratio`` have them for it.
    """
    long = settings.trading_days_12m

    def volatility(name: str) -> Column:
        m = F.col(name)
        return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1))) * math.sqrt(long)

    def excess(name: str) -> Column:
        m = F.col(name)
        return F.when(m["n"] > 0, m["mean"] - F.lit(settings.risk_free_rate_daily)) * long

    return (
        with_windows(months, settings)
        .select(
            "cnpj",
            "period",
            volatility("all").alias("volatility"),
            volatility("long").alias("volatility_12m"),
            volatility("short").alias("volatility_3m"),
            excess("long").alias("excess_12m"),
            excess("short").alias("excess_3m"),
        )
        .withColumns(
            {
                "sharpe_12m": _sharpe("excess_12m", "volatility_12m", settings),
                "sharpe_3m": _sharpe("excess_3m", "volatility_3m", settings),
            }
        )
        .drop("excess_12m", "excess_3m")
    )
