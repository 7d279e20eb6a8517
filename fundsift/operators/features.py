"""Risk and portfolio features, one row per fund."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundsift.config import CreditRating, Settings
from fundsift.functions.columns import as_date, clip, is_finite, nan_to_null, period_end
from fundsift.operators.ranking import top_n


def up_to_period(returns: DataFrame, latest_period: int) -> DataFrame:
    """Rows dated no later than the end of the period."""
    return returns.filter(as_date(returns, "date") <= period_end(latest_period))


def last_n_days(returns: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each fund, all where it has fewer."""
    return top_n(returns, ["cnpj"], [F.desc("date")], n)


def _with_recency(returns: DataFrame, latest_period: int) -> DataFrame:
    """Adds ``recency``: 1 for a fund's last row up to the period's end, null after it.

    One ascending sort by date per fund; a table already laid out that way (daily
    NAV, returns) is neither shuffled nor sorted again.
    """
    by_date = Window.partitionBy("cnpj").orderBy("date")
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_time = as_date(returns, "date") <= period_end(latest_period)
    return returns.withColumns(
        {
            "_row": F.row_number().over(by_date),
            "_rows": F.count(F.when(in_time, 1)).over(whole),
        }
    ).withColumn("recency", F.when(in_time, F.col("_rows") - F.col("_row") + 1))


def _window_aggregates(settings: Settings) -> dict[str, Column]:
    """Volatility and excess return of all windows as aggregates of one group-by."""
    long, short = settings.trading_days_12m, settings.trading_days_3m
    recency, value = F.col("recency"), F.col("daily_return")
    scale = math.sqrt(long)

    def within(n: int, what: Column) -> Column:
        return F.when(recency <= n, what)

    def excess(n: int) -> Column:
        return F.avg(within(n, value - F.lit(settings.risk_free_rate_daily))) * long

    return {
        "volatility": F.stddev_samp(F.when(recency.isNotNull(), value)) * scale,
        "volatility_12m": F.stddev_samp(within(long, value)) * scale,
        "volatility_3m": F.stddev_samp(within(short, value)) * scale,
        "excess_return_12m": excess(long),
        "excess_return_3m": excess(short),
        "n_obs_12m": F.count_if(recency <= long),
        "n_obs_3m": F.count_if(recency <= short),
        "n_obs": F.count(recency),
    }


def _sharpe(excess: str, volatility: str, settings: Settings) -> Column:
    usable = (
        is_finite(volatility)
        & (F.col(volatility) > settings.epsilon_volatility)
        & is_finite(excess)
    )
    ratio = F.when(usable, F.try_divide(excess, volatility))
    return clip(ratio, -settings.sharpe_cap, settings.sharpe_cap)


def _sharpe_columns(settings: Settings) -> dict[str, Column]:
    return {
        "sharpe_12m": _sharpe("excess_return_12m", "volatility_12m", settings),
        "sharpe_3m": _sharpe("excess_return_3m", "volatility_3m", settings),
        "pct_cov_12m": F.col("n_obs_12m") / settings.trading_days_12m,
        "pct_cov_3m": F.col("n_obs_3m") / settings.trading_days_3m,
    }


def return_evidence(
    returns: DataFrame, latest_period: int, max_ref_date: str | Column, settings: Settings
) -> DataFrame:
    """Everything later steps need from the returns, in one pass over them.

    Volatilities, Sharpe ratios and coverage up to the period's end; over the full
    history, whether the fund has a return on ``max_ref_date`` and its largest daily
    move.
    """
    ref = F.to_date(F.lit(max_ref_date)) if isinstance(max_ref_date, str) else max_ref_date
    return (
        _with_recency(returns, latest_period)
        .groupBy("cnpj")
        .agg(
            *[c.alias(name) for name, c in _window_aggregates(settings).items()],
            F.coalesce(F.bool_or(as_date(returns, "date") == ref), F.lit(False)).alias(
                "has_latest_data"
            ),
            F.max(F.abs("daily_return")).alias("max_abs_return"),
        )
        .withColumns(_sharpe_columns(settings))
    )


def volatility(returns: DataFrame, latest_period: int, settings: Settings) -> DataFrame:
    """Annualised volatility over all rows, the last 12 and the last 3 months of rows."""
    wanted = _window_aggregates(settings)
    return (
        _with_recency(returns, latest_period)
        .filter(F.col("recency").isNotNull())
        .groupBy("cnpj")
        .agg(
            *[wanted[c].alias(c) for c in ("volatility", "volatility_12m", "volatility_3m")]
        )
        .select(
            "cnpj",
            period_end(latest_period).alias("ref_date"),
            "volatility",
            "volatility_12m",
            "volatility_3m",
        )
    )


def sharpe_ratio(
    returns: DataFrame,
    latest_period: int,
    settings: Settings,
    volatility_per_fund: DataFrame | None = None,
) -> DataFrame:
    """Annualised Sharpe ratios, capped, and the coverage of their windows.

    Volatilities come from ``volatility_per_fund`` if given, else from the same pass.
    """
    columns = dict(_window_aggregates(settings))
    if volatility_per_fund is not None:
        columns = {k: c for k, c in columns.items() if not k.startswith("volatility")}
    per_fund = (
        _with_recency(returns, latest_period)
        .filter(F.col("recency").isNotNull())
        .groupBy("cnpj")
        .agg(*[c.alias(name) for name, c in columns.items()])
    )
    if volatility_per_fund is not None:
        per_fund = per_fund.join(
            volatility_per_fund.select("cnpj", "volatility_12m", "volatility_3m"), "cnpj", "left"
        )
    return per_fund.withColumns(_sharpe_columns(settings)).select(
        "cnpj", "sharpe_12m", "sharpe_3m", "pct_cov_12m", "pct_cov_3m"
    )


def liquidity(characteristics: DataFrame) -> DataFrame:
    """Redemption days scaled over active funds, fast is 1; inactive funds get 0."""
    active = F.col("is_active") == 1
    span = (
        characteristics.filter(active)
        .agg(
            F.struct(
                F.min("redemption_days").alias("lo"), F.max("redemption_days").alias("hi")
            ).alias("span")
        )
        .scalar()
    )
    low, high = span["lo"], span["hi"]
    scaled = F.lit(1.0) - F.try_divide(F.col("redemption_days") - low, high - low)
    return characteristics.select(
        "cnpj",
        "redemption_days",
        "is_active",
        F.when(active, F.when(high > low, scaled).otherwise(1.0))
        .otherwise(0.0)
        .alias("liquidity_score"),
    )


def _active(prices: DataFrame) -> DataFrame:
    return prices.filter(F.col("is_active") == 1)


def _hhi(total: Column, squares: Column, any_value: Column) -> Column:
    """Sum of squared weights; 0 without any value, null when all values are zero."""
    return F.when(any_value, F.try_divide(squares, total * total)).otherwise(0.0)


def concentration(prices: DataFrame) -> DataFrame:
    """Herfindahl index over the current positions, by absolute value."""
    value = F.col("position_value")
    return (
        _active(prices)
        .groupBy("cnpj")
        .agg(
            _hhi(F.sum(F.abs(value)), F.sum(value * value), F.count(value) > 0).alias(
                "concentration_hhi"
            ),
            F.count_distinct("instrument_id").alias("concentration_num_holdings"),
        )
    )


def _by_asset_type(positions: DataFrame, *more: Column) -> DataFrame:
    return positions.groupBy("cnpj", "asset_type").agg(
        F.coalesce(F.sum(F.abs("position_value")), F.lit(0.0)).alias("gross"), *more
    )


def asset_diversification(prices: DataFrame) -> DataFrame:
    """Herfindahl index and largest share over asset types of the current positions."""
    gross = F.col("gross")
    return (
        _by_asset_type(_active(prices).filter(F.col("asset_type").isNotNull()))
        .groupBy("cnpj")
        .agg(
            F.sum(gross).alias("total"),
            F.sum(gross * gross).alias("squares"),
            F.max(gross).alias("largest"),
        )
        .filter(F.col("total") > 0)
        .select(
            "cnpj",
            (F.col("squares") / (F.col("total") * F.col("total"))).alias(
                "asset_diversification_hhi"
            ),
            (F.col("largest") / F.col("total")).alias("top_category_pct"),
        )
    )


def _rating_score(rating: Column, scale: CreditRating) -> Column:
    """Score of a rating, null when the scale does not have it."""
    pairs = []
    for i, name in enumerate(scale.order):
        pairs += [F.lit(name), F.lit(scale.score_of(i))]
    return F.try_element_at(F.create_map(*pairs), rating)


def _credit_score(scale: CreditRating) -> Column:
    return (
        F.col("avg_rating_score") * scale.weight_avg_rating_score
        + F.col("pct_investment_grade") * scale.weight_investment_grade
    )


def credit_quality(rating: DataFrame, prices: DataFrame, scale: CreditRating) -> DataFrame:
    """Mean rating score and share of investment grade over the rated current positions.

    Positions whose rating is not on the scale are left out before averaging.
    """
    scored = (
        _active(prices)
        .select("cnpj", "instrument_id", "period")
        .join(
            rating.filter(F.col("credit_rating").isin(*scale.order)),
            ["cnpj", "instrument_id", "period"],
        )
    )
    good = F.col("credit_rating").isin(*scale.investment_grade)
    return (
        scored.groupBy("cnpj")
        .agg(
            (F.count("credit_rating") / F.count(F.lit(1))).alias("pct_rated"),
            F.avg(_rating_score(F.col("credit_rating"), scale)).alias("avg_rating_score"),
            (F.count_if(good) / F.count(F.lit(1))).alias("pct_investment_grade"),
        )
        .withColumn("credit_quality_score", _credit_score(scale))
    )


def portfolio_features(holdings: DataFrame, latest_period: int, scale: CreditRating) -> DataFrame:
    """Concentration, asset diversification and credit quality in one pass.

    A price and its rating sit on the same holdings row, so no ids, no self join: the
    positions are summed per fund and asset type, then per fund. Same values as the
    three separate operators.
    """
    positions = holdings.filter(F.col("period") == latest_period).select(
        "cnpj",
        F.col("TP_ATIVO").alias("asset_type"),
        F.col("VL_MERC_POS_FINAL").cast("double").alias("position_value"),
        F.when(
            (F.col("blc_type") == "blc_5") & F.col("GRAU_RISCO").isin(*scale.order),
            F.col("GRAU_RISCO"),
        ).alias("rating"),
    )
    value, rating = F.col("position_value"), F.col("rating")
    typed = F.col("asset_type").isNotNull()
    gross = F.when(typed, F.col("gross"))
    return (
        _by_asset_type(
            positions,
            F.sum(value * value).alias("squares"),
            F.count(value).alias("n_values"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(rating).alias("n_rated"),
            F.sum(_rating_score(rating, scale)).alias("rating_sum"),
            F.count_if(rating.isin(*scale.investment_grade)).alias("n_good"),
        )
        .groupBy("cnpj")
        .agg(
            _hhi(F.sum("gross"), F.sum("squares"), F.sum("n_values") > 0).alias(
                "concentration_hhi"
            ),
            F.sum("n_rows").alias("concentration_num_holdings"),
            F.sum(gross).alias("type_total"),
            F.sum(gross * gross).alias("type_squares"),
            F.max(gross).alias("type_largest"),
            F.sum("n_rated").alias("n_rated"),
            F.sum("rating_sum").alias("rating_sum"),
            F.sum("n_good").alias("n_good"),
        )
        .withColumns(
            {
                "asset_diversification_hhi": F.try_divide(
                    "type_squares", F.col("type_total") * F.col("type_total")
                ),
                "top_category_pct": F.try_divide("type_largest", "type_total"),
                "pct_rated": F.when(F.col("n_rated") > 0, 1.0),
                "avg_rating_score": F.try_divide("rating_sum", "n_rated"),
                "pct_investment_grade": F.try_divide("n_good", "n_rated"),
            }
        )
        .withColumn("credit_quality_score", _credit_score(scale))
        .drop(
            "type_total", "type_squares", "type_largest", "n_rated", "rating_sum", "n_good"
        )
    )


def fund_age(
    characteristics: DataFrame, cap_years: float, as_of: str | None = None
) -> DataFrame:
    """Days and years since inception and a score that reaches 1 at ``cap_years``."""
    today = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    days = F.datediff(today, as_date(characteristics, "inception_date"))
    years = days / 365.0
    return characteristics.select(
        "cnpj",
        "inception_date",
        days.alias("fund_age_days"),
        years.alias("fund_age_years"),
        clip(years / cap_years, 0.0, 1.0).alias("fund_age_score"),
    )


def merge_features(characteristics: DataFrame, *features: DataFrame) -> DataFrame:
    """Active funds with the columns of every feature table, null where absent, no NaN.

    A column two tables share is taken from the first; the key joins are all on the
    fund, so tables already partitioned by it are not shuffled again.
    """
    merged = characteristics.filter(F.col("is_active") == 1).select("cnpj", "is_active")
    for table in features:
        fresh = [c for c in table.columns if c not in merged.columns]
        merged = merged.join(table.select("cnpj", *fresh), "cnpj", "left")
    return merged.withColumns(
        {
            f.name: nan_to_null(f.name)
            for f in merged.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )
