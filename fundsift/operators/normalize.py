"""Features scaled to scores between 0 and 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.config import Settings
from fundsift.functions.columns import clip
from fundsift.functions.quantile import nearest_quantiles

# Score column -> (feature it scales, whether less is better).
SCORES = {
    "volatility_score": ("volatility_transformed", True),
    "sharpe_score": ("sharpe_selected", False),
    "liquidity_score": ("liquidity_score", False),
    "concentration_score": ("concentration_hhi", True),
    "asset_diversification_score": ("asset_diversification_hhi", True),
    "fund_age_score": ("fund_age_score", False),
    "credit_quality_score": ("credit_quality_score", False),
}


def log_transform(col: str | Column = "volatility") -> Column:
    return F.log1p(col)


def sharpe_fallback() -> Column:
    """12-month Sharpe ratio, else the 3-month one."""
    return F.coalesce("sharpe_12m", "sharpe_3m")


def winsorized(col: Column, lower: float | None, upper: float | None) -> Column:
    """Value clipped to the bounds and scaled to 0..1; null without a usable range."""
    if lower is None or upper is None:
        return F.lit(None).cast("double")
    return F.try_divide(clip(col, lower, upper) - F.lit(lower), F.lit(upper) - F.lit(lower))


def inverted(score: Column) -> Column:
    return F.lit(1.0) - score


def prepared(features: DataFrame, settings: Settings) -> DataFrame:
    """The seven columns that get scaled, before scaling."""
    vol = log_transform() if settings.use_log_volatility else F.col("volatility")
    derived = features.withColumns(
        {"volatility_transformed": vol, "sharpe_selected": sharpe_fallback()}
    )
    return derived.select("cnpj", *[source for source, _ in SCORES.values()])


def score_bounds(ready: DataFrame, settings: Settings) -> dict[str, list[float | None]]:
    shares = [settings.normalization_lower_percentile, settings.normalization_upper_percentile]
    return nearest_quantiles(ready, [source for source, _ in SCORES.values()], shares)


def scoring_input(features: DataFrame, settings: Settings) -> DataFrame:
    """(cnpj and seven scores), scaled between the outer percentiles over all funds.

    The percentiles need passes of their own, so pass features that are stored or
    materialized. When all Sharpe ratios are equal, they score 1.
    """
    ready = prepared(features, settings)
    bounds = score_bounds(ready, settings)
    scores = []
    for name, (source, less_is_better) in SCORES.items():
        low, high = bounds[source]
        score = winsorized(F.col(source), low, high)
        if name == "sharpe_score" and low is not None and low == high:
            score = F.when(F.col(source).isNotNull(), 1.0)
        scores.append((inverted(score) if less_is_better else score).alias(name))
    return ready.select("cnpj", *scores)
