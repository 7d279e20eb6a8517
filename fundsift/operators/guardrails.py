"""Quality rules that a scored fund must meet, each giving (cnpj, failed).

A rule that is switched off fails nobody; missing evidence fails a fund.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.config import GUARDRAIL_NAMES, Guardrail
from fundsift.functions.columns import as_date


def _funds(scored: DataFrame) -> DataFrame:
    return scored.select("cnpj").distinct()


def _below(value: str, minimum: float) -> Column:
    return F.col(value).isNull() | (F.col(value) < minimum)


def _check(scored: DataFrame, rule: Guardrail, evidence, failed: Column) -> DataFrame:
    funds = _funds(scored)
    if not rule.active:
        return funds.withColumn("failed", F.lit(False))
    return funds.join(evidence(), "cnpj", "left").select("cnpj", failed.alias("failed"))


def manager_sizes(characteristics: DataFrame, managers: DataFrame) -> DataFrame:
    """Per fund: its manager and how many active funds that manager has.

    One small row per fund on one side, one per manager on the other. Adaptive execution
    sends the managers to every task if they turn out small, and else splits the join
    partition of a manager that has very many funds.
    """
    return characteristics.select("cnpj", "fund_manager").join(
        managers.select("fund_manager", "num_funds"), "fund_manager", "left"
    )


def min_offer_per_issuer(
    scored: DataFrame, managers: DataFrame, characteristics: DataFrame, rule: Guardrail
) -> DataFrame:
    """Fails funds whose manager is unknown or has too few active funds."""
    failed = F.col("fund_manager").isNull() | _below("num_funds", rule.threshold or 0)
    return _check(scored, rule, lambda: manager_sizes(characteristics, managers), failed)


def min_sharpe(scored: DataFrame, sharpe: DataFrame, window: str, rule: Guardrail) -> DataFrame:
    """Fails funds without a Sharpe ratio over ``12m`` or ``3m``, or with one too low."""
    column = f"sharpe_{window}"
    return _check(
        scored, rule, lambda: sharpe.select("cnpj", column), _below(column, rule.threshold or 0.0)
    )


def no_funds_without_manager(
    scored: DataFrame, characteristics: DataFrame, rule: Guardrail
) -> DataFrame:
    return _check(
        scored,
        rule,
        lambda: characteristics.select("cnpj", "fund_manager"),
        F.col("fund_manager").isNull(),
    )


def only_active_funds(
    scored: DataFrame, returns: DataFrame, max_ref_date: str | Column, rule: Guardrail
) -> DataFrame:
    """Fails funds without a return on the latest date of the data."""
    ref = F.to_date(F.lit(max_ref_date)) if isinstance(max_ref_date, str) else max_ref_date
    latest = (
        lambda: returns.filter(as_date(returns, "date") == ref)
        .select("cnpj")
        .distinct()
        .withColumn("has_latest_data", F.lit(True))
    )
    return _check(scored, rule, latest, F.col("has_latest_data").isNull())


def no_extreme_returns(scored: DataFrame, returns: DataFrame, rule: Guardrail) -> DataFrame:
    """Fails funds with any daily return beyond the limit, in either direction."""
    limit = 0.10 if rule.threshold is None else rule.threshold
    extreme = (
        lambda: returns.filter(F.abs("daily_return") > limit)
        .select("cnpj")
        .distinct()
        .withColumn("has_extreme_return", F.lit(True))
    )
    return _check(scored, rule, extreme, F.col("has_extreme_return").isNotNull())


def min_coverage(scored: DataFrame, sharpe: DataFrame, window: str, rule: Guardrail) -> DataFrame:
    """Fails funds whose ``12m`` or ``3m`` window holds too few returns."""
    column = f"pct_cov_{window}"
    return _check(
        scored, rule, lambda: sharpe.select("cnpj", column), _below(column, rule.threshold or 0.0)
    )


def _mark(failed: dict[str, Column]) -> list[Column]:
    names = F.concat_ws(",", *[F.when(failed[n], F.lit(n)) for n in GUARDRAIL_NAMES])
    return [
        (~reduce(or_, [failed[n] for n in GUARDRAIL_NAMES])).alias("pass_guardrail"),
        F.nullif(names, F.lit("")).alias("failed_guardrails"),
    ]


def merge_guardrails(results: Mapping[str, DataFrame]) -> DataFrame:
    """(cnpj, pass_guardrail, failed_guardrails) from the eight separate results."""
    first, *rest = GUARDRAIL_NAMES
    merged = results[first].withColumnRenamed("failed", first)
    for name in rest:
        merged = merged.join(results[name].withColumnRenamed("failed", name), "cnpj", "left")
    failed = {n: F.coalesce(F.col(n), F.lit(False)) for n in GUARDRAIL_NAMES}
    return merged.select("cnpj", *_mark(failed))


def guardrail_mark(evidence: DataFrame, rules: Mapping[str, Guardrail]) -> DataFrame:
    """The same mark from one table with all evidence per fund.

    ``evidence`` has fund_manager, num_funds, both Sharpe ratios and coverages,
    has_latest_data and max_abs_return; one projection replaces eight joins.
    """
    limit = rules["no_extreme_returns"].threshold
    conditions = {
        "min_offer_per_issuer": F.col("fund_manager").isNull()
        | _below("num_funds", rules["min_offer_per_issuer"].threshold or 0),
        "min_sharpe_12m": _below("sharpe_12m", rules["min_sharpe_12m"].threshold or 0.0),
        "min_sharpe_3m": _below("sharpe_3m", rules["min_sharpe_3m"].threshold or 0.0),
        "no_funds_wo_manager": F.col("fund_manager").isNull(),
        "include_only_active_funds": ~F.coalesce("has_latest_data", F.lit(False)),
        "no_extreme_returns": F.coalesce(
            F.col("max_abs_return") > (0.10 if limit is None else limit), F.lit(False)
        ),
        "min_cov_sharpe_12m": _below(
            "pct_cov_12m", rules["min_cov_sharpe_12m"].threshold or 0.0
        ),
        "min_cov_sharpe_3m": _below("pct_cov_3m", rules["min_cov_sharpe_3m"].threshold or 0.0),
    }
    failed = {n: c if rules[n].active else F.lit(False) for n, c in conditions.items()}
    return evidence.select("cnpj", *_mark(failed))
