"""Scores per investor profile, rankings and shortlists."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.config import FEATURE_WEIGHTS, Profile, Settings
from fundsift.functions.columns import cnpj_to_formatted, is_finite, one_of
from fundsift.operators.ranking import rank_within, top_n


def with_profiles(scores: DataFrame, profiles: tuple[Profile, ...]) -> DataFrame:
    """Every fund once per profile, with that profile's weights as ``w_*`` columns.

    The profiles are a literal array, so this is a projection, not a join.
    """
    literal = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("investor_profile"),
                *[F.lit(float(getattr(p, w))).alias(f"w_{w}") for w in FEATURE_WEIGHTS.values()],
            )
            for p in profiles
        ]
    )
    return scores.select("*", F.inline(literal))


def available(feature: str) -> Column:
    return is_finite(feature).cast("int")


def pct_features_considered() -> Column:
    """Share of the features that a fund has, in percent."""
    return reduce(add, map(available, FEATURE_WEIGHTS)) / len(FEATURE_WEIGHTS) * 100


def available_weight() -> Column:
    return reduce(add, [F.col(f"w_{w}") * available(f) for f, w in FEATURE_WEIGHTS.items()])


def weighted_score(weight_sum: Column) -> Column:
    """Mean of the available features under the profile's weights.

    0 without any feature; null when the features there are all weigh nothing.
    """
    return reduce(
        add,
        [
            F.when(is_finite(f), F.try_divide(F.col(f"w_{w}"), weight_sum) * F.col(f)).otherwise(
                0.0
            )
            for f, w in FEATURE_WEIGHTS.items()
        ],
    )


def coverage_penalty(gamma: float) -> Column:
    """Factor between ``gamma`` (no feature) and 1 (all features)."""
    return F.lit(gamma) + F.lit(1 - gamma) * (F.col("pct_features_considered") / 100)


def profile_scores(scores: DataFrame, settings: Settings) -> DataFrame:
    """(cnpj, investor_profile, score, pct_features_considered), not ranked."""
    return (
        with_profiles(scores, settings.profiles)
        .withColumn("_weight", available_weight())
        .withColumn("pct_features_considered", pct_features_considered())
        .select(
            "cnpj",
            "investor_profile",
            (
                weighted_score(F.col("_weight"))
                * coverage_penalty(settings.gamma_coverage_penalty)
            ).alias("score"),
            "pct_features_considered",
        )
    )


def best_first() -> list[Column]:
    return [F.desc_nulls_last("score"), F.asc("cnpj")]


def rank_profiles(scored: DataFrame) -> DataFrame:
    """Adds ``rank`` within the profile, best score first; no score, no rank."""
    ranked = rank_within(scored, "investor_profile", best_first(), "rank")
    return ranked.withColumn("rank", F.when(F.col("score").isNotNull(), F.col("rank"))).select(
        "cnpj", "investor_profile", "score", "rank", "pct_features_considered"
    )


def scores_per_profile(scores: DataFrame, settings: Settings) -> DataFrame:
    return rank_profiles(profile_scores(scores, settings))


def profile_filter(profiles: tuple[Profile, ...], collation: str | None = None) -> Column:
    """True where a row meets the allow-lists of its profile."""
    rules = []
    for p in profiles:
        wanted = []
        if p.target_investor_profile is not None:
            wanted.append(one_of("target_investor_type", p.target_investor_profile, collation))
        if p.allowed_fund_subtypes is not None:
            wanted.append(one_of("fund_subtype", p.allowed_fund_subtypes, collation))
        if wanted:
            rules.append((F.col("investor_profile") != p.name) | reduce(and_, wanted))
    return reduce(and_, rules) if rules else F.lit(True)


def eligible(
    scored: DataFrame, guardrail_mark: DataFrame, characteristics: DataFrame, settings: Settings
) -> DataFrame:
    """Scored rows of funds that pass the guardrails and meet their profile's lists."""
    passing = guardrail_mark.filter("pass_guardrail").select("cnpj")
    attributes = characteristics.select(
        "cnpj", "target_investor_type", "fund_subtype", "fund_manager", "commercial_name"
    )
    return (
        scored.filter(F.col("score").isNotNull())
        .join(passing, "cnpj", "left_semi")
        .join(attributes, "cnpj", "left")
        .filter(profile_filter(settings.profiles, settings.collation))
    )


def _report(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        cnpj_to_formatted("cnpj").alias("CNPJ"),
        F.col("commercial_name").alias("Fund Name"),
        F.col("investor_profile").alias("Investor Profile"),
        F.round("score", 3).alias("Score"),
        F.col("Rank"),
    )


_RANKED_COLUMNS = ("cnpj", "investor_profile", "score", "commercial_name")


def complete_ranking(eligible_scores: DataFrame) -> DataFrame:
    """All eligible funds, ranked anew within their profile."""
    return _report(
        rank_within(
            eligible_scores.select(*_RANKED_COLUMNS), "investor_profile", best_first(), "Rank"
        )
    )


def shortlist(eligible_scores: DataFrame, n: int) -> DataFrame:
    """The best ``n`` funds of each profile. Needs no complete ranking."""
    return _report(
        top_n(
            eligible_scores.select(*_RANKED_COLUMNS), ["investor_profile"], best_first(), n, "Rank"
        )
    )
