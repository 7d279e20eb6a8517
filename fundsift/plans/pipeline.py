"""The whole analysis, stage by stage.

Each stage takes and returns tables. Facts (quotas, holdings) are read once per use
and cut down to one row per fund as early as possible; what several later steps share
is materialized at that size.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.config import RATING_ORDER, Settings
from fundsift.operators import (
    features,
    guardrails,
    holdings,
    normalize,
    primary,
    quality,
    scope,
    scoring,
)
from fundsift.operators import registry as reg
from fundsift.operators import repair
from fundsift.session import materialize
from fundsift.sources import files, records, schemas, sinks

# Checks of tables as they come in, and of the tables made from them.
INPUT_CHECKS = {
    "monthly_nav": {
        "validate_uniqueness": {
            "group_columns": ["CNPJ_FUNDO_CLASSE", "DT_COMPTC", "VL_PATRIM_LIQ"]
        },
        "validate_bounds": {
            "value_column": "VL_PATRIM_LIQ",
            "identifier_column": "CNPJ_FUNDO_CLASSE",
            "lower_bound": 0,
        },
    },
    "blc_5": {
        "validate_allowed_values": {
            "value_column": "GRAU_RISCO",
            "allowed_values": list(RATING_ORDER),
        }
    },
}
OUTPUT_CHECKS = {
    "funds_in_scope": {"validate_uniqueness": {"group_columns": ["cnpj"]}},
    "daily_quotas": {
        "validate_uniqueness": {"group_columns": ["cnpj", "DT_COMPTC"]},
        "validate_bounds": {
            "value_column": "VL_QUOTA",
            "identifier_column": "cnpj",
            "lower_bound": 0,
        },
    },
    "monthly_pl": {
        "validate_uniqueness": {"group_columns": ["cnpj", "DT_COMPTC"]},
        "validate_bounds": {
            "value_column": "VL_PATRIM_LIQ",
            "identifier_column": "cnpj",
            "lower_bound": 0,
        },
    },
    "daily_nav": {
        "validate_time_completeness": {
            "time_column": "date",
            "group_column": "cnpj",
            "date_format": "%Y-%m-%d",
        },
        "validate_uniqueness": {"group_columns": ["cnpj", "date"]},
    },
    "daily_returns": {
        "validate_time_completeness": {
            "time_column": "date",
            "group_column": "cnpj",
            "date_format": "%Y-%m-%d",
        },
        "validate_uniqueness": {"group_columns": ["cnpj", "date"]},
    },
    "nav_per_period": {
        "validate_time_completeness": {"time_column": "period", "group_column": "cnpj"},
        "validate_uniqueness": {"group_columns": ["cnpj", "period"]},
    },
    "instrument_prices": {"validate_uniqueness": {"group_columns": ["instrument_id", "period"]}},
}


@dataclass(frozen=True)
class Raw:
    """The input tables, new column names or old ones.

    Holdings are a table per family, or one table with the family as ``blc_type``.
    """

    monthly_nav: DataFrame
    daily_quotas: DataFrame
    holdings: Mapping[str, DataFrame] | DataFrame
    registry: DataFrame
    #: Latest period of the quotas, where the names of their files tell it.
    latest_period: int | None = None

    def family(self, name: str) -> DataFrame:
        if isinstance(self.holdings, DataFrame):
            return self.holdings.filter(F.col("blc_type") == name)
        return self.holdings[name]


@dataclass(frozen=True)
class Intermediate:
    scope: DataFrame
    monthly_pl: DataFrame
    daily_quotas: DataFrame
    holdings: DataFrame


@dataclass(frozen=True)
class Primary:
    daily_nav: DataFrame
    daily_returns: DataFrame
    nav_per_period: DataFrame
    characteristics: DataFrame
    managers: DataFrame
    instrument_prices: DataFrame
    instrument_rating: DataFrame


@dataclass(frozen=True)
class Ranking:
    scores: DataFrame
    guardrail_mark: DataFrame
    shortlist: DataFrame
    complete_ranking: DataFrame


def read_raw(
    spark: SparkSession,
    root: str,
    registry_path: str,
    settings: Settings,
    repaired: bool = True,
    line_breaks: bool = False,
) -> Raw:
    """Raw tables from folders ``monthly/pl``, ``monthly/blc_1`` .. and ``daily/quotas``.

    With ``repaired`` the monthly files go through the quote repair before parsing. With
    ``line_breaks`` quoted fields of theirs may hold line breaks, so lines cannot be repaired.
    """
    if repaired and line_breaks:
        raise ValueError("lines of records with line breaks cannot be repaired one by one")
    n = settings.num_period_months

    def monthly(folder: str, declared) -> DataFrame:
        path = f"{root}/monthly/{folder}"
        if line_breaks:
            return records.scan_quoted_csv(spark, path, declared, n)
        if not repaired:
            return files.scan_partitioned_csv(spark, path, declared, n)
        parsed = [
            files.parse_lines(repair.repair(lines), header, declared)
            for header, lines in files.raw_lines(spark, path, n).items()
        ]
        return files.add_missing(files.drift_union(parsed), declared)

    return Raw(
        monthly_nav=monthly("pl", schemas.MONTHLY_NAV),
        daily_quotas=files.scan_partitioned_csv(
            spark, f"{root}/daily/quotas", schemas.DAILY_QUOTAS, n
        ),
        holdings={
            family: monthly(family, schemas.HOLDINGS[family])
            for family in schemas.PORTFOLIO_FAMILIES
        },
        registry=files.registry_source(spark, registry_path, schemas.REGISTRY),
        latest_period=files.max_period(spark, f"{root}/daily/quotas"),
    )


def with_reference_dates(raw: Raw, settings: Settings) -> Settings:
    """Settings with the latest period and date, taken from the quotas where not given.

    Where file names have told the latest period, only its files are read for the latest date.
    """
    if settings.max_period is None:
        latest = raw.latest_period or raw.daily_quotas.agg(F.max("period")).first()[0]
        settings = replace(settings, max_period=latest)
    if settings.max_ref_date is None:
        ref = files.max_ref_date(raw.daily_quotas, settings.max_period).first()[0]
        settings = replace(settings, max_ref_date=str(ref))
    return settings


def intermediate(raw: Raw, settings: Settings) -> Intermediate:
    """Funds in scope, and the raw tables cut down to them.

    The scope is stored once; adaptive execution decides whether it is sent to all tasks.
    """
    ids = materialize(
        scope.funds_in_scope(raw.monthly_nav, raw.registry, settings.max_period, settings)
    )
    return Intermediate(
        scope=ids,
        monthly_pl=scope.normalize_monthly_nav(raw.monthly_nav, ids),
        daily_quotas=scope.normalize_daily_quotas(raw.daily_quotas, ids),
        holdings=scope.normalize_holdings(raw.holdings, ids),
    )


def primary_tables(inter: Intermediate, registry: DataFrame, settings: Settings) -> Primary:
    daily = primary.daily_nav(inter.daily_quotas)
    instruments = holdings.instrument_registry(inter.holdings)
    characteristics = materialize(
        reg.assert_unique(reg.fund_characteristics(registry, inter.scope))
    )
    return Primary(
        daily_nav=daily,
        daily_returns=primary.daily_returns(daily),
        nav_per_period=primary.monthly_nav(inter.monthly_pl),
        characteristics=characteristics,
        managers=reg.fund_managers(characteristics),
        instrument_prices=holdings.instrument_prices(instruments, settings.max_period),
        instrument_rating=holdings.instrument_rating(instruments),
    )


def evidence_per_fund(
    returns: DataFrame,
    positions: DataFrame,
    characteristics: DataFrame,
    managers: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per active fund with all features and all evidence for the guardrails.

    Returns and holdings are each read in one pass.
    """
    known = guardrails.manager_sizes(characteristics, managers)
    return features.merge_features(
        characteristics,
        features.return_evidence(
            returns, settings.max_period, settings.max_ref_date, settings
        ),
        features.liquidity(characteristics),
        features.portfolio_features(positions, settings.max_period, settings.credit_rating),
        features.fund_age(characteristics, settings.fund_age_cap_years, settings.as_of),
        known,
    )


def rank_funds(evidence: DataFrame, characteristics: DataFrame, settings: Settings) -> Ranking:
    """Scores, guardrail marks and rankings from the evidence, which must be stored."""
    scored = materialize(
        scoring.profile_scores(normalize.scoring_input(evidence, settings), settings)
    )
    mark = guardrails.guardrail_mark(evidence, settings.guardrails)
    wanted = scoring.eligible(scored, mark, characteristics, settings)
    return Ranking(
        scores=scoring.rank_profiles(scored),
        guardrail_mark=mark,
        shortlist=scoring.shortlist(wanted, settings.n_top_funds_output),
        complete_ranking=scoring.complete_ranking(wanted),
    )


def run(raw: Raw, settings: Settings) -> Ranking:
    """From raw tables to rankings."""
    settings = with_reference_dates(raw, settings)
    inter = intermediate(raw, settings)
    prim = primary_tables(inter, raw.registry, settings)
    evidence = materialize(
        evidence_per_fund(
            prim.daily_returns, inter.holdings, prim.characteristics, prim.managers, settings
        )
    )
    return rank_funds(evidence, prim.characteristics, settings)


def check_inputs(raw: Raw, keep: quality.Keep | None = None) -> list[quality.Validation]:
    """The configured checks of input tables, per file where files are known.

    With ``keep``, what is at fault is stored at once (see ``quality.run_checks``).
    """
    incoming = {"monthly_nav": files.unify_names(raw.monthly_nav), "blc_5": raw.family("blc_5")}
    results = []
    for name, table in incoming.items():
        by = "file_name" if "file_name" in table.columns else None
        results += quality.run_checks(table, name, INPUT_CHECKS[name], by, keep)
    return results


def check_tables(raw: Raw, inter: Intermediate, prim: Primary) -> list[quality.Validation]:
    """The configured checks of input and output tables, input ones per file."""
    results = check_inputs(raw)
    made = {**_tables(inter), **_tables(prim)}
    for name, checks in OUTPUT_CHECKS.items():
        results += quality.run_checks(made[name], name, checks)
    return results


def write_results(ranking: Ranking, root: str) -> None:
    """Rankings as delimited reports, scores and marks as Parquet."""
    sinks.write_table(ranking.scores, f"{root}/scores_per_profile")
    sinks.write_table(ranking.guardrail_mark, f"{root}/guardrail_mark")
    sinks.write_report(ranking.shortlist, f"{root}/shortlist")
    sinks.write_report(ranking.complete_ranking, f"{root}/complete_ranking")


Stage = TypeVar("Stage", Intermediate, Primary)


def _tables(stage: Stage) -> dict[str, DataFrame]:
    """Tables of a stage by the names that the configured checks use."""
    named = {f.name: getattr(stage, f.name) for f in fields(stage)}
    return {"funds_in_scope" if name == "scope" else name: table for name, table in named.items()}


def store(stage: Stage, root: str) -> Stage:
    """Write every table of a stage below ``root``; the same stage, read back from there."""
    return store_checked(stage, root)[0]


def store_checked(
    stage: Stage, root: str, keep: quality.Keep | None = None
) -> tuple[Stage, list[quality.Validation]]:
    """As ``store``, with the configured checks of its tables.

    What rows decide one by one is counted while they are written. With ``keep``, what is at
    fault is stored at once (see ``quality.run_checks``).
    """
    stored, results = {}, []
    for field, (name, table) in zip(fields(stage), _tables(stage).items()):
        watched = quality.Watched(table, name, OUTPUT_CHECKS.get(name, {}))
        stored[field.name] = sinks.write_table(watched.table, f"{root}/{field.name}")
        results += watched.results(stored[field.name], keep)
    return type(stage)(**stored), results


def load(kind: type[Stage], spark: SparkSession, root: str) -> Stage:
    """A stage as ``store`` has written it, to start the next one from."""
    return kind(**{f.name: sinks.read_table(spark, f"{root}/{f.name}") for f in fields(kind)})


def run_and_store(
    raw: Raw, settings: Settings, root: str, lines: Mapping[str, DataFrame] | None = None
) -> Ranking:
    """A whole run that keeps the tables of each stage, the rankings and all reports.

    Below ``root``: ``intermediate``, ``primary``, ``evidence``, ``ranking``, and in
    ``reports`` the results of all configured checks (``quality``), everything at fault
    (``quality_affected``) and, where text ``lines`` are given by dataset, what the quote
    repair does to them (``repair``, ``repair_affected``). Each stage starts from the stored
    tables of the one before. Monthly values and the registry, which several steps and checks
    read, are stored first, and every check groups its table once.
    """
    settings = with_reference_dates(raw, settings)
    raw = replace(raw, monthly_nav=materialize(raw.monthly_nav), registry=materialize(raw.registry))
    inter, found = store_checked(intermediate(raw, settings), f"{root}/intermediate", materialize)
    prim, more = store_checked(
        primary_tables(inter, raw.registry, settings), f"{root}/primary", materialize
    )
    evidence = sinks.write_table(
        evidence_per_fund(
            prim.daily_returns, inter.holdings, prim.characteristics, prim.managers, settings
        ),
        f"{root}/evidence",
    )
    ranking = rank_funds(evidence, prim.characteristics, settings)
    write_results(ranking, f"{root}/ranking")
    results = [*check_inputs(raw, materialize), *found, *more]
    reports = f"{root}/reports"
    sinks.write_table(quality.validation_report(results, include_passed=True), f"{reports}/quality")
    sinks.write_table(quality.affected_report(results), f"{reports}/quality_affected")
    if lines:
        found = [repair.raw_validation(table, name, include_passed=True) for name, table in lines.items()]
        for name in ("report", "affected"):
            together = reduce(DataFrame.unionByName, [getattr(f, name) for f in found])
            sinks.write_table(together, f"{reports}/repair" + "_affected" * (name == "affected"))
    return ranking
