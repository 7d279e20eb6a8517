"""The registered queries as plain SQL over the same tables, for comparison.

``CTES`` holds the shared steps in order; ``with_steps`` puts those a query names,
directly or through another step, in front of it.
"""

from __future__ import annotations

import re

from fundsift.config import (
    DEFAULT_GUARDRAILS,
    DEFAULT_PROFILES,
    FEATURE_WEIGHTS,
    GUARDRAIL_NAMES,
    CreditRating,
    Settings,
)
from fundsift.operators.normalize import SCORES
from fundsift.plans.bindings import AS_OF

SETTINGS = Settings()
_SCALE = CreditRating()


def num(value: float) -> str:
    """A number as a double literal."""
    return f"CAST({value!r} AS DOUBLE)"


def r6(expr: str, places: int = 6) -> str:
    """Rounded, and never a negative zero."""
    return f"round({expr}, {places}) + CAST(0 AS DOUBLE)"


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def formatted(expr: str) -> str:
    padded = f"lpad(CAST({expr} AS VARCHAR), 14, '0')"
    pattern = r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$"
    return f"regexp_replace({padded}, '{pattern}', '\\1.\\2.\\3/\\4-\\5')"


def yyyymm(expr: str) -> str:
    return f"CAST(year({expr}) * 100 + month({expr}) AS INTEGER)"


def finite(expr: str) -> str:
    return f"({expr} IS NOT NULL AND isfinite({expr}))"


def clip(expr: str, low: str, high: str) -> str:
    return f"CASE WHEN {expr} IS NOT NULL THEN least(greatest({expr}, {low}), {high}) END"


CTES: dict[str, str] = {}

CTES["ref"] = f"""
SELECT max_ref_date, {yyyymm('prev')} AS latest_period, last_day(prev) AS period_end
FROM (SELECT CAST(max(l_shipdate) AS DATE) AS max_ref_date,
             CAST(date_trunc('month', max(l_shipdate)) - INTERVAL 1 DAY AS DATE) AS prev
      FROM lineitem)"""

CTES["quotas"] = """
SELECT l_suppkey AS cnpj, CAST(l_shipdate AS DATE) AS dt,
       CASE WHEN l_orderkey % 23 = 0 OR (l_suppkey % 9 = 4 AND l_orderkey % 40 <> 1) THEN NULL
            WHEN l_orderkey % 29 = 0 THEN 0e0
            WHEN l_orderkey % 31 = 0 THEN -l_extendedprice
            ELSE 100 + l_extendedprice / 10000 END AS quota, l_extendedprice AS nav,
       CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS subclass
FROM lineitem"""

CTES["usable"] = "SELECT * FROM quotas WHERE quota > 0"

CTES["primary_class"] = """
SELECT cnpj, subclass FROM quotas WHERE subclass IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cnpj
    ORDER BY dt DESC, nav DESC NULLS FIRST, quota DESC, subclass) = 1"""

CTES["classed"] = "SELECT quotas.* FROM quotas JOIN primary_class USING (cnpj, subclass)"

CTES["unclassed"] = """
SELECT * FROM quotas WHERE subclass IS NULL
QUALIFY row_number() OVER (PARTITION BY cnpj, dt ORDER BY nav DESC NULLS FIRST, quota DESC) = 1"""

CTES["usable_class"] = """
SELECT cnpj, subclass FROM usable WHERE subclass IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cnpj
    ORDER BY dt DESC, nav DESC NULLS FIRST, quota DESC, subclass) = 1"""

CTES["daily_nav"] = f"""
SELECT cnpj, dt AS date, {yyyymm('dt')} AS period, quota AS quota_value
FROM (SELECT usable.* FROM usable JOIN usable_class USING (cnpj, subclass)
      UNION ALL SELECT * FROM usable WHERE subclass IS NULL)
QUALIFY row_number() OVER (PARTITION BY cnpj, dt
    ORDER BY subclass IS NOT NULL DESC, nav DESC, quota DESC) = 1"""

CTES["returns"] = """
SELECT cnpj, date, period, quota_value, previous AS quota_value_previous,
       (quota_value - previous) / previous AS daily_return, date_rank
FROM (SELECT *, lag(quota_value) OVER (PARTITION BY cnpj ORDER BY date) AS previous,
             CAST(row_number() OVER (PARTITION BY cnpj ORDER BY date DESC) AS INTEGER) AS date_rank
      FROM daily_nav)
WHERE previous IS NOT NULL AND previous <> 0"""

CTES["recent"] = """
SELECT cnpj, date, daily_return,
       row_number() OVER (PARTITION BY cnpj ORDER BY date DESC) AS recency
FROM returns, ref WHERE date <= period_end"""


def _within(n: int, what: str) -> str:
    return f"CASE WHEN recency <= {n} THEN {what} END"


LONG, SHORT = SETTINGS.trading_days_12m, SETTINGS.trading_days_3m
_EXCESS = f"daily_return - {num(SETTINGS.risk_free_rate_daily)}"
CTES["vol"] = f"""
SELECT cnpj, sqrt({LONG}) * stddev_samp(daily_return) AS volatility,
       sqrt({LONG}) * stddev_samp({_within(LONG, 'daily_return')}) AS volatility_12m,
       sqrt({LONG}) * stddev_samp({_within(SHORT, 'daily_return')}) AS volatility_3m,
       {LONG} * avg({_within(LONG, _EXCESS)}) AS excess_12m,
       {LONG} * avg({_within(SHORT, _EXCESS)}) AS excess_3m,
       count({_within(LONG, '1')}) AS n_12m, count({_within(SHORT, '1')}) AS n_3m
FROM recent GROUP BY cnpj"""


def _sharpe(window: str) -> str:
    ratio = f"excess_{window} / volatility_{window}"
    usable = f"volatility_{window} > {num(SETTINGS.epsilon_volatility)}"
    return (
        f"CASE WHEN {usable} THEN least(greatest({ratio}, {num(-SETTINGS.sharpe_cap)}), "
        f"{num(SETTINGS.sharpe_cap)}) END"
    )


CTES["sharpe"] = f"""
SELECT cnpj, {_sharpe('12m')} AS sharpe_12m, {_sharpe('3m')} AS sharpe_3m,
       n_12m / {num(LONG)} AS pct_cov_12m, n_3m / {num(SHORT)} AS pct_cov_3m
FROM vol"""

CTES["suppliers"] = """
SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

CTES["monthly_nav_raw"] = f"""
SELECT CASE r_name WHEN 'ASIA' THEN 'FACFIF' WHEN 'EUROPE' THEN 'FI' ELSE 'CLASSES - FIF' END
           AS fund_type,
       {formatted('l_suppkey')} AS raw_id, l_suppkey AS cnpj, s_name, dt,
       CASE WHEN s_acctbal <= 0 THEN -total ELSE total END AS nav
FROM (SELECT l_suppkey, last_day(l_shipdate) AS dt, round(sum(l_extendedprice), 2) AS total
      FROM lineitem GROUP BY ALL) JOIN suppliers ON l_suppkey = s_suppkey"""

CTES["monthly_prices"] = f"""
SELECT cnpj, period, round(price + added, 2) AS price
FROM (SELECT l_suppkey AS cnpj, {yyyymm('l_shipdate')} AS period,
             round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL)
JOIN (VALUES (0e0), (1000e0)) v(added) ON added = 0 OR (cnpj % 11 = 0 AND cnpj % 7 <> 0)"""

CTES["registry"] = """
SELECT s_suppkey AS cnpj,
       CASE WHEN r_name = 'MIDDLE EAST' THEN 'Multimercados' ELSE 'Renda Fixa' END
           AS anbima_category_main,
       r_name AS anbima_category_level_1, n_name AS anbima_category_level_2,
       CASE WHEN s_acctbal > 6000 THEN 'Duração Alta - Crédito Livre'
            WHEN s_acctbal > 3000 THEN 'Duração Média (Soberano)'
            WHEN s_acctbal > 0 THEN 'Simples' END AS anbima_category_level_3,
       CASE WHEN s_acctbal > 5000 THEN 'Profissional' ELSE 'Qualificado' END
           AS target_investor_type,
       CASE r_name WHEN 'AFRICA' THEN 'Renda Fixa Simples' WHEN 'EUROPE'
            THEN 'Renda Fixa Indexados' ELSE r_name END AS fund_subtype,
       CASE WHEN s_acctbal > 9500 THEN 'Restrito' WHEN r_name = 'EUROPE'
            THEN 'Não há Restrição' ELSE 'Não Há Restrição' END AS accessability,
       CASE WHEN s_acctbal <= 9000 THEN n_name END AS fund_manager,
       s_name || ' ' || l_returnflag AS commercial_name,
       CASE WHEN s_acctbal <= 8500 THEN CAST(s_nationkey AS DOUBLE) END AS redemption_days,
       CASE WHEN s_acctbal > 0 THEN 'Ativo' ELSE 'Inativo' END AS status,
       strftime(first_seen, '%Y-%m-%d') AS inception_date
FROM (SELECT l_suppkey, l_returnflag, min(l_shipdate) AS first_seen FROM lineitem GROUP BY ALL)
JOIN suppliers ON l_suppkey = s_suppkey"""

CTES["all_funds"] = "SELECT s_suppkey AS cnpj FROM supplier"

_NEGATIVE = "dt = period_end AND nav <= 0"
_TYPES = f"fund_type IN ({text_list(SETTINGS.fund_types)})"
CTES["nav_kept"] = f"""
SELECT * FROM monthly_nav_raw
WHERE {_TYPES} AND raw_id NOT IN (SELECT raw_id FROM monthly_nav_raw, ref
                                  WHERE {_NEGATIVE} AND {_TYPES})"""

CTES["registry_kept"] = f"""
SELECT * FROM registry WHERE anbima_category_main IN ({text_list(SETTINGS.registry_categories)})
AND accessability IN ({text_list(SETTINGS.accessability)})"""

CTES["funds_in_scope"] = """
SELECT DISTINCT cnpj FROM nav_kept WHERE cnpj IN (SELECT cnpj FROM registry_kept)"""

# The funds of the later steps: all, unless a query says otherwise.
CTES["chosen"] = "SELECT cnpj FROM all_funds"

CTES["characteristics"] = """
SELECT * EXCLUDE (status, redemption_days),
       CAST(status = 'Ativo' AS TINYINT) AS is_active,
       coalesce(redemption_days, 90.0) AS redemption_days
FROM chosen LEFT JOIN (
    SELECT * FROM registry
    QUALIFY row_number() OVER (PARTITION BY cnpj
        ORDER BY inception_date NULLS FIRST, commercial_name) = 1) USING (cnpj)"""

CTES["managers"] = """
SELECT fund_manager, count(DISTINCT cnpj) AS num_funds,
       min(CAST(inception_date AS DATE)) AS earliest_inception,
       max(CAST(inception_date AS DATE)) AS latest_inception
FROM characteristics WHERE is_active = 1 AND fund_manager IS NOT NULL GROUP BY fund_manager"""

_RATINGS = "[" + text_list(_SCALE.order) + "]"
_BRAND_NO = "CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER)"
CTES["positions"] = f"""
SELECT l_suppkey AS cnpj, 'blc_' || l_linenumber AS blc_type, {yyyymm('l_shipdate')} AS period,
       p_type AS asset_type,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS value,
       l_quantity AS quantity,
       CASE WHEN l_linenumber = 5 THEN {formatted('l_partkey')} END AS issuer,
       CASE WHEN l_linenumber = 5 THEN p_brand END AS agency,
       CASE WHEN l_linenumber = 5 THEN coalesce({_RATINGS}[{_BRAND_NO}], 'F') END AS rating
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR l_orderkey % 13 = 0
WHERE l_suppkey IN (SELECT cnpj FROM chosen)"""

CTES["active"] = "SELECT positions.* FROM positions, ref WHERE period = latest_period"

CTES["concentration"] = """
SELECT cnpj, sum(value * value) / (sum(abs(value)) * sum(abs(value))) AS concentration_hhi,
       count(*) AS concentration_num_holdings
FROM active GROUP BY cnpj"""

CTES["diversification"] = """
SELECT cnpj, sum(gross * gross) / (sum(gross) * sum(gross)) AS asset_diversification_hhi,
       max(gross) / sum(gross) AS top_category_pct
FROM (SELECT cnpj, asset_type, sum(abs(value)) AS gross FROM active GROUP BY ALL)
GROUP BY cnpj"""

CTES["scale"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', {num(_SCALE.score_of(i))}, {int(name in _SCALE.investment_grade)})"
    for i, name in enumerate(_SCALE.order)
) + ") AS s(rating, rating_score, good)"

CTES["credit"] = f"""
SELECT *, avg_rating_score * {num(_SCALE.weight_avg_rating_score)}
        + pct_investment_grade * {num(_SCALE.weight_investment_grade)} AS credit_quality_score
FROM (SELECT cnpj, 1.0e0 AS pct_rated, avg(rating_score) AS avg_rating_score,
             sum(good) / count(*) AS pct_investment_grade
      FROM active JOIN scale USING (rating) GROUP BY cnpj)"""

_DAYS = f"date_diff('day', CAST(inception_date AS DATE), DATE '{AS_OF}')"
_CAP = num(SETTINGS.fund_age_cap_years)
CTES["age"] = f"""
SELECT cnpj, inception_date, CAST({_DAYS} AS INTEGER) AS fund_age_days,
       {_DAYS} / 365e0 AS fund_age_years,
       {clip(f'{_DAYS} / 365e0 / {_CAP}', '0e0', '1e0')} AS fund_age_score
FROM characteristics"""

CTES["span"] = """
SELECT min(redemption_days) AS lo, max(redemption_days) AS hi
FROM characteristics WHERE is_active = 1"""

CTES["liquidity"] = """
SELECT cnpj, redemption_days, is_active,
       CASE WHEN is_active = 1 THEN
           CASE WHEN hi > lo THEN 1e0 - (redemption_days - lo) / (hi - lo) ELSE 1e0 END
       ELSE 0e0 END AS liquidity_score
FROM characteristics, span"""

CTES["last_seen"] = """
SELECT cnpj, bool_or(date = max_ref_date) AS has_latest_data,
       max(abs(daily_return)) AS max_abs_return
FROM returns, ref GROUP BY cnpj"""

CTES["features"] = """
SELECT c.cnpj, c.is_active, v.volatility, v.volatility_12m, v.volatility_3m,
       sharpe_12m, sharpe_3m, pct_cov_12m, pct_cov_3m, l.redemption_days, l.liquidity_score,
       concentration_hhi, concentration_num_holdings, asset_diversification_hhi,
       top_category_pct, pct_rated, avg_rating_score, pct_investment_grade,
       credit_quality_score, c.inception_date, fund_age_days, fund_age_years, fund_age_score,
       c.fund_manager, num_funds, has_latest_data, max_abs_return
FROM characteristics c LEFT JOIN vol v USING (cnpj) LEFT JOIN sharpe USING (cnpj)
LEFT JOIN liquidity l USING (cnpj) LEFT JOIN concentration USING (cnpj)
LEFT JOIN diversification USING (cnpj) LEFT JOIN credit USING (cnpj)
LEFT JOIN age USING (cnpj) LEFT JOIN managers USING (fund_manager)
LEFT JOIN last_seen USING (cnpj)
WHERE c.is_active = 1"""

CTES["prepared"] = """
SELECT cnpj, ln(volatility + 1) AS volatility_transformed,
       coalesce(sharpe_12m, sharpe_3m) AS sharpe_selected, liquidity_score, concentration_hhi,
       asset_diversification_hhi, fund_age_score, credit_quality_score
FROM features"""

_SOURCES = [source for source, _ in SCORES.values()]


def _rank_of(share: float) -> str:
    return f"floor((n - 1) * {num(share)} + 0.5e0) + 1"


_LOW, _HIGH = SETTINGS.normalization_lower_percentile, SETTINGS.normalization_upper_percentile
CTES["bounds"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature,
       max(CASE WHEN i = {_rank_of(_LOW)} THEN v END) AS lo,
       max(CASE WHEN i = {_rank_of(_HIGH)} THEN v END) AS hi, max(n) AS n
FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS i, count(*) OVER () AS n
      FROM prepared WHERE {c} IS NOT NULL)"""
    for c in _SOURCES
)


def _bound(feature: str, end: str) -> str:
    return f"(SELECT {end} FROM bounds WHERE feature = '{feature}')"


def scaled(feature: str) -> str:
    low, high = _bound(feature, "lo"), _bound(feature, "hi")
    return f"({clip(feature, low, high)} - {low}) / nullif({high} - {low}, 0)"


def _score(name: str) -> str:
    feature, less_is_better = SCORES[name]
    expr = scaled(feature)
    if name == "sharpe_score":
        low, high = _bound(feature, "lo"), _bound(feature, "hi")
        expr = (
            f"CASE WHEN {low} = {high} THEN CASE WHEN {feature} IS NOT NULL THEN 1e0 END "
            f"ELSE {expr} END"
        )
    return f"1e0 - {expr}" if less_is_better else expr


CTES["scoring_input"] = (
    "SELECT cnpj, " + ", ".join(f"{_score(n)} AS {n}" for n in SCORES) + " FROM prepared"
)

CTES["profiles"] = (
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{p.name}', " + ", ".join(num(getattr(p, w)) for w in FEATURE_WEIGHTS.values()) + ")"
        for p in DEFAULT_PROFILES
    )
    + ") AS p(investor_profile, "
    + ", ".join(f"w_{w}" for w in FEATURE_WEIGHTS.values())
    + ")"
)

AVAILABLE = {f: f"CAST({finite(f)} AS INTEGER)" for f in FEATURE_WEIGHTS}
CTES["weighted"] = f"""
SELECT *, ({' + '.join(AVAILABLE.values())}) / {num(len(FEATURE_WEIGHTS))} * 100
           AS pct_features_considered,
       {' + '.join(f'w_{w} * {AVAILABLE[f]}' for f, w in FEATURE_WEIGHTS.items())} AS weight
FROM scoring_input, profiles"""

_PARTS = " + ".join(
    f"CASE WHEN {finite(f)} THEN w_{w} / nullif(weight, 0) * {f} ELSE 0e0 END"
    for f, w in FEATURE_WEIGHTS.items()
)
_G = SETTINGS.gamma_coverage_penalty
CTES["scores"] = f"""
SELECT cnpj, investor_profile, pct_features_considered, score_raw,
       score_raw * ({num(_G)} + {num(1 - _G)} * (pct_features_considered / 100)) AS score
FROM (SELECT *, {_PARTS} AS score_raw FROM weighted)"""

_RULES = DEFAULT_GUARDRAILS
GUARDRAIL_SQL = {
    "min_offer_per_issuer": "fund_manager IS NULL OR num_funds IS NULL OR num_funds < 5",
    "min_sharpe_12m": "sharpe_12m IS NULL OR sharpe_12m < 0e0",
    "min_sharpe_3m": "sharpe_3m IS NULL OR sharpe_3m < 0e0",
    "no_funds_wo_manager": "fund_manager IS NULL",
    "include_only_active_funds": "NOT coalesce(has_latest_data, false)",
    "no_extreme_returns": "coalesce(max_abs_return > 0.1e0, false)",
    "min_cov_sharpe_12m": "pct_cov_12m IS NULL OR pct_cov_12m < 0.8e0",
    "min_cov_sharpe_3m": "pct_cov_3m IS NULL OR pct_cov_3m < 0.8e0",
}
_ACTIVE_RULES = {n: f"({GUARDRAIL_SQL[n]})" for n in GUARDRAIL_NAMES if _RULES[n].active}
CTES["marks"] = f"""
SELECT cnpj, NOT ({' OR '.join(_ACTIVE_RULES.values())}) AS pass_guardrail,
       nullif(concat_ws(',', {', '.join(f"CASE WHEN {c} THEN '{n}' END"
                                        for n, c in _ACTIVE_RULES.items())}), '')
           AS failed_guardrails
FROM features"""


def _allow_lists() -> str:
    rules = []
    for p in DEFAULT_PROFILES:
        if p.target_investor_profile:
            rules.append(
                f"(investor_profile <> '{p.name}' OR target_investor_type IN "
                f"({text_list(p.target_investor_profile)}))"
            )
        if p.allowed_fund_subtypes:
            rules.append(
                f"(investor_profile <> '{p.name}' OR fund_subtype IN "
                f"({text_list(p.allowed_fund_subtypes)}))"
            )
    return " AND ".join(rules)


ALLOW_LISTS = _allow_lists()
CTES["eligible"] = f"""
SELECT s.cnpj, investor_profile, score, commercial_name,
       row_number() OVER (PARTITION BY investor_profile ORDER BY score DESC, s.cnpj) AS rank_no
FROM scores s JOIN marks m ON s.cnpj = m.cnpj AND pass_guardrail
LEFT JOIN characteristics c ON s.cnpj = c.cnpj
WHERE score IS NOT NULL AND {ALLOW_LISTS}"""

CTES["lines"] = """
SELECT CAST(doc_id AS VARCHAR) AS file, i AS line_no, all_lines[i] AS line
FROM (SELECT doc_id, all_lines, unnest(range(1, len(all_lines) + 1)) AS i
      FROM (SELECT doc_id, string_split(replace(replace(replace(
                text, ',', ';'), 'k', '"'), 'x', '""'), chr(10)) AS all_lines
            FROM documents))"""


def _n_quotes(field: str) -> str:
    return f"(length(replace({field}, '\"\"', '')) - length(replace(replace({field}, '\"\"', ''), '\"', '')))"


ODD = f"{_n_quotes('f')} % 2 = 1"
EVEN = f"({_n_quotes('f')} > 0 AND {_n_quotes('f')} % 2 = 0)"


def has_field(line: str, condition: str) -> str:
    return f"len(list_filter(string_split({line}, ';'), lambda f: {condition})) > 0"


def rewrite(line: str, condition: str, pattern: str, to: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({line}, ';'), lambda f: CASE WHEN {condition} "
        f"THEN regexp_replace(f, '{pattern}', '{to}', 'g') ELSE f END), ';')"
    )


def fixed_odd(line: str) -> str:
    return rewrite(line, ODD, '("")|"', "\\1")


def fixed_even(line: str) -> str:
    return rewrite(line, EVEN, '""?', '""')


CHECKED = "line_no > 1 AND regexp_matches(line, '\\S')"
CTES["line_state"] = f"""
SELECT *, checked AND {has_field('once', EVEN)} AS hit_even,
       CASE WHEN checked THEN {fixed_even('once')} ELSE once END AS twice
FROM (SELECT *, checked AND {has_field('line', ODD)} AS hit_odd,
             CASE WHEN checked THEN {fixed_odd('line')} ELSE line END AS once
      FROM (SELECT *, {CHECKED} AS checked FROM lines))"""

CTES["loss"] = """
SELECT file, count(*) AS lines_before, CAST(count_if(hit_odd) AS BIGINT) AS lines_hit,
       CASE WHEN count_if(hit_odd) > 0
            THEN CAST(count_if(line_no = 1 OR (checked AND NOT hit_odd)) AS BIGINT)
            ELSE count(*) END
           AS lines_after
FROM line_state GROUP BY file"""


def with_steps(query: str, **replaced: str) -> str:
    """``query`` after the steps it needs; ``replaced`` steps take the given SQL."""
    steps = {**CTES, **replaced}
    needed: set[str] = set()
    todo = [query]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & steps.keys() - needed:
            needed.add(name)
            todo.append(steps[name])
    order = [n for n in _ordered(steps) if n in needed]
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({steps[n]})" for n in order) + "\n" + query


def _ordered(steps: dict[str, str]) -> list[str]:
    """Steps with every step after those it names."""
    done: list[str] = []

    def visit(name: str, path: tuple[str, ...] = ()):
        if name in done or name in path:
            return
        words = set(re.findall(r"[a-z_0-9]+", steps[name]))
        for other in steps:
            if other in words and other != name:
                visit(other, (*path, name))
        done.append(name)

    for name in steps:
        visit(name)
    return done
