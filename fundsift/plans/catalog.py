"""One registered query per operator, over the star schema, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundsift.config import (
    DEFAULT_GUARDRAILS,
    FEATURE_WEIGHTS,
    GUARDRAIL_NAMES,
    RATING_ORDER,
    Guardrail,
)
from fundsift.functions import columns as fc
from fundsift.functions import quantile
from fundsift.operators import (
    features,
    guardrails,
    holdings,
    keys,
    normalize,
    primary,
    quality,
    registry,
    repair,
    scope,
    scoring,
)
from fundsift.plans import oracle as o
from fundsift.plans import pipeline
from fundsift.plans.bindings import AS_OF, Tables
from fundsift.plans.oracle import r6
from fundsift.session import scratch_path
from fundsift.sources import files, schemas, sinks


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, without negative zeros, as both sides compare them."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in doubles}) if doubles else df


def query(name: str, sql: str | None, **replaced: str):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _rounded(build(Tables(spark, folder)))

        QUERIES[name] = Query(run, o.with_steps(sql, **replaced) if sql else None)
        return build

    return register


def _one_row(t: Tables, **values) -> DataFrame:
    return t.spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


# -- sources and sinks --------------------------------------------------------


def _order_files(t: Tables) -> str:
    """Orders as a folder of monthly ``;`` files in Latin-1, newer years with new names."""
    path = scratch_path(t.spark, "orders")
    base = t.read("orders").select(
        F.concat(F.lit("Ação "), "o_orderstatus").alias("TP_FUNDO"),
        fc.cnpj_to_formatted("o_custkey").alias("CNPJ_FUNDO"),
        F.col("o_orderpriority").alias("DENOM_SOCIAL"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DT_COMPTC"),
        F.col("o_totalprice").alias("VL_PATRIM_LIQ"),
        fc.period_of("o_orderdate").alias("period"),
    )
    new_names = base.filter("period >= 199900").withColumnsRenamed(schemas.OLD_NAMES)
    old_names = base.filter("period < 199900").drop("DENOM_SOCIAL")
    for part in (old_names, new_names):
        part.write.mode("append").partitionBy("period").option("header", "true").option(
            "sep", files.SEPARATOR
        ).option("encoding", files.ENCODING).option("escape", '"').csv(path)
    return path


_ORDER_PERIOD = o.yyyymm("o_orderdate")


@query(
    "scan_partitioned_csv",
    f"""SELECT {_ORDER_PERIOD} AS period, 'Ação ' || o_orderstatus AS fund_type,
        {o.formatted('o_custkey')} AS raw_id,
        CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS name,
        strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, {r6('o_totalprice')} AS nav FROM orders""",
)
def _(t):
    table = files.scan_partitioned_csv(t.spark, _order_files(t), schemas.MONTHLY_NAV)
    return table.select(
        "period",
        F.col("TP_FUNDO_CLASSE").alias("fund_type"),
        F.col("CNPJ_FUNDO_CLASSE").alias("raw_id"),
        F.col("DENOM_SOCIAL").alias("name"),
        F.col("DT_COMPTC").alias("day"),
        F.col("VL_PATRIM_LIQ").alias("nav"),
    )


def _family_files(t: Tables, family: str) -> str:
    path = scratch_path(t.spark, family)
    wanted = schemas.HOLDINGS[family]
    rows = files.unify_names(t.raw_families()[family])
    full = files.add_missing(rows, wanted)
    full.select("period", *wanted.fieldNames()).write.partitionBy("period").option(
        "header", "true"
    ).option("sep", files.SEPARATOR).option("encoding", files.ENCODING).csv(path)
    return path


_HOLDING_COLUMNS = {
    "asset_type": "TP_ATIVO",
    "value": "VL_MERC_POS_FINAL",
    "quantity": "QT_POS_FINAL",
    "issuer": "CNPJ_EMISSOR",
    "agency": "AG_RISCO",
    "rating": "GRAU_RISCO",
}
_HOLDING_SQL = f"period, asset_type, {r6('value')} AS value, {r6('quantity')} AS quantity, issuer, agency, rating"


def _holding_columns() -> list[Column]:
    return [F.col(old).alias(new) for new, old in _HOLDING_COLUMNS.items()]


@query(
    "declared_schema",
    f"""SELECT {o.formatted('cnpj')} AS raw_id, {_HOLDING_SQL} FROM positions WHERE blc_type = 'blc_5'""",
)
def _(t):
    table = files.scan_partitioned_csv(
        t.spark, _family_files(t, "blc_5"), schemas.HOLDINGS["blc_5"]
    )
    return table.select(F.col("CNPJ_FUNDO_CLASSE").alias("raw_id"), "period", *_holding_columns())


@query(
    "registry_source",
    """SELECT cnpj, anbima_category_main AS category, anbima_category_level_3 AS level_3,
       fund_manager AS manager, commercial_name, redemption_days, status,
       CAST(inception_date AS VARCHAR) AS inception_date FROM registry""",
)
def _(t):
    path = scratch_path(t.spark, "registry")
    sinks.write_report(t.registry(), path)
    table = files.registry_source(t.spark, path, schemas.REGISTRY)
    return table.select(
        F.col("CNPJ do Fundo").alias("cnpj"),
        F.col("Categoria ANBIMA").alias("category"),
        F.col("nivel_3_subcategoria").alias("level_3"),
        F.col("Gestor Principal").alias("manager"),
        F.col("Nome Comercial").alias("commercial_name"),
        F.col("Prazo Pagamento Resgate em dias").alias("redemption_days"),
        F.col("Status").alias("status"),
        F.col("Data de Início de Atividade").alias("inception_date"),
    )


@query(
    "table_sink",
    f"SELECT o_orderkey, {_ORDER_PERIOD} AS period, {r6('o_totalprice')} AS o_totalprice FROM orders",
)
def _(t):
    orders = t.read("orders").select(
        "o_orderkey", "o_totalprice", fc.period_of("o_orderdate").alias("period")
    )
    return sinks.write_table(orders, scratch_path(t.spark, "table"), "period", rebalance=True)


@query("max_period", f"SELECT max({_ORDER_PERIOD}) AS max_period FROM orders")
def _(t):
    return files.latest_period(t.spark, _order_files(t))


@query(
    "max_ref_date",
    f"""SELECT max(CAST(l_shipdate AS DATE)) AS max_ref_date FROM lineitem, ref
        WHERE {o.yyyymm('l_shipdate')} = latest_period""",
)
def _(t):
    return files.max_ref_date(t.raw_quotas(), t.latest_period)


@query(
    "recent_periods_scan",
    f"""SELECT {o.yyyymm('dt')} AS period, count(*) AS n, {r6('sum(nav)', 2)} AS total
        FROM quotas GROUP BY ALL ORDER BY 1 DESC LIMIT 12""",
)
def _(t):
    recent = files.recent_periods(t.raw_quotas(), 12)
    return recent.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("VL_PATRIM_LIQ"), 2).alias("total")
    )


@query(
    "schema_drift_union",
    f"""SELECT o_orderstatus AS "TP_FUNDO_CLASSE", {o.formatted('o_custkey')} AS "CNPJ_FUNDO_CLASSE",
        CAST(o_orderdate AS DATE) AS "DT_COMPTC",
        CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS "ID_SUBCLASSE",
        {r6('o_totalprice')} AS "VL_QUOTA" FROM orders""",
)
def _(t):
    rows = t.read("orders").select(
        F.col("o_orderstatus").alias("TP_FUNDO"),
        fc.cnpj_to_formatted("o_custkey").alias("CNPJ_FUNDO"),
        F.to_date("o_orderdate").alias("DT_COMPTC"),
        F.col("o_orderpriority").alias("ID_SUBCLASSE"),
        F.col("o_totalprice").alias("VL_QUOTA"),
    )
    old = rows.filter(F.year("DT_COMPTC") < 1999).drop("ID_SUBCLASSE")
    new = rows.filter(F.year("DT_COMPTC") >= 1999).withColumnsRenamed(schemas.OLD_NAMES)
    return files.drift_union([old, new])


# -- quote repair ---------------------------------------------------------------


@query("check_redundant_quotes", "SELECT file, line_no FROM line_state WHERE hit_odd")
def _(t):
    return repair.flagged_line_numbers(t.document_lines(), "check_redundant_quotes")


@query(
    "check_malformed_quotes",
    f"SELECT file, line_no FROM line_state WHERE checked AND {o.has_field('line', o.EVEN)}",
)
def _(t):
    return repair.flagged_line_numbers(t.document_lines(), "check_malformed_quotes")


def _repaired(t: Tables, steps: dict[str, str]) -> DataFrame:
    kept = repair.repair(t.document_lines(), steps)
    return kept.select("file", (F.col("seq") + 1).alias("line_no"), "line")


@query("fix_redundant_quotes", "SELECT file, line_no, once AS line FROM line_state")
def _(t):
    return _repaired(t, {"check_redundant_quotes": repair.FIX})


@query(
    "fix_malformed_quotes",
    f"""SELECT file, line_no, CASE WHEN checked THEN {o.fixed_even('line')} ELSE line END AS line
        FROM line_state""",
)
def _(t):
    return _repaired(t, {"check_malformed_quotes": repair.FIX})


@query(
    "drop_affected_lines",
    """SELECT file, line_no, line FROM line_state JOIN loss USING (file)
       WHERE lines_hit = 0 OR lines_after < lines_before * 0.5e0
       OR line_no = 1 OR (checked AND NOT hit_odd)""",
)
def _(t):
    kept = repair.drop_affected_lines(t.document_lines(), "check_redundant_quotes")
    return kept.select("file", (F.col("seq") + 1).alias("line_no"), "line")


@query(
    "line_loss_gate",
    """SELECT file, lines_before, lines_after, lines_hit,
       lines_after >= lines_before * 0.5e0 AS accepted FROM loss""",
)
def _(t):
    return repair.line_loss(t.document_lines(), "check_redundant_quotes")


@query("repair_by_strategy", "SELECT file, line_no, twice AS line FROM line_state")
def _(t):
    return _repaired(t, repair.DEFAULT_STEPS)


_REPAIR_CHECKS = [
    ("check_redundant_quotes", "hit_odd", "redundant quotes", "removed"),
    ("check_malformed_quotes", "hit_even", "malformed quotes", "doubled"),
]
RAW_REPORT_SQL = " UNION ALL ".join(
    f"""SELECT 'documents/' || file AS dataset_name, '{name}' AS validation_name,
        CASE WHEN count_if({hit}) > 0 THEN 'fixed' ELSE 'passed' END AS status,
        'fix' AS strategy_applied,
        CASE WHEN count_if({hit}) > 0 THEN '{problem} {action} in ' || count_if({hit}) || ' lines'
             ELSE 'no {problem}' END AS details,
        CAST(count_if({hit}) AS BIGINT) AS affected_lines_count,
        CAST(count_if({hit}) AS BIGINT) AS fixes_applied
        FROM line_state GROUP BY file"""
    for name, hit, problem, action in _REPAIR_CHECKS
)


def _raw_report(t: Tables) -> DataFrame:
    result = repair.raw_validation(t.document_lines(), "documents", include_passed=True)
    return result.report.drop("timestamp")


@query("raw_validation_report", RAW_REPORT_SQL)
def _(t):
    return _raw_report(t)


@query(
    "affected_lines",
    " UNION ALL ".join(
        f"SELECT file, '{name}' AS validation_name, line_no FROM line_state WHERE {hit}"
        for name, hit, *_ in _REPAIR_CHECKS
    ),
)
def _(t):
    return repair.raw_validation(t.document_lines(), "documents").affected


@query(
    "raw_validation_summary",
    f"""SELECT 'status' AS kind, status AS name, count(*) AS n FROM ({RAW_REPORT_SQL})
        GROUP BY status UNION ALL
        SELECT 'validation_name', validation_name, count(*) FROM ({RAW_REPORT_SQL})
        GROUP BY validation_name""",
)
def _(t):
    return repair.summary(_raw_report(t))


# -- scope ------------------------------------------------------------------------


@query(
    "cnpj_to_numeric",
    "SELECT DISTINCT raw_id, cnpj FROM monthly_nav_raw",
)
def _(t):
    ids = t.raw_monthly_nav().select(F.col("CNPJ_FUNDO").alias("raw_id")).distinct()
    return ids.withColumn("cnpj", fc.cnpj_to_numeric("raw_id"))


_NAV_SQL = f'raw_id AS "CNPJ_FUNDO_CLASSE", dt AS "DT_COMPTC", {r6("nav", 2)} AS "VL_PATRIM_LIQ"'
_NAV_COLUMNS = ["CNPJ_FUNDO_CLASSE", "DT_COMPTC", "VL_PATRIM_LIQ"]


@query(
    "filter_fund_types",
    f"""SELECT {_NAV_SQL}, fund_type AS "TP_FUNDO_CLASSE" FROM monthly_nav_raw
        WHERE fund_type IN ({o.text_list(o.SETTINGS.fund_types)})""",
)
def _(t):
    nav = scope.filter_fund_types(files.unify_names(t.raw_monthly_nav()), t.settings)
    return nav.select(*_NAV_COLUMNS, "TP_FUNDO_CLASSE")


@query(
    "exclude_nonpositive_nav",
    f"""SELECT {_NAV_SQL} FROM monthly_nav_raw WHERE raw_id NOT IN
        (SELECT raw_id FROM monthly_nav_raw, ref WHERE dt = period_end AND nav <= 0)""",
)
def _(t):
    nav = files.unify_names(t.raw_monthly_nav())
    return scope.exclude_nonpositive_nav(nav, t.latest_period).select(*_NAV_COLUMNS)


def _scope(t: Tables) -> DataFrame:
    return scope.funds_in_scope(
        t.raw_monthly_nav(), t.registry(), t.latest_period, t.settings
    )


@query("funds_in_scope", "SELECT cnpj FROM funds_in_scope")
def _(t):
    return _scope(t)


@query(
    "scope_semijoin",
    f"""SELECT cnpj, count(*) AS n, {r6('sum(nav)', 2)} AS total FROM quotas
        WHERE cnpj IN (SELECT cnpj FROM funds_in_scope) GROUP BY cnpj""",
)
def _(t):
    return (
        keys.keep_keys(t.quotas(), _scope(t))
        .groupBy("cnpj")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("VL_PATRIM_LIQ"), 2).alias("total"))
    )


@query(
    "normalize_monthly_pl",
    f"""SELECT cnpj, {_NAV_SQL}, fund_type AS "TP_FUNDO_CLASSE" FROM monthly_nav_raw
        WHERE cnpj IN (SELECT cnpj FROM funds_in_scope)""",
)
def _(t):
    nav = scope.normalize_monthly_nav(t.raw_monthly_nav(), _scope(t))
    return nav.select("cnpj", *_NAV_COLUMNS, "TP_FUNDO_CLASSE")


@query(
    "normalize_daily_quotas",
    f"""SELECT cnpj, {o.formatted('cnpj')} AS "CNPJ_FUNDO_CLASSE", dt AS "DT_COMPTC",
        {r6('quota')} AS "VL_QUOTA", subclass AS "ID_SUBCLASSE" FROM quotas
        WHERE cnpj IN (SELECT cnpj FROM funds_in_scope)""",
)
def _(t):
    quotas = scope.normalize_daily_quotas(t.raw_quotas(), _scope(t))
    return quotas.select("cnpj", "CNPJ_FUNDO_CLASSE", "DT_COMPTC", "VL_QUOTA", "ID_SUBCLASSE")


@query(
    "normalize_holdings",
    f"""SELECT cnpj, blc_type, {_HOLDING_SQL} FROM positions WHERE cnpj IN (SELECT cnpj FROM funds_in_scope)""",
)
def _(t):
    table = scope.normalize_holdings(t.raw_families(), _scope(t))
    return table.select("cnpj", "blc_type", "period", *_holding_columns())


@query(
    "filter_fixed_income",
    f"""SELECT 'nav' AS kind, cnpj, s_name AS name, fund_type AS type, dt AS day, {r6('nav', 2)} AS nav
        FROM nav_kept WHERE cnpj IN (SELECT cnpj FROM funds_in_scope)
        UNION ALL
        SELECT 'registry', cnpj, commercial_name, anbima_category_main, CAST(inception_date AS DATE), NULL
        FROM registry_kept WHERE cnpj IN (SELECT cnpj FROM funds_in_scope)
        UNION ALL
        SELECT 'scope', cnpj, NULL, NULL, NULL, NULL FROM funds_in_scope""",
)
def _(t):
    kept = scope.filter_fixed_income(
        t.raw_monthly_nav(), t.registry(), t.latest_period, t.settings
    )
    nav = kept.nav.select(
        F.lit("nav").alias("kind"),
        "cnpj",
        F.col("DENOM_SOCIAL").alias("name"),
        F.col("TP_FUNDO_CLASSE").alias("type"),
        F.col("DT_COMPTC").alias("day"),
        F.col("VL_PATRIM_LIQ").alias("nav"),
    )
    listed = kept.registry.select(
        F.lit("registry").alias("kind"),
        "cnpj",
        F.col("Nome Comercial").alias("name"),
        F.col("Categoria ANBIMA").alias("type"),
        F.to_date("Data de Início de Atividade").alias("day"),
    )
    scoped = kept.scope.withColumn("kind", F.lit("scope"))
    both = nav.unionByName(listed, allowMissingColumns=True)
    return both.unionByName(scoped, allowMissingColumns=True)


# -- primary tables ---------------------------------------------------------------


@query(
    "monthly_nav",
    f"SELECT cnpj, period, {r6('price', 2)} AS price FROM monthly_prices",
)
def _(t):
    return primary.monthly_nav(t.monthly_prices())


_QUOTA_SQL = """cnpj, dt AS "DT_COMPTC", round(quota, 6) AS "VL_QUOTA",
    round(nav, 6) AS "VL_PATRIM_LIQ", subclass AS "ID_SUBCLASSE\""""


@query(
    "valid_quota_filter",
    f"SELECT {_QUOTA_SQL} FROM quotas WHERE quota IS NOT NULL AND isfinite(quota) AND quota > 0",
)
def _(t):
    return primary.valid_quotas(t.quotas())


@query("primary_share_class", f"SELECT {_QUOTA_SQL} FROM classed")
def _(t):
    return primary.primary_share_class(t.quotas())


@query("dedup_highest_nav", f"SELECT {_QUOTA_SQL} FROM unclassed")
def _(t):
    return primary.dedup_highest_nav(t.quotas())


@query(
    "daily_nav",
    f"SELECT cnpj, date, period, {r6('quota_value')} AS quota_value FROM daily_nav",
)
def _(t):
    return t.daily_nav()


@query(
    "daily_returns",
    f"""SELECT cnpj, date, period, {r6('quota_value')} AS quota_value,
        {r6('quota_value_previous')} AS quota_value_previous,
        {r6('daily_return')} AS daily_return, date_rank FROM returns""",
)
def _(t):
    return t.returns()


@query(
    "monthly_returns",
    f"""SELECT cnpj, period, {r6('price', 2)} AS price, {r6('previous', 2)} AS price_previous,
        {r6('(price - previous) / previous')} AS monthly_return,
        CAST(period_rank AS INTEGER) AS period_rank
        FROM (SELECT n.*, p.price AS previous, row_number() OVER (PARTITION BY n.cnpj
                  ORDER BY n.period DESC, n.price, p.price NULLS FIRST) AS period_rank
              FROM monthly_prices n LEFT JOIN monthly_prices p ON p.cnpj = n.cnpj AND p.period =
                  CASE WHEN n.period % 100 = 1 THEN n.period - 89 ELSE n.period - 1 END)
        WHERE previous IS NOT NULL""",
)
def _(t):
    return primary.monthly_returns(primary.monthly_nav(t.monthly_prices()))


_CHARACTERISTICS = [
    "cnpj",
    "anbima_category_main",
    "anbima_category_level_1",
    "anbima_category_level_2",
    "anbima_category_level_3",
    "target_investor_type",
    "fund_subtype",
    "accessability",
    "fund_manager",
    "commercial_name",
    "redemption_days",
    "inception_date",
    "is_active",
]


@query("fund_characteristics", f"SELECT {', '.join(_CHARACTERISTICS)} FROM characteristics")
def _(t):
    return t.characteristics().select(*_CHARACTERISTICS)


def _safe_name_sql(label: str) -> str:
    words = f"replace(replace(strip_accents(lower({label})), ' ', '_'), '-', '_')"
    return f"'is_' || regexp_replace({words}, '[^a-z0-9_]', '', 'g')"


@query(
    "one_hot_categories",
    " UNION ALL ".join(
        f"""SELECT cnpj, '{level}' AS level, {level} AS label, {_safe_name_sql(level)} AS flag
        FROM characteristics WHERE {level} IS NOT NULL"""
        for level in registry.LEVELS
    ),
)
def _(t):
    return registry.category_flags(t.characteristics())


@query(
    "safe_column_name",
    f"""SELECT label, {_safe_name_sql('label')} AS safe_name
        FROM (SELECT DISTINCT anbima_category_level_1 AS label FROM registry UNION
              SELECT DISTINCT anbima_category_level_2 FROM registry UNION
              SELECT DISTINCT anbima_category_level_3 FROM registry) WHERE label IS NOT NULL""",
)
def _(t):
    levels = t.registry().select(
        F.explode(
            F.array("nivel_1_categoria", "nivel_2_categoria", "nivel_3_subcategoria")
        ).alias("label")
    )
    return (
        levels.filter(F.col("label").isNotNull())
        .distinct()
        .withColumn("safe_name", fc.safe_label("label"))
    )


@query(
    "unique_key_assert",
    "SELECT count(*) AS n_rows, count(DISTINCT cnpj) AS n_keys FROM characteristics",
)
def _(t):
    return registry.unique_key_report(registry.assert_unique(t.characteristics()))


@query(
    "fund_managers",
    "SELECT fund_manager, num_funds, earliest_inception, latest_inception FROM managers",
)
def _(t):
    return registry.fund_managers(t.characteristics())


@query(
    "instrument_registry",
    f"""SELECT cnpj, blc_type, period, asset_type, {r6('value')} AS value, {r6('quantity')} AS quantity,
        issuer, rating, row_number() OVER (PARTITION BY cnpj, blc_type, period, asset_type, value,
        quantity, issuer, agency, rating) - 1 AS copy_no, true AS is_unique
        FROM positions""",
)
def _(t):
    rows = t.instruments()
    ids = rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(ids, "instrument_id").select(
        "cnpj",
        "blc_type",
        "period",
        F.col("TP_ATIVO").alias("asset_type"),
        F.col("VL_MERC_POS_FINAL").alias("value"),
        F.col("QT_POS_FINAL").alias("quantity"),
        F.col("CNPJ_EMISSOR").alias("issuer"),
        F.col("GRAU_RISCO").alias("rating"),
        F.element_at(F.split("instrument_id", "_"), -1).cast("long").alias("copy_no"),
        (F.col("n") == 1).alias("is_unique"),
    )


@query(
    "instrument_prices",
    f"""SELECT cnpj, period, asset_type, {r6('value')} AS position_value,
        CASE WHEN period = latest_period THEN 1 ELSE 0 END AS is_active FROM positions, ref""",
)
def _(t):
    return t.prices().drop("instrument_id")


@query(
    "instrument_rating",
    r"""SELECT cnpj, period, regexp_replace(issuer, '\D', '', 'g') AS issuer_cnpj,
        rating AS credit_rating, agency AS rating_agency
        FROM positions WHERE blc_type = 'blc_5' AND rating IS NOT NULL""",
)
def _(t):
    return holdings.instrument_rating(t.instruments()).drop("instrument_id")


# -- features ---------------------------------------------------------------------


@query(
    "last_n_days",
    f"""SELECT cnpj, date, {r6('daily_return')} AS daily_return FROM recent
        WHERE recency <= {o.LONG}""",
)
def _(t):
    inside = features.up_to_period(t.returns(), t.latest_period)
    return features.last_n_days(inside, t.settings.trading_days_12m).select(
        "cnpj", "date", "daily_return"
    )


@query(
    "period_end_date",
    f"""SELECT DISTINCT {o.yyyymm('l_shipdate')} AS period, last_day(l_shipdate) AS last_date
        FROM lineitem""",
)
def _(t):
    periods = t.raw_quotas().select("period").distinct()
    return periods.withColumn("last_date", fc.period_end(F.col("period")))


@query(
    "volatility",
    f"""SELECT cnpj, period_end AS ref_date, {r6('volatility')} AS volatility,
        {r6('volatility_12m')} AS volatility_12m, {r6('volatility_3m')} AS volatility_3m
        FROM vol, ref""",
)
def _(t):
    return features.volatility(t.returns(), t.latest_period, t.settings)


_SHARPE_SQL = f"""{r6('sharpe_12m')} AS sharpe_12m, {r6('sharpe_3m')} AS sharpe_3m,
    {r6('pct_cov_12m')} AS pct_cov_12m, {r6('pct_cov_3m')} AS pct_cov_3m"""


@query("sharpe_ratio", f"SELECT cnpj, {_SHARPE_SQL} FROM sharpe")
def _(t):
    return t.sharpe()


_STEADY = "CASE WHEN cnpj % 7 = 3 THEN 0.001e0 * (1 - 2 * (cnpj % 2)) + daily_return / 1e5 ELSE daily_return END"


@query(
    "sharpe_cap",
    f"SELECT cnpj, {_SHARPE_SQL} FROM sharpe",
    returns=f"SELECT * REPLACE ({_STEADY} AS daily_return) FROM ({o.CTES['returns']})",
)
def _(t):
    """Some funds have nearly the same return every day, so that their ratios reach the cap on either side."""
    returns = t.returns().withColumn("daily_return", F.expr(_STEADY))
    return features.sharpe_ratio(returns, t.latest_period, t.settings)


@query(
    "liquidity",
    f"""SELECT cnpj, {r6('redemption_days')} AS redemption_days, is_active,
        {r6('liquidity_score')} AS liquidity_score FROM liquidity""",
)
def _(t):
    return features.liquidity(t.characteristics())


@query(
    "concentration",
    f"""SELECT cnpj, {r6('concentration_hhi')} AS concentration_hhi, concentration_num_holdings
        FROM concentration""",
)
def _(t):
    return features.concentration(t.prices())


@query(
    "asset_diversification",
    f"""SELECT cnpj, {r6('asset_diversification_hhi')} AS asset_diversification_hhi,
        {r6('top_category_pct')} AS top_category_pct FROM diversification""",
)
def _(t):
    return features.asset_diversification(t.prices())


_CREDIT_SQL = f"""{r6('pct_rated')} AS pct_rated, {r6('avg_rating_score')} AS avg_rating_score,
    {r6('pct_investment_grade')} AS pct_investment_grade,
    {r6('credit_quality_score')} AS credit_quality_score"""


@query("credit_quality", f"SELECT cnpj, {_CREDIT_SQL} FROM credit")
def _(t):
    instruments = t.instruments()
    return features.credit_quality(
        holdings.instrument_rating(instruments),
        holdings.instrument_prices(instruments, t.latest_period),
        t.settings.credit_rating,
    )


@query(
    "fund_age",
    f"""SELECT cnpj, inception_date, fund_age_days, {r6('fund_age_years')} AS fund_age_years,
        {r6('fund_age_score')} AS fund_age_score FROM age""",
)
def _(t):
    return features.fund_age(t.characteristics(), t.settings.fund_age_cap_years, AS_OF)


_PORTFOLIO_SQL = f"""{r6('concentration_hhi')} AS concentration_hhi, concentration_num_holdings,
    {r6('asset_diversification_hhi')} AS asset_diversification_hhi,
    {r6('top_category_pct')} AS top_category_pct, {_CREDIT_SQL}"""


@query(
    "portfolio_features",
    f"""SELECT cnpj, {_PORTFOLIO_SQL} FROM concentration
        LEFT JOIN diversification USING (cnpj) LEFT JOIN credit USING (cnpj)""",
)
def _(t):
    return features.portfolio_features(t.positions(), t.latest_period, t.settings.credit_rating)


@query(
    "merge_features",
    f"""SELECT cnpj, is_active, {r6('volatility')} AS volatility,
        {r6('volatility_12m')} AS volatility_12m, {r6('volatility_3m')} AS volatility_3m,
        {r6('sharpe_12m')} AS sharpe_12m, {r6('sharpe_3m')} AS sharpe_3m,
        {r6('redemption_days')} AS redemption_days, {r6('liquidity_score')} AS liquidity_score,
        {_PORTFOLIO_SQL}, inception_date, fund_age_days, {r6('fund_age_years')} AS fund_age_years,
        {r6('fund_age_score')} AS fund_age_score FROM features""",
)
def _(t):
    returns, prices, instruments = t.returns(), t.prices(), t.instruments()
    characteristics = t.characteristics()
    vol = features.volatility(returns, t.latest_period, t.settings)
    return features.merge_features(
        characteristics,
        vol.drop("ref_date"),
        t.sharpe().select("cnpj", "sharpe_12m", "sharpe_3m"),
        features.liquidity(characteristics),
        features.concentration(prices),
        features.asset_diversification(prices),
        features.credit_quality(
            holdings.instrument_rating(instruments), prices, t.settings.credit_rating
        ),
        features.fund_age(characteristics, t.settings.fund_age_cap_years, AS_OF),
    )


# -- normalisation ----------------------------------------------------------------


@query(
    "nearest_quantile",
    f"SELECT feature, n, {r6('lo')} AS lo, {r6('hi')} AS hi FROM bounds",
)
def _(t):
    ready = normalize.prepared(t.evidence, t.settings)
    bounds = normalize.score_bounds(ready, t.settings)
    counts = ready.agg(*[F.count(c).alias(c) for c in bounds])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(c).alias("n"),
                F.lit(low).alias("lo"),
                F.lit(high).alias("hi"),
            )
            for c, (low, high) in bounds.items()
        ]
    )
    return counts.select(F.inline(rows))


def _one_score(t: Tables, source: str) -> tuple[DataFrame, list[float]]:
    ready = normalize.prepared(t.evidence, t.settings)
    shares = [
        t.settings.normalization_lower_percentile,
        t.settings.normalization_upper_percentile,
    ]
    return ready, quantile.nearest_quantiles(ready, [source], shares)[source]


@query(
    "winsorize_minmax",
    f"SELECT cnpj, {r6(o.scaled('fund_age_score'))} AS score FROM prepared",
)
def _(t):
    ready, bounds = _one_score(t, "fund_age_score")
    return ready.select("cnpj", normalize.winsorized(F.col("fund_age_score"), *bounds).alias("score"))


@query(
    "inverted_score",
    f"SELECT cnpj, {r6('1e0 - (' + o.scaled('concentration_hhi') + ')')} AS score FROM prepared",
)
def _(t):
    ready, bounds = _one_score(t, "concentration_hhi")
    score = normalize.winsorized(F.col("concentration_hhi"), *bounds)
    return ready.select("cnpj", normalize.inverted(score).alias("score"))


@query(
    "log_transform",
    f"SELECT cnpj, {r6('ln(volatility + 1)')} AS volatility_transformed FROM vol",
)
def _(t):
    vol = features.volatility(t.returns(), t.latest_period, t.settings)
    return vol.select("cnpj", normalize.log_transform().alias("volatility_transformed"))


@query(
    "sharpe_fallback",
    f"""SELECT cnpj, {r6('CASE WHEN cnpj % 5 = 1 OR sharpe_12m IS NULL THEN sharpe_3m ELSE sharpe_12m END')} AS sharpe_selected
        FROM sharpe""",
)
def _(t):
    """Every fifth fund has no ratio of twelve months."""
    known = F.when(F.col("cnpj") % 5 != 1, F.col("sharpe_12m"))
    sharpe = t.sharpe().withColumn("sharpe_12m", known)
    return sharpe.select("cnpj", normalize.sharpe_fallback().alias("sharpe_selected"))


def _scoring_input(t: Tables) -> DataFrame:
    return normalize.scoring_input(t.evidence, t.settings)


@query(
    "scoring_input",
    "SELECT cnpj, " + ", ".join(f"{r6(f)} AS {f}" for f in FEATURE_WEIGHTS) + " FROM scoring_input",
)
def _(t):
    return _scoring_input(t).select("cnpj", *FEATURE_WEIGHTS)


# -- scoring and ranking ------------------------------------------------------------


@query(
    "profile_cross_join",
    "SELECT cnpj, investor_profile, "
    + ", ".join(f"w_{w}" for w in FEATURE_WEIGHTS.values())
    + " FROM all_funds, profiles",
)
def _(t):
    return scoring.with_profiles(t.funds(), t.settings.profiles)


@query(
    "feature_availability",
    "SELECT cnpj, "
    + ", ".join(f"CAST({o.finite(f)} AS INTEGER) AS {f}_available" for f in FEATURE_WEIGHTS)
    + f", {r6('(' + ' + '.join(o.AVAILABLE.values()) + ') / 7e0 * 100')}"
    " AS pct_features_considered FROM scoring_input",
)
def _(t):
    return _scoring_input(t).select(
        "cnpj",
        *[scoring.available(f).alias(f"{f}_available") for f in FEATURE_WEIGHTS],
        scoring.pct_features_considered().alias("pct_features_considered"),
    )


@query(
    "weighted_score",
    f"SELECT cnpj, investor_profile, {r6('score_raw')} AS score_raw FROM scores",
)
def _(t):
    weighted = scoring.with_profiles(_scoring_input(t), t.settings.profiles)
    return weighted.select(
        "cnpj",
        "investor_profile",
        scoring.weighted_score(scoring.available_weight()).alias("score_raw"),
    )


_SCORE_SQL = f"""cnpj, investor_profile, {r6('score')} AS score,
    {r6('pct_features_considered')} AS pct_features_considered"""


@query("coverage_penalty", f"SELECT {_SCORE_SQL} FROM scores")
def _(t):
    return scoring.profile_scores(_scoring_input(t), t.settings)


@query(
    "profile_rank",
    f"""SELECT {_SCORE_SQL}, CASE WHEN score IS NOT NULL THEN CAST(row_number() OVER (
        PARTITION BY investor_profile ORDER BY score DESC NULLS LAST, cnpj) AS INTEGER) END AS rank
        FROM scores""",
)
def _(t):
    return scoring.scores_per_profile(_scoring_input(t), t.settings)


@query(
    "profile_filters",
    f"""SELECT cnpj, investor_profile, target_investor_type, fund_subtype
        FROM characteristics, (SELECT investor_profile FROM profiles) WHERE {o.ALLOW_LISTS}""",
)
def _(t):
    rows = scoring.with_profiles(t.characteristics(), t.settings.profiles)
    return rows.filter(scoring.profile_filter(t.settings.profiles)).select(
        "cnpj", "investor_profile", "target_investor_type", "fund_subtype"
    )


_RANKING_SQL = f"""SELECT {o.formatted('cnpj')} AS "CNPJ", commercial_name AS "Fund Name",
    investor_profile AS "Investor Profile", {r6('score', 3)} AS "Score",
    CAST(rank_no AS INTEGER) AS "Rank" FROM eligible"""


def _eligible(t: Tables) -> DataFrame:
    scored = scoring.profile_scores(_scoring_input(t), t.settings)
    mark = guardrails.guardrail_mark(t.evidence, t.settings.guardrails)
    return scoring.eligible(scored, mark, t.stored_characteristics, t.settings)


@query("complete_ranking", _RANKING_SQL)
def _(t):
    return scoring.complete_ranking(_eligible(t))


@query("shortlist", f"{_RANKING_SQL} WHERE rank_no <= 5")
def _(t):
    return scoring.shortlist(_eligible(t), t.settings.n_top_funds_output)


@query("cnpj_to_formatted", f'SELECT cnpj, {o.formatted("cnpj")} AS formatted FROM all_funds')
def _(t):
    return t.funds().withColumn("formatted", fc.cnpj_to_formatted("cnpj"))


# -- guardrails ---------------------------------------------------------------------


def _active_rule(name: str) -> Guardrail:
    return Guardrail(True, DEFAULT_GUARDRAILS[name].threshold)


def _rule_sql(name: str) -> str:
    return f"SELECT cnpj, {o.GUARDRAIL_SQL[name]} AS failed FROM features"


def _active_funds(t: Tables) -> DataFrame:
    return t.characteristics().filter("is_active = 1").select("cnpj")


@query("gr_min_offer", _rule_sql("min_offer_per_issuer"))
def _(t):
    characteristics = t.characteristics()
    return guardrails.min_offer_per_issuer(
        _active_funds(t),
        registry.fund_managers(characteristics),
        characteristics,
        _active_rule("min_offer_per_issuer"),
    )


@query("gr_min_sharpe_12m", _rule_sql("min_sharpe_12m"))
def _(t):
    return guardrails.min_sharpe(
        _active_funds(t), t.sharpe(), "12m", _active_rule("min_sharpe_12m")
    )


@query("gr_min_sharpe_3m", _rule_sql("min_sharpe_3m"))
def _(t):
    return guardrails.min_sharpe(_active_funds(t), t.sharpe(), "3m", _active_rule("min_sharpe_3m"))


@query("gr_has_manager", _rule_sql("no_funds_wo_manager"))
def _(t):
    return guardrails.no_funds_without_manager(
        _active_funds(t), t.characteristics(), _active_rule("no_funds_wo_manager")
    )


@query("gr_active", _rule_sql("include_only_active_funds"))
def _(t):
    return guardrails.only_active_funds(
        _active_funds(t),
        t.returns(),
        t.settings.max_ref_date,
        _active_rule("include_only_active_funds"),
    )


@query("gr_extreme_return", _rule_sql("no_extreme_returns"))
def _(t):
    return guardrails.no_extreme_returns(
        _active_funds(t), t.returns(), _active_rule("no_extreme_returns")
    )


@query("gr_cov_12m", _rule_sql("min_cov_sharpe_12m"))
def _(t):
    return guardrails.min_coverage(
        _active_funds(t), t.sharpe(), "12m", _active_rule("min_cov_sharpe_12m")
    )


@query("gr_cov_3m", _rule_sql("min_cov_sharpe_3m"))
def _(t):
    return guardrails.min_coverage(
        _active_funds(t), t.sharpe(), "3m", _active_rule("min_cov_sharpe_3m")
    )


@query("guardrail_mark", "SELECT cnpj, pass_guardrail, failed_guardrails FROM marks")
def _(t):
    return guardrails.guardrail_mark(t.evidence, t.settings.guardrails)


# -- data quality ---------------------------------------------------------------------

_REPORT = ["dataset_name", "validation_name", "passed", "error_count", "affected_groups_count"]


def _report_sql(name: str, check: str, errors: str, groups: str, source: str, wrong: str = "NULL") -> str:
    """``wrong`` tells in SQL what a failed result says."""
    return f"""SELECT '{name}' AS dataset_name, '{check}' AS validation_name,
        {errors} = 0 AS passed, CAST({errors} AS BIGINT) AS error_count,
        CAST({groups} AS BIGINT) AS affected_groups_count, {wrong} AS details FROM {source}"""


_DUPLICATES = """(SELECT count(*) AS n FROM (SELECT 1 FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))"""
_UNIQUENESS_SQL = _report_sql(
    "lineitem", "validate_uniqueness", "n", "n", _DUPLICATES, "n || ' groups occur more than once'"
)


def _uniqueness(t: Tables) -> quality.Validation:
    return quality.validate_uniqueness(
        t.read("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]
    )


@query(
    "validate_uniqueness",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows, (SELECT count(*) FROM (SELECT 1
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS error_count
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def _(t):
    result = _uniqueness(t)
    errors = result.report.select("error_count").scalar()
    return result.affected.select(
        F.get_json_object("affected", "$.l_orderkey").cast("long").alias("l_orderkey"),
        F.get_json_object("affected", "$.l_linenumber").cast("int").alias("l_linenumber"),
        "rows",
        errors.alias("error_count"),
    )


_BOUNDS_SQL = _report_sql(
    "customer",
    "validate_bounds",
    "count_if(c_acctbal < 0)",
    "count_if(c_acctbal < 0)",
    "customer",
    "count_if(c_acctbal < 0) || ' values of c_acctbal are out of bounds (lower 0)'",
)


def _bounds(t: Tables) -> quality.Validation:
    return quality.validate_bounds(
        t.read("customer"), "customer", "c_acctbal", "c_custkey", lower_bound=0
    )


@query(
    "validate_bounds",
    f"""SELECT c_custkey, {r6('c_acctbal')} AS c_acctbal,
        (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS error_count
        FROM customer WHERE c_acctbal < 0""",
)
def _(t):
    result = _bounds(t)
    errors = result.report.select("error_count").scalar()
    return result.affected.select(
        F.get_json_object("affected", "$.c_custkey").cast("long").alias("c_custkey"),
        F.get_json_object("affected", "$.c_acctbal").cast("double").alias("c_acctbal"),
        errors.alias("error_count"),
    )


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
_WRONG = f"o_orderpriority NOT IN ({o.text_list(_PRIORITIES)})"
_ALLOWED_SQL = _report_sql(
    "orders",
    "validate_allowed_values",
    f"count_if({_WRONG})",
    f"count(DISTINCT CASE WHEN {_WRONG} THEN o_orderpriority END)",
    "orders",
    f"count_if({_WRONG}) || ' rows have a value that is not allowed'",
)


def _allowed(t: Tables) -> quality.Validation:
    return quality.validate_allowed_values(
        t.read("orders"), "orders", "o_orderpriority", _PRIORITIES
    )


@query("validate_allowed_values", f"SELECT {', '.join(_REPORT)} FROM ({_ALLOWED_SQL})")
def _(t):
    return _allowed(t).report.select(*_REPORT)


_MONTH = "year(o_orderdate) * 12 + month(o_orderdate)"
_MONTHLY_SQL = f"""SELECT o_custkey, max({_MONTH}) - min({_MONTH}) + 1 AS expected,
    count(DISTINCT {_MONTH}) AS actual,
    max({_MONTH}) - min({_MONTH}) + 1 - count(DISTINCT {_MONTH}) AS missing
    FROM orders GROUP BY o_custkey"""


@query("time_completeness_monthly", _MONTHLY_SQL)
def _(t):
    orders = t.read("orders").select("o_custkey", fc.period_of("o_orderdate").alias("period"))
    return quality.completeness(orders, "period", "o_custkey")


_DAILY_SQL = """SELECT user_id, expected, actual, expected - actual AS missing FROM (
    SELECT user_id, actual, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events
        WHERE CAST(ts AS DATE) BETWEEN first_day AND last_day) AS expected
    FROM (SELECT user_id, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day,
                 count(DISTINCT CAST(ts AS DATE)) AS actual FROM events GROUP BY user_id))"""


@query("time_completeness_daily", _DAILY_SQL)
def _(t):
    return quality.completeness(t.read("events"), "ts", "user_id", "%Y-%m-%d")


_COMPLETENESS_SQL = (
    _report_sql(
        "orders",
        "validate_time_completeness",
        "sum(missing)",
        "count_if(missing > 0)",
        f"({_MONTHLY_SQL})",
        "count_if(missing > 0) || ' groups have gaps (' || sum(missing) || ' missing months)'",
    )
    + " UNION ALL "
    + _report_sql(
        "events",
        "validate_time_completeness",
        "sum(missing)",
        "count_if(missing > 0)",
        f"({_DAILY_SQL})",
        "count_if(missing > 0) || ' groups have gaps (' || sum(missing) || ' missing days)'",
    )
)


def _completeness(t: Tables) -> list[quality.Validation]:
    orders = t.read("orders").select("o_custkey", fc.period_of("o_orderdate").alias("period"))
    return [
        quality.validate_time_completeness(orders, "orders", "period", "o_custkey"),
        quality.validate_time_completeness(
            t.read("events"), "events", "ts", "user_id", "%Y-%m-%d"
        ),
    ]


@query("validate_time_completeness", f"SELECT {', '.join(_REPORT)} FROM ({_COMPLETENESS_SQL})")
def _(t):
    monthly, daily = _completeness(t)
    return monthly.report.unionByName(daily.report).select(*_REPORT)


@query(
    "per_partition_validation",
    f"""SELECT 'lineitem/' || CAST({o.yyyymm('l_shipdate')} AS VARCHAR) AS dataset_name,
        'validate_bounds' AS validation_name, count_if(l_extendedprice > 100000) = 0 AS passed,
        CAST(count_if(l_extendedprice > 100000) AS BIGINT) AS error_count,
        CAST(count_if(l_extendedprice > 100000) AS BIGINT) AS affected_groups_count
        FROM lineitem GROUP BY ALL
        UNION ALL
        SELECT 'lineitem/' || CAST(period AS VARCHAR), 'validate_uniqueness', count_if(n > 1) = 0,
        CAST(count_if(n > 1) AS BIGINT), CAST(count_if(n > 1) AS BIGINT) FROM (SELECT {o.yyyymm('l_shipdate')} AS period,
        count(*) AS n FROM lineitem GROUP BY period, l_suppkey, l_shipdate, l_extendedprice)
        GROUP BY period""",
)
def _(t):
    rows = t.read("lineitem").withColumn(
        "file_name", fc.period_of("l_shipdate").cast("string")
    )
    checks = {
        "validate_bounds": {"value_column": "l_extendedprice", "upper_bound": 100000},
        "validate_uniqueness": {"group_columns": ["l_suppkey", "l_shipdate", "l_extendedprice"]},
    }
    results = quality.run_checks(rows, "lineitem", checks, by="file_name")
    return reduce(DataFrame.unionByName, [r.report for r in results]).select(*_REPORT)


@query(
    "missing_column_check",
    """SELECT 'customer' AS dataset_name, 'validate_bounds' AS validation_name, 'failed' AS status,
       CAST(1 AS BIGINT) AS error_count, 'column not found: C_NO_SUCH' AS details,
       CAST(0 AS BIGINT) AS affected_groups_count
       UNION ALL
       SELECT 'customer', 'validate_allowed_values', CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END, n,
       CASE WHEN n = 0 THEN 'all values of c_mktsegment are allowed'
            ELSE n || ' rows have a value that is not allowed' END, v
       FROM (SELECT count(c_mktsegment) AS n, count(DISTINCT c_mktsegment) AS v FROM customer
             WHERE c_mktsegment <> 'BUILDING')
       UNION ALL
       SELECT 'customer', 'validate_uniqueness', CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END, n,
       CASE WHEN n = 0 THEN 'no group occurs twice' ELSE n || ' groups occur more than once' END, n
       FROM (SELECT count(*) AS n FROM (SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1))""",
)
def _(t):
    checks = {
        "validate_bounds": {"value_column": "C_NO_SUCH", "lower_bound": 0},
        "validate_allowed_values": {"value_column": "c_mktsegment", "allowed_values": ["BUILDING"]},
        "validate_uniqueness": {"group_columns": ["c_custkey"]},
    }
    results = quality.run_checks(t.read("customer"), "customer", checks)
    return quality.validation_report(results, include_passed=True).drop("timestamp")


@query(
    "dataframe_validation_report",
    f"""SELECT dataset_name, validation_name, 'failed' AS status, error_count, details,
        affected_groups_count FROM ({_UNIQUENESS_SQL} UNION ALL {_BOUNDS_SQL} UNION ALL
        {_ALLOWED_SQL} UNION ALL {_COMPLETENESS_SQL}) WHERE NOT passed""",
)
def _(t):
    results = [_uniqueness(t), _bounds(t), _allowed(t), *_completeness(t)]
    return quality.validation_report(results).drop("timestamp")


@query(
    "affected_groups",
    f"""SELECT 'orders' AS dataset_name, 'validate_allowed_values' AS validation_name,
        '{{"o_orderpriority":"' || o_orderpriority || '"}}' AS affected, count(*) AS rows
        FROM orders WHERE {_WRONG} GROUP BY ALL
        UNION ALL
        SELECT 'events', 'validate_time_completeness', '{{"user_id":' || user_id || '}}', missing
        FROM ({_DAILY_SQL}) WHERE missing > 0""",
)
def _(t):
    """Everything at fault, with the number of rows of each wrong value or missing days."""
    return quality.affected_report([_allowed(t), _completeness(t)[1]])


# -- whole runs -------------------------------------------------------------------------


@query(
    "return_evidence",
    f"""SELECT cnpj, {r6('volatility')} AS volatility, {_SHARPE_SQL}, has_latest_data,
        {r6('max_abs_return')} AS max_abs_return
        FROM vol JOIN sharpe USING (cnpj) JOIN last_seen USING (cnpj)""",
)
def _(t):
    evidence = features.return_evidence(
        t.returns(), t.latest_period, t.settings.max_ref_date, t.settings
    )
    return evidence.select(
        "cnpj",
        "volatility",
        "sharpe_12m",
        "sharpe_3m",
        "pct_cov_12m",
        "pct_cov_3m",
        "has_latest_data",
        "max_abs_return",
    )


@query(
    "top_sharpe",
    f"""SELECT cnpj, {_SHARPE_SQL} FROM sharpe WHERE sharpe_12m IS NOT NULL
        ORDER BY sharpe.sharpe_12m DESC, cnpj LIMIT 5""",
)
def _(t):
    return t.sharpe().orderBy(F.desc_nulls_last("sharpe_12m"), "cnpj").limit(5)


_IN_SCOPE = {"chosen": "SELECT cnpj FROM funds_in_scope"}


@query("end_to_end_ranking", _RANKING_SQL, **_IN_SCOPE)
def _(t):
    return pipeline.run(t.raw(), t.settings).complete_ranking


@query(
    "end_to_end_marks",
    "SELECT cnpj, pass_guardrail, failed_guardrails FROM marks",
    **_IN_SCOPE,
)
def _(t):
    return pipeline.run(t.raw(), t.settings).guardrail_mark


assert set(GUARDRAIL_NAMES) == set(o.GUARDRAIL_SQL) and len(RATING_ORDER) == 22
