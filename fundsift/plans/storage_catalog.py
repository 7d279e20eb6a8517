"""Registered queries over stored tables: split files, periods, buckets, monthly moments, whole runs."""

from __future__ import annotations

import uuid
from dataclasses import replace
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundsift.config import RATING_ORDER
from fundsift.functions import columns as fc
from fundsift.functions import quantile
from fundsift.operators import arrivals, features, keys, moments, primary, quality, repair, scope
from fundsift.plans import oracle as o
from fundsift.plans import pipeline
from fundsift.plans.bindings import Tables, small_splits, split_size
from fundsift.plans.catalog import RAW_REPORT_SQL, query
from fundsift.plans.oracle import r6
from fundsift.session import materialize, scratch_path
from fundsift.sources import files, periods, records, sinks

#: Bytes of a split at least, so that a file of the smallest data is read in many.
SPLIT = 50_000

# -- files in several blocks -------------------------------------------------------

_DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())]
)


@query(
    "multiline_records",
    """SELECT CAST(202401 + doc_id % 6 AS INTEGER) AS period, doc_id, lang,
       regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text FROM documents""",
)
def _(t: Tables) -> DataFrame:
    """Documents in six delimited files, text with its line breaks in quotes, read in many parts."""
    path = scratch_path(t.spark, "documents")
    docs = t.read("documents").select("doc_id", "lang", "text", (F.col("doc_id") % 6 + 202401).cast("int").alias("period"))
    writer = docs.repartitionById(6, F.col("period") - 202401).sortWithinPartitions("period", "doc_id").write.partitionBy("period")
    writer.option("header", "true").option("sep", files.SEPARATOR).option("escape", '"').csv(path)
    with small_splits(t.spark, split_size(t.spark, path, SPLIT)):
        table = records.scan_quoted_csv(t.spark, path, _DOCUMENTS, encoding="UTF-8")
        return materialize(table.select("period", "doc_id", "lang", "text"))


_HEADER = "line"
_CHECKS = {"check_redundant_quotes": o.ODD, "check_malformed_quotes": o.EVEN}
_NUMBERED = """numbered AS (
  SELECT CAST(202401 + doc_id % 6 AS INTEGER) AS period, line,
         row_number() OVER (PARTITION BY doc_id % 6 ORDER BY doc_id, line_no) + 1 AS line_no
  FROM (SELECT CAST(file AS BIGINT) AS doc_id, line_no, line FROM lines))"""


@query(
    "affected_lines_in_blocks",
    f"SELECT * FROM (WITH {_NUMBERED} "
    + " UNION ALL ".join(
        f"""SELECT period, '{name}' AS validation_name, line_no FROM numbered
            WHERE regexp_matches(line, '\\S') AND {o.has_field("line", condition)}"""
        for name, condition in _CHECKS.items()
    )
    + ")",
)
def _(t: Tables) -> DataFrame:
    """Both quote checks over the lines of all documents, in six files that are read in many parts."""
    path = scratch_path(t.spark, "lines")
    doc = F.col("file").cast("long")
    lines = t.document_lines().select((doc % 6 + 202401).cast("int").alias("period"), doc.alias("doc"), "seq", "line")
    heads = t.spark.range(6).select((F.col("id") + 202401).cast("int").alias("period"), F.lit(-1).cast("long"), F.lit(0).cast("long"), F.lit(_HEADER))
    every = lines.union(heads).repartitionById(6, F.col("period") - 202401).sortWithinPartitions("period", "doc", "seq")
    every.select("period", "line").write.partitionBy("period").text(path)
    with small_splits(t.spark, split_size(t.spark, path, SPLIT)):
        read = files.raw_lines(t.spark, path, encoding="UTF-8")[_HEADER]
        found = [repair.flagged_line_numbers(read, name).withColumn("validation_name", F.lit(name)) for name in _CHECKS]
        both = found[0].unionByName(found[1])
        return materialize(both.select(files.path_period(F.col("file")).alias("period"), "validation_name", "line_no"))


# -- one period at a time ------------------------------------------------------------

_ITEM = f"l_orderkey, l_linenumber, l_suppkey AS cnpj, {o.yyyymm('l_shipdate')} AS period"
_NEWEST = f"(SELECT DISTINCT {o.yyyymm('l_shipdate')} AS p FROM lineitem ORDER BY 1 DESC LIMIT 12)"


def _items(t: Tables) -> DataFrame:
    items = t.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("cnpj"),
        fc.period_of(F.to_date("l_shipdate")).alias("period"),
        F.col("l_extendedprice").alias("price"),
    )
    return files.recent_periods(items, 12)


def _newest(items: DataFrame) -> list[int]:
    return sorted(r.period for r in items.select("period").distinct().collect())


@query(
    "period_overwrite",
    f"""SELECT {_ITEM}, CASE WHEN {o.yyyymm('l_shipdate')} = third THEN l_extendedprice * 2 ELSE l_extendedprice END AS price
        FROM lineitem, (SELECT min(p) AS first FROM {_NEWEST}), (SELECT p AS third FROM {_NEWEST} ORDER BY p DESC LIMIT 1 OFFSET 2)
        WHERE {o.yyyymm('l_shipdate')} > first AND ({o.yyyymm('l_shipdate')} <> third OR l_orderkey % 2 = 0)""",
)
def _(t: Tables) -> DataFrame:
    """Twelve months are stored, one is replaced, one taken out, and a run that breaks changes nothing."""
    path = scratch_path(t.spark, "periods")
    items = _items(t)
    months = _newest(items)
    periods.write_periods(items, path)
    third = items.filter((F.col("period") == months[-3]) & (F.col("l_orderkey") % 2 == 0))
    periods.write_periods(third.withColumn("price", F.col("price") * 2), path)
    periods.write_periods(items.limit(0), path, periods=[months[0]])
    broken = items.filter(F.col("period") == months[-1]).withColumn("price", F.lit(0.0))
    periods.write_data(broken, path, periods.next_version(t.spark, path))
    return periods.read_periods(t.spark, path).select("l_orderkey", "l_linenumber", "cnpj", "period", "price")


@query(
    "period_append",
    f"""SELECT {_ITEM}, l_extendedprice AS price FROM lineitem
        WHERE {o.yyyymm('l_shipdate')} IN (SELECT p FROM {_NEWEST} ORDER BY p DESC LIMIT 3)""",
)
def _(t: Tables) -> DataFrame:
    """The newest month arrives after the others; what is no longer valid is deleted; the last three are read."""
    path = scratch_path(t.spark, "periods")
    items = _items(t)
    months = _newest(items)
    periods.write_periods(items.filter(F.col("period") < months[-1]), path)
    periods.write_periods(items.filter(F.col("period") == months[-1]), path)
    periods.expire(t.spark, path)
    return periods.read_periods(t.spark, path, 3).select("l_orderkey", "l_linenumber", "cnpj", "period", "price")


# -- buckets and moments ----------------------------------------------------------------


def _stored_nav(t: Tables) -> DataFrame:
    """Daily NAV in eight buckets by fund, in order of fund and date."""
    name = f"nav_{uuid.uuid4().hex}"
    return sinks.write_bucketed(t.daily_nav(), name, scratch_path(t.spark, name), "cnpj", ["cnpj", "date"], 8)


@query(
    "returns_from_buckets",
    f"""SELECT cnpj, date, period, {r6('quota_value')} AS quota_value, {r6('quota_value_previous')} AS quota_value_previous,
        {r6('daily_return')} AS daily_return, date_rank FROM returns""",
)
def _(t: Tables) -> DataFrame:
    return primary.daily_returns(_stored_nav(t))


@query(
    "risk_from_buckets",
    f"""SELECT cnpj, {r6('volatility')} AS volatility, {r6('volatility_12m')} AS volatility_12m,
        {r6('volatility_3m')} AS volatility_3m, {r6('sharpe_12m')} AS sharpe_12m, {r6('sharpe_3m')} AS sharpe_3m
        FROM vol JOIN sharpe USING (cnpj)""",
)
def _(t: Tables) -> DataFrame:
    """Volatility and Sharpe ratios from stored NAV without an exchange, the join of both included."""
    returns = primary.daily_returns(_stored_nav(t))
    volatility = features.volatility(returns, t.latest_period, t.settings).drop("ref_date")
    sharpe = features.sharpe_ratio(returns, t.latest_period, t.settings)
    return volatility.join(sharpe.select("cnpj", "sharpe_12m", "sharpe_3m"), "cnpj")


def _rows_back(n: int) -> str:
    return f"OVER (PARTITION BY cnpj ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_LONG, _SHORT = _rows_back(o.LONG), _rows_back(o.SHORT)
_SCALE = f"sqrt({o.LONG}) * stddev_samp(daily_return)"


def _capped(window: str) -> str:
    cap, least = o.num(o.SETTINGS.sharpe_cap), o.num(o.SETTINGS.epsilon_volatility)
    return f"CASE WHEN volatility_{window} > {least} THEN least(greatest(excess_{window} / volatility_{window}, -{cap}), {cap}) END"


@query(
    "risk_by_month",
    f"""SELECT * FROM (WITH daily AS (
          SELECT cnpj, date, period, {_SCALE} OVER (PARTITION BY cnpj ORDER BY date) AS volatility,
                 {_SCALE} {_LONG} AS volatility_12m, {_SCALE} {_SHORT} AS volatility_3m,
                 {o.LONG} * (avg(daily_return) {_LONG} - {o.num(o.SETTINGS.risk_free_rate_daily)}) AS excess_12m,
                 {o.LONG} * (avg(daily_return) {_SHORT} - {o.num(o.SETTINGS.risk_free_rate_daily)}) AS excess_3m
          FROM returns)
        SELECT cnpj, period, {r6('volatility')} AS volatility, {r6('volatility_12m')} AS volatility_12m,
               {r6('volatility_3m')} AS volatility_3m, {r6(_capped('12m'))} AS sharpe_12m, {r6(_capped('3m'))} AS sharpe_3m
        FROM daily QUALIFY row_number() OVER (PARTITION BY cnpj, period ORDER BY date DESC) = 1)""",
)
def _(t: Tables) -> DataFrame:
    """Risk at the end of every month of every fund; the months are stored, and the newest is added later."""
    path = scratch_path(t.spark, "moments")
    made = materialize(moments.monthly_moments(t.returns()))
    last = t.latest_period
    periods.write_periods(made.filter(F.col("period") <= last), path)
    periods.write_periods(made.filter(F.col("period") > last), path)
    return moments.by_month(periods.read_periods(t.spark, path), t.settings)


# -- a whole run with its reports -----------------------------------------------------------

_SCOPED = "cnpj IN (SELECT cnpj FROM funds_in_scope)"


def _result(dataset: str, check: str, source: str, errors: str, groups: str, fine: str, wrong: str) -> str:
    return f"""SELECT 'quality' AS report, '{dataset}' AS dataset_name, '{check}' AS validation_name,
        CASE WHEN {errors} = 0 THEN 'passed' ELSE 'failed' END AS status, CAST({errors} AS BIGINT) AS n,
        CASE WHEN {errors} = 0 THEN '{fine}' ELSE {wrong} END AS details, CAST({groups} AS BIGINT) AS n_affected FROM {source}"""


def _unique(dataset: str, source: str, columns: str) -> str:
    repeated = f"(SELECT count(*) AS n FROM (SELECT 1 FROM {source} GROUP BY {columns} HAVING count(*) > 1))"
    return _result(dataset, "validate_uniqueness", repeated, "n", "n", "no group occurs twice", "n || ' groups occur more than once'")


def _not_negative(dataset: str, source: str, column: str, name: str) -> str:
    counted = f"(SELECT count_if({column} < 0) AS n FROM {source})"
    wrong = f"n || ' values of {name} are out of bounds (lower 0)'"
    return _result(dataset, "validate_bounds", counted, "n", "n", f"all values of {name} are within bounds", wrong)


def _complete(dataset: str, source: str, gaps: str, unit: str) -> str:
    counted = f"(SELECT sum(missing) AS m, count_if(missing > 0) AS g FROM ({gaps.format(source=source)}))"
    wrong = f"g || ' groups have gaps (' || m || ' missing {unit})'"
    return _result(dataset, "validate_time_completeness", counted, "m", "g", f"no group misses any {unit}", wrong)


_DAYS = """SELECT (SELECT count(DISTINCT date) FROM {source} WHERE date BETWEEN low AND high) - actual AS missing
    FROM (SELECT min(date) AS low, max(date) AS high, count(DISTINCT date) AS actual FROM {source} GROUP BY cnpj)"""
_MONTHS = """SELECT max(m) - min(m) + 1 - count(DISTINCT m) AS missing
    FROM (SELECT cnpj, year(dt) * 12 + month(dt) AS m FROM {source}) GROUP BY cnpj"""
_NAV_IN_SCOPE = f"(SELECT * FROM daily_nav WHERE {_SCOPED})"
_RETURNS_IN_SCOPE = f"(SELECT * FROM returns WHERE {_SCOPED})"
_QUOTAS_IN_SCOPE = f"(SELECT * FROM quotas WHERE {_SCOPED})"
_MONTHS_IN_SCOPE = f"(SELECT * FROM monthly_nav_raw WHERE {_SCOPED})"
_WRONG_RATINGS = f"""(SELECT rating FROM positions WHERE blc_type = 'blc_5' AND rating NOT IN ({o.text_list(RATING_ORDER)}))"""
_QUALITY_SQL = " UNION ALL ".join(
    [
        _unique("monthly_nav", "monthly_nav_raw", "raw_id, dt, nav"),
        _not_negative("monthly_nav", "monthly_nav_raw", "nav", "VL_PATRIM_LIQ"),
        _result(
            "blc_5",
            "validate_allowed_values",
            f"(SELECT count(*) AS n, count(DISTINCT rating) AS v FROM {_WRONG_RATINGS})",
            "n",
            "v",
            "all values of GRAU_RISCO are allowed",
            "n || ' rows have a value that is not allowed'",
        ),
        _unique("funds_in_scope", "funds_in_scope", "cnpj"),
        _unique("daily_quotas", _QUOTAS_IN_SCOPE, "cnpj, dt"),
        _not_negative("daily_quotas", _QUOTAS_IN_SCOPE, "quota", "VL_QUOTA"),
        _unique("monthly_pl", _MONTHS_IN_SCOPE, "cnpj, dt"),
        _not_negative("monthly_pl", _MONTHS_IN_SCOPE, "nav", "VL_PATRIM_LIQ"),
        _complete("daily_nav", _NAV_IN_SCOPE, _DAYS, "days"),
        _unique("daily_nav", _NAV_IN_SCOPE, "cnpj, date"),
        _complete("daily_returns", _RETURNS_IN_SCOPE, _DAYS, "days"),
        _unique("daily_returns", _RETURNS_IN_SCOPE, "cnpj, date"),
        _complete("nav_per_period", _MONTHS_IN_SCOPE, _MONTHS, "months"),
        _unique("nav_per_period", _MONTHS_IN_SCOPE, "cnpj, dt"),
        # Instrument ids are numbered, so they cannot repeat.
        _result("instrument_prices", "validate_uniqueness", "(SELECT 0 AS n)", "n", "n", "no group occurs twice", "NULL"),
    ]
)
_REPAIR_SQL = f"""SELECT 'repair' AS report, dataset_name, validation_name, status, affected_lines_count AS n, details,
    affected_lines_count AS n_affected FROM ({RAW_REPORT_SQL})"""


@query("end_to_end_reports", f"{_QUALITY_SQL} UNION ALL {_REPAIR_SQL}")
def _(t: Tables) -> DataFrame:
    """All results that a stored run keeps, with the number of rows at fault that it keeps for each."""
    root = scratch_path(t.spark, "run")
    pipeline.run_and_store(t.raw(), t.settings, root, {"documents": t.document_lines()})

    def kept(name: str) -> DataFrame:
        return sinks.read_table(t.spark, f"{root}/reports/{name}")

    def with_faults(report: DataFrame, affected: DataFrame, keys: list[str]) -> DataFrame:
        counts = affected.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_affected"))
        return report.join(counts, keys, "left").withColumn("n_affected", F.coalesce("n_affected", F.lit(0)))

    keys = ["dataset_name", "validation_name"]
    checks = with_faults(kept("quality"), kept("quality_affected"), keys)
    lines = kept("repair_affected").withColumn("dataset_name", F.concat(F.lit("documents/"), "file"))
    repairs = with_faults(kept("repair"), lines, keys)
    columns = [*keys, "status", "n", "details", "n_affected"]
    both = [
        checks.withColumnRenamed("error_count", "n").select(F.lit("quality").alias("report"), *columns),
        repairs.withColumnRenamed("affected_lines_count", "n").select(F.lit("repair").alias("report"), *columns),
    ]
    return both[0].unionByName(both[1])


_NEGATIVE = "count_if(c_acctbal < 0)"
_NOT_ALLOWED = "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"


@query(
    "checks_while_writing",
    f"""SELECT * EXCLUDE (report) FROM ({_not_negative("customer", "customer", "c_acctbal", "c_acctbal")} UNION ALL
        {_result("orders", "validate_allowed_values",
                 f"(SELECT count_if({_NOT_ALLOWED}) AS n, count(DISTINCT CASE WHEN {_NOT_ALLOWED} THEN o_orderpriority END) AS v FROM orders)",
                 "n", "v", "all values of o_orderpriority are allowed", "n || ' rows have a value that is not allowed'")} UNION ALL
        {_result("orders", "validate_bounds", "(SELECT count_if(o_totalprice < 0 OR o_totalprice > 1e9) AS n FROM orders)", "n", "n",
                 "all values of o_totalprice are within bounds", "n || ' values of o_totalprice are out of bounds'")})""",
)
def _(t: Tables) -> DataFrame:
    """Checks of two tables, counted by the jobs that store them."""
    wanted = {
        "customer": {"validate_bounds": {"value_column": "c_acctbal", "lower_bound": 0}},
        "orders": {
            "validate_allowed_values": {"value_column": "o_orderpriority", "allowed_values": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
            "validate_bounds": {"value_column": "o_totalprice", "lower_bound": 0, "upper_bound": 1e9},
        },
    }
    results = []
    for name, checks in wanted.items():
        watched = quality.Watched(t.read(name), name, checks)
        results += watched.results(sinks.write_table(watched.table, scratch_path(t.spark, name)))
    report = quality.validation_report(results, include_passed=True).drop("timestamp")
    return report.withColumnsRenamed({"error_count": "n", "affected_groups_count": "n_affected"})


_SHARES = [0.01, 0.25, 0.5, 0.95, 0.999]
_MEASURES = {"price": "l_extendedprice", "discount": "l_discount"}


@query(
    "quantiles_from_sketches",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS measure, {o.num(share)} AS share, {r6(f"max(CASE WHEN i = floor((n - 1) * {o.num(share)} + 0.5e0) + 1 THEN v END)")} AS value
            FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) AS i, count(*) OVER () AS n FROM lineitem)"""
        for name, column in _MEASURES.items()
        for share in _SHARES
    ),
)
def _(t: Tables) -> DataFrame:
    """Exact quantiles of a table whose periods have stored sketches, the newest of them added last."""
    path = scratch_path(t.spark, "sketches")
    items = t.read("lineitem").select(
        fc.period_of(F.to_date("l_shipdate")).alias("period"), *[F.col(c).alias(name) for name, c in _MEASURES.items()]
    )
    newest = items.agg(F.max("period")).first()[0]
    for part in (F.col("period") < newest, F.col("period") == newest):
        periods.write_periods(quantile.sketches_by(items.filter(part), list(_MEASURES)), path)
    found = quantile.nearest_quantiles(items, list(_MEASURES), _SHARES, max_pick=500, sketches=periods.read_periods(t.spark, path))
    rows = [(name, share, value) for name, values in found.items() for share, value in zip(_SHARES, values)]
    return t.spark.createDataFrame(rows, "measure string, share double, value double")


@query(
    "filter_by_spelling",
    f"""SELECT cnpj, commercial_name, accessability, anbima_category_main AS category FROM registry_kept""",
)
def _(t: Tables) -> DataFrame:
    """One spelling in the settings finds the registry rows of all, whatever their case and accents."""
    settings = replace(t.settings, registry_categories=("RENDA FIXA",), accessability=("nao ha restricao",), collation="UNICODE_CI_AI")
    kept = scope.filter_registry(t.registry(), settings)
    return kept.select(
        F.col("CNPJ do Fundo").alias("cnpj"),
        F.col("Nome Comercial").alias("commercial_name"),
        F.col("Tipo de Investidor").alias("accessability"),
        F.col("Categoria ANBIMA").alias("category"),
    )


def _periods_at(nav: DataFrame, shares: list[float]) -> list[int]:
    """Periods that complete these shares of the rows that have one; only a number for each period reaches the driver."""
    counts = sorted(tuple(r) for r in nav.filter("period IS NOT NULL").groupBy("period").count().collect())
    total, found = list(accumulate(n for _, n in counts)), []
    for share in shares:
        found.append(next(period for (period, _), n in zip(counts, total, strict=True) if n >= share * total[-1]))
    return found


@query(
    "returns_month_by_month",
    f"""SELECT cnpj, date, period, {r6('quota_value')} AS quota_value, {r6('quota_value_previous')} AS quota_value_previous,
        {r6('daily_return')} AS daily_return FROM returns""",
)
def _(t: Tables) -> DataFrame:
    """Months of daily NAV arrive in three parts, each read by a run of its own."""
    source, target, checkpoint = (scratch_path(t.spark, name) for name in ("arrived", "returns", "progress"))
    nav = materialize(t.daily_nav())
    low, high = _periods_at(nav, [0.4, 0.8])
    month = F.col("period")
    for part in (month <= low, (month > low) & (month <= high), month > high):
        nav.filter(part).write.mode("append").parquet(source)
        returns = arrivals.add_arrived(t.spark, source, target, checkpoint)
    return returns


@query(
    "scope_scan",
    f"""SELECT cnpj, dt AS day, {r6('nav')} AS nav, {o.yyyymm('dt')} AS period FROM quotas
        WHERE {_SCOPED} AND {o.yyyymm('dt')} IN (SELECT p FROM {_NEWEST})""",
)
def _(t: Tables) -> DataFrame:
    """Quotas of funds in scope from files by month, sorted by fund: other months and most other funds are not read."""
    quotas = t.quotas().select("cnpj", F.col("DT_COMPTC").alias("day"), F.col("VL_PATRIM_LIQ").alias("nav"), fc.period_of("DT_COMPTC").alias("period"))
    stored = sinks.write_table(quotas, scratch_path(t.spark, "quotas"), "period", rebalance=True, sort_by=["cnpj"])
    ids = materialize(scope.funds_in_scope(t.raw_monthly_nav(), t.registry(), t.latest_period, t.settings))
    return keys.keep_stored_keys(files.recent_periods(stored, 12), ids, "cnpj")
