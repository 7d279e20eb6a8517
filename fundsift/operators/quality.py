"""Data-quality checks of tables.

A check gives two tables. ``report`` has one row (one per partition file when ``by``
is given) with the fixed columns of ``REPORT``. ``affected`` lists everything at
fault, one row per group or value, as JSON text with its row count; it stays a
distributed table, so nothing is cut off however much is wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REPORT = "dataset_name string, validation_name string, passed boolean, error_count long, " \
    "details string, affected_groups_count long"
AFFECTED = "dataset_name string, validation_name string, affected string, rows long"


#: Stores a table and gives it as read back.
Keep = Callable[[DataFrame], DataFrame]


class Validation(NamedTuple):
    report: DataFrame
    affected: DataFrame


def _faults(counted: DataFrame, fault: str, by: str | None, keep: Keep | None) -> tuple[DataFrame, DataFrame]:
    """What the report counts, and what is at fault.

    With ``keep`` the rows at fault are stored once, and the report counts those: without partition
    files, it has one row however many there are. Otherwise each of the two computes ``counted``.
    """
    found = counted.filter(fault)
    if keep is None or by:
        return counted, found
    found = keep(found)
    return found, found


def _dataset(name: str, by: str | None) -> Column:
    return F.concat_ws("/", F.lit(name), F.col(by)) if by else F.lit(name)


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def _absent(df: DataFrame, dataset: str, check: str, columns: list[str]) -> Validation | None:
    """The failed result of a check that names a column the table lacks."""
    absent = missing_columns(df, columns)
    if not absent:
        return None
    spark = df.sparkSession
    row = (dataset, check, False, 1, f"column not found: {', '.join(absent)}", 0)
    return Validation(spark.createDataFrame([row], REPORT), spark.createDataFrame([], AFFECTED))


def _report(
    counted: DataFrame, dataset: str, check: str, by: str | None, fine: str, wrong: Column
) -> DataFrame:
    """``counted`` has ``error_count`` and ``affected_groups_count``, one row per result."""
    errors = F.coalesce("error_count", F.lit(0)).cast("long")
    return counted.select(
        _dataset(dataset, by).alias("dataset_name"),
        F.lit(check).alias("validation_name"),
        (errors == 0).alias("passed"),
        errors.alias("error_count"),
        F.when(errors == 0, F.lit(fine)).otherwise(wrong).alias("details"),
        F.coalesce("affected_groups_count", F.lit(0)).cast("long").alias("affected_groups_count"),
    )


def _affected(
    rows: DataFrame, dataset: str, check: str, by: str | None, columns: list[str], count: Column
) -> DataFrame:
    return rows.select(
        _dataset(dataset, by).alias("dataset_name"),
        F.lit(check).alias("validation_name"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("affected"),
        count.cast("long").alias("rows"),
    )


def _keys(by: str | None) -> list[str]:
    return [by] if by else []


def validate_uniqueness(
    df: DataFrame, dataset: str, group_columns: list[str], by: str | None = None, keep: Keep | None = None
) -> Validation:
    """No combination of the columns occurs twice; nulls count as equal."""
    check = "validate_uniqueness"
    if absent := _absent(df, dataset, check, group_columns):
        return absent
    groups = df.groupBy(*_keys(by), *group_columns).agg(F.count(F.lit(1)).alias("_n"))
    groups, faults = _faults(groups, "_n > 1", by, keep)
    repeated = F.count_if(F.col("_n") > 1)
    counted = groups.groupBy(*_keys(by)).agg(
        repeated.alias("error_count"), repeated.alias("affected_groups_count")
    )
    return Validation(
        _report(
            counted,
            dataset,
            check,
            by,
            "no group occurs twice",
            F.format_string("%d groups occur more than once", "error_count"),
        ),
        _affected(faults, dataset, check, by, group_columns, F.col("_n")),
    )


def _outside(value_column: str, lower_bound: float | None, upper_bound: float | None) -> Column:
    outside = F.lit(False)
    if lower_bound is not None:
        outside = outside | (F.col(value_column) < lower_bound)
    if upper_bound is not None:
        outside = outside | (F.col(value_column) > upper_bound)
    return outside


def _bounds_texts(value_column: str, lower_bound: float | None, upper_bound: float | None) -> tuple[str, str]:
    """What a result says that has passed, and one with %d values at fault."""
    limits = [f"{end} {bound}" for end, bound in (("lower", lower_bound), ("upper", upper_bound)) if bound is not None]
    fine = f"all values of {value_column} are within bounds" if limits else "no bounds given"
    return fine, f"%d values of {value_column} are out of bounds ({', '.join(limits)})"


def validate_bounds(
    df: DataFrame,
    dataset: str,
    value_column: str,
    identifier_column: str | None = None,
    lower_bound: float | None = None,
    upper_bound: float | None = None,
    by: str | None = None,
    keep: Keep | None = None,
) -> Validation:
    """Values lie within the bounds, which belong to the range; nulls pass."""
    check = "validate_bounds"
    named = [value_column] + ([identifier_column] if identifier_column else [])
    if absent := _absent(df, dataset, check, named):
        return absent
    outside = _outside(value_column, lower_bound, upper_bound)
    fine, wrong = _bounds_texts(value_column, lower_bound, upper_bound)
    counted = df.groupBy(*_keys(by)).agg(
        F.count_if(outside).alias("error_count"),
        F.count_if(outside).alias("affected_groups_count"),
    )
    return Validation(
        _report(counted, dataset, check, by, fine, F.format_string(wrong, "error_count")),
        _affected(df.filter(outside), dataset, check, by, list(reversed(named)), F.lit(1)),
    )


def _not_allowed(value_column: str, allowed_values: list[Any]) -> Column:
    return F.col(value_column).isNotNull() & ~F.col(value_column).isin(*allowed_values)


def validate_allowed_values(
    df: DataFrame,
    dataset: str,
    value_column: str,
    allowed_values: list[Any],
    by: str | None = None,
    keep: Keep | None = None,
) -> Validation:
    """Values are among the allowed ones; nulls pass."""
    check = "validate_allowed_values"
    if absent := _absent(df, dataset, check, [value_column]):
        return absent
    value = F.col(value_column)
    wrong = _not_allowed(value_column, allowed_values)
    # All allowed values share one group (null), so only wrong values are spread out.
    per_value = df.groupBy(*_keys(by), F.when(wrong, value).alias(value_column)).agg(
        F.count_if(wrong).alias("_n")
    )
    per_value, faults = _faults(per_value, "_n > 0", by, keep)
    counted = per_value.groupBy(*_keys(by)).agg(
        F.sum("_n").alias("error_count"),
        F.count_if(F.col("_n") > 0).alias("affected_groups_count"),
    )
    return Validation(
        _report(
            counted,
            dataset,
            check,
            by,
            f"all values of {value_column} are allowed",
            F.format_string("%d rows have a value that is not allowed", "error_count"),
        ),
        _affected(faults, dataset, check, by, [value_column], F.col("_n")),
    )


def _time_as_date(df: DataFrame, time_column: str, date_format: str | None) -> Column:
    kind = df.schema[time_column].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.to_date(time_column)
    text = F.col(time_column).cast("string")
    if date_format is None:
        return F.to_date(F.concat(text, F.lit("01")), "yyyyMMdd")
    pattern = reduce(
        lambda p, part: p.replace(*part), [("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd")], date_format
    )
    return F.to_date(text, pattern)


def monthly_completeness(dated: DataFrame, group: list[str]) -> DataFrame:
    """Per group: months from first to last (``expected``) and months present."""
    month = F.year("_date") * 12 + F.month("_date")
    return (
        dated.groupBy(*group)
        .agg(
            F.min(month).alias("_first"),
            F.max(month).alias("_last"),
            F.count_distinct(month).alias("actual"),
        )
        .withColumn("expected", (F.col("_last") - F.col("_first") + 1).cast("long"))
        .select(*group, "expected", "actual", (F.col("expected") - F.col("actual")).alias("missing"))
    )


def daily_completeness(dated: DataFrame, group: list[str], by: str | None = None) -> DataFrame:
    """Per group: dates of the whole table from its first to its last, and dates present.

    The table's distinct dates are numbered once; a group's expected count is the
    distance between the numbers of its first and last date. The numbered dates are
    one row per calendar day at most (under 3.7 million in all of years 1 to 9999),
    which bounds both the window and the broadcast.
    """
    in_order = Window.partitionBy(*_keys(by)).orderBy("_date")
    calendar = (
        dated.select(*_keys(by), "_date")
        .distinct()
        .dropna(subset=["_date"])
        .withColumn("_no", F.row_number().over(in_order))
    )
    spans = dated.groupBy(*group).agg(
        F.min("_date").alias("_first"),
        F.max("_date").alias("_last"),
        F.count_distinct("_date").alias("actual"),
    )

    def numbered(which: str) -> DataFrame:
        days = calendar.withColumnsRenamed({"_date": which, "_no": f"{which}_no"})
        return days if by else F.broadcast(days)

    return (
        spans.join(numbered("_first"), [*_keys(by), "_first"])
        .join(numbered("_last"), [*_keys(by), "_last"])
        .withColumn("expected", (F.col("_last_no") - F.col("_first_no") + 1).cast("long"))
        .select(*group, "expected", "actual", (F.col("expected") - F.col("actual")).alias("missing"))
    )


def completeness(
    df: DataFrame,
    time_column: str,
    group_column: str,
    date_format: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Expected, actual and missing periods per group; daily when the format has a day."""
    dated = df.withColumn("_date", _time_as_date(df, time_column, date_format))
    group = [*_keys(by), group_column]
    if date_format and "%d" in date_format:
        return daily_completeness(dated, group, by)
    return monthly_completeness(dated, group)


def validate_time_completeness(
    df: DataFrame,
    dataset: str,
    time_column: str,
    group_column: str,
    date_format: str | None = None,
    by: str | None = None,
    keep: Keep | None = None,
) -> Validation:
    """No group has a gap between its first and its last period."""
    check = "validate_time_completeness"
    if absent := _absent(df, dataset, check, [time_column, group_column]):
        return absent
    unit = "days" if date_format and "%d" in date_format else "months"
    gaps = completeness(df, time_column, group_column, date_format, by)
    gaps, faults = _faults(gaps, "missing > 0", by, keep)
    counted = gaps.groupBy(*_keys(by)).agg(
        F.sum("missing").alias("error_count"),
        F.count_if(F.col("missing") > 0).alias("affected_groups_count"),
    )
    return Validation(
        _report(
            counted,
            dataset,
            check,
            by,
            f"no group misses any {unit}",
            F.format_string(
                f"%d groups have gaps (%d missing {unit})", "affected_groups_count", "error_count"
            ),
        ),
        _affected(faults, dataset, check, by, [group_column], F.col("missing")),
    )


# Name of a check in the configuration -> the check.
CHECKS = {
    "validate_uniqueness": validate_uniqueness,
    "validate_bounds": validate_bounds,
    "validate_allowed_values": validate_allowed_values,
    "validate_time_completeness": validate_time_completeness,
}


def run_checks(
    df: DataFrame, dataset: str, checks: Mapping[str, Mapping[str, Any]], by: str | None = None, keep: Keep | None = None
) -> list[Validation]:
    """The configured checks of one table, per partition file when ``by`` names them.

    With ``keep`` a check that groups the table does so once, now, and stores what is at fault.
    """
    if unknown := [name for name in checks if name not in CHECKS]:
        raise ValueError(f"unknown checks: {', '.join(unknown)}")
    return [CHECKS[name](df, dataset, by=by, keep=keep, **params) for name, params in checks.items()]


class Watched:
    """Row-by-row checks of a table that are counted by the job that writes it.

    Write ``table`` once, without a shuffle in between, so that a task that runs again is counted
    once; then ``results`` has what ``run_checks`` would have, from the counts where rows decide one by
    one, and from the stored table for checks of groups and where something is at fault.
    """

    def __init__(self, df: DataFrame, dataset: str, checks: Mapping[str, Mapping[str, Any]]):
        if unknown := [name for name in checks if name not in CHECKS]:
            raise ValueError(f"unknown checks: {', '.join(unknown)}")
        self.dataset, self.checks = dataset, checks
        self.faults: dict[str, Column] = {}
        for name, params in checks.items():
            column = params.get("value_column")
            named = [column, params.get("identifier_column") or column]
            if name == "validate_bounds" and not missing_columns(df, named):
                self.faults[name] = _outside(column, params.get("lower_bound"), params.get("upper_bound"))
            elif name == "validate_allowed_values" and not missing_columns(df, named):
                self.faults[name] = _not_allowed(column, params["allowed_values"])
        self.observation = Observation()
        counts = [F.count_if(fault).alias(name) for name, fault in self.faults.items()]
        self.table = df.observe(self.observation, *counts) if counts else df

    def _counted(self, stored: DataFrame, name: str, n: int) -> Validation:
        params = self.checks[name]
        spark = stored.sparkSession
        if name == "validate_bounds":
            fine, wrong = _bounds_texts(params["value_column"], params.get("lower_bound"), params.get("upper_bound"))
        else:
            fine, wrong = f"all values of {params['value_column']} are allowed", ""
        row = (self.dataset, name, n == 0, n, wrong % n if n else fine, n)
        report = spark.createDataFrame([row], REPORT)
        affected = CHECKS[name](stored, self.dataset, **params).affected if n else spark.createDataFrame([], AFFECTED)
        return Validation(report, affected)

    def results(self, stored: DataFrame, keep: Keep | None = None) -> list[Validation]:
        counts = self.observation.get if self.faults else {}
        found = []
        for name, params in self.checks.items():
            # How many different values are not allowed is known only by grouping them.
            if name in counts and (name == "validate_bounds" or not counts[name]):
                found.append(self._counted(stored, name, counts[name]))
            else:
                found.append(CHECKS[name](stored, self.dataset, keep=keep, **params))
        return found


def validation_report(results: list[Validation], include_passed: bool = False) -> DataFrame:
    """All results in one table, only the failed ones by default."""
    together = reduce(DataFrame.unionByName, [r.report for r in results])
    if not include_passed:
        together = together.filter(~F.col("passed"))
    return together.select(
        F.current_timestamp().alias("timestamp"),
        "dataset_name",
        "validation_name",
        F.when(F.col("passed"), "passed").otherwise("failed").alias("status"),
        "error_count",
        "details",
        "affected_groups_count",
    )


def affected_report(results: list[Validation]) -> DataFrame:
    """Everything at fault over all results, one row each."""
    return reduce(DataFrame.unionByName, [r.affected for r in results])
