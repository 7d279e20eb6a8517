"""Finding and repairing badly quoted lines of delimited text files.

The input is a table of lines: ``file``; ``block``, the piece of the file a line was
read in; ``seq``, increasing by one per line within a block; ``is_header``; ``line``.
Line numbers come from adding up block sizes, so no file has to fit in one task. Line numbers always refer
to the file as it is stored. Nothing is rewritten in place: the repaired lines are a
derived table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundsift.functions import quotes
from fundsift.session import materialize

FIX, IGNORE = "fix", "ignore"
# A file may lose at most this share of its lines to one step.
MAX_LOSS = 0.5


class Check(NamedTuple):
    affected: Callable[[Column], Column]
    fix: Callable[[Column], Column] | None
    problem: str
    action: str


# Name of a check in the configuration -> the check.
CHECKS = {
    "check_redundant_quotes": Check(
        quotes.has_redundant_quotes, quotes.fix_redundant_quotes, "redundant quotes", "removed"
    ),
    "check_malformed_quotes": Check(
        quotes.has_malformed_quotes, quotes.fix_malformed_quotes, "malformed quotes", "doubled"
    ),
}
DEFAULT_STEPS = {"check_redundant_quotes": FIX, "check_malformed_quotes": FIX}


def _blank() -> Column:
    return ~F.rlike("line", F.lit(r"\S"))


def _checked() -> Column:
    return ~F.col("is_header") & ~_blank()


def flagged(lines: DataFrame, check: str) -> DataFrame:
    """Lines that fail the check; headers and blank lines are left alone."""
    return lines.filter(_checked() & CHECKS[check].affected(F.col("line")))


def flagged_line_numbers(lines: DataFrame, check: str) -> DataFrame:
    """(file, line_no) of the lines that fail the check, from one read of the lines."""
    marked = _mark(lines, {check: FIX})
    return _line_numbers(marked, _per_block(marked, 1), 0)


def _usable(steps: Mapping[str, str]) -> list[tuple[str, str]]:
    """The steps in order. A check without a repair drops its lines instead."""
    if unknown := [name for name in steps if name not in CHECKS]:
        raise ValueError(f"unknown checks: {', '.join(unknown)}")
    return [
        (name, IGNORE if CHECKS[name].fix is None else strategy)
        for name, strategy in steps.items()
    ]


def _mark(lines: DataFrame, steps: Mapping[str, str]) -> DataFrame:
    """Applies the steps in order, keeping every line.

    ``hit_i`` tells which lines step i repaired or dropped and ``alive`` which lines
    are left; ``lost_i`` is the share of its lines that the step would cost a file.
    A step that costs a file too much is undone for that file.
    """
    lines = lines.withColumn("alive", F.lit(True))
    for i, (name, strategy) in enumerate(_usable(steps)):
        check = CHECKS[name]
        hit = F.col("alive") & _checked() & check.affected(F.col("line"))
        lines = lines.withColumn(f"hit_{i}", hit)
        if strategy == FIX:
            lines = lines.withColumns(
                {
                    "line": F.when(F.col(f"hit_{i}"), check.fix(F.col("line"))).otherwise(
                        F.col("line")
                    ),
                    f"rejected_{i}": F.lit(False),
                }
            )
            continue
        # Dropping lines also drops the blank lines of a file that loses any.
        dropped = F.col(f"hit_{i}") | (_blank() & ~F.col("is_header"))
        per_file = lines.groupBy("file").agg(
            F.bool_or(f"hit_{i}").alias("_any"),
            (F.count_if(F.col("alive") & ~dropped) < F.count(F.lit(1)) * (1 - MAX_LOSS)).alias(
                "_much"
            ),
        )
        losing = per_file.filter(F.col("_any") & ~F.col("_much")).select("file")
        losing = materialize(losing.withColumn("_loses", F.lit(True)))
        going = F.col("alive") & dropped
        loses = F.coalesce("_loses", F.lit(False))
        lines = (
            lines.join(losing, "file", "left")
            .withColumns(
                {
                    "alive": F.col("alive") & ~(going & loses),
                    f"rejected_{i}": F.col(f"hit_{i}") & ~loses,
                }
            )
            .drop("_loses")
        )
    return lines


def repair(lines: DataFrame, steps: Mapping[str, str] = DEFAULT_STEPS) -> DataFrame:
    """The lines after all steps. With repairs only, a projection without a shuffle."""
    return _mark(lines, steps).filter("alive").select("file", "block", "seq", "is_header", "line")


def drop_affected_lines(lines: DataFrame, check: str) -> DataFrame:
    """Lines without those that fail the check; a file that loses any loses blanks too."""
    return repair(lines, {check: IGNORE})


def line_loss(lines: DataFrame, check: str) -> DataFrame:
    """Per file: lines before and after dropping, and whether that is accepted."""
    hit = _checked() & CHECKS[check].affected(F.col("line"))
    counted = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines_before"),
        F.count_if(hit).alias("lines_hit"),
        F.count_if(F.col("is_header") | ~(hit | _blank())).alias("_kept"),
    )
    after = F.when(F.col("lines_hit") > 0, F.col("_kept")).otherwise(F.col("lines_before"))
    return counted.select(
        "file",
        "lines_before",
        "lines_hit",
        after.alias("lines_after"),
        (after >= F.col("lines_before") * (1 - MAX_LOSS)).alias("accepted"),
    )


def _per_block(marked: DataFrame, n_steps: int) -> DataFrame:
    """One row per block: its first line number, and per step its hits and rejection."""
    columns = []
    for i in range(n_steps):
        columns += [
            F.count_if(f"hit_{i}").alias(f"hits_{i}"),
            F.bool_or(f"rejected_{i}").alias(f"rejected_{i}"),
        ]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = marked.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), *columns
    )
    return materialize(
        blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    )


def _line_numbers(marked: DataFrame, blocks: DataFrame, step: int) -> DataFrame:
    """(file, line_no) of a step's hits: the place in the block plus the lines before it."""
    hits = marked.filter(F.col(f"hit_{step}")).select("file", "block", "seq")
    placed = hits.join(blocks.select("file", "block", "first", "before"), ["file", "block"])
    return placed.select(
        "file", (F.col("seq") - F.col("first") + F.col("before") + 1).alias("line_no")
    )


class RepairReport(NamedTuple):
    report: DataFrame
    affected: DataFrame


def _step_report(blocks: DataFrame, step: int, dataset: str, name: str, strategy: str) -> DataFrame:
    per_file = blocks.groupBy("file").agg(
        F.sum(f"hits_{step}").alias("total"), F.bool_or(f"rejected_{step}").alias("rejected")
    )
    check = CHECKS[name]
    action = check.action if strategy == FIX else "dropped"
    return per_file.select(
        F.current_timestamp().alias("timestamp"),
        F.concat(F.lit(f"{dataset}/"), F.element_at(F.split("file", "/"), -1)).alias(
            "dataset_name"
        ),
        F.lit(name).alias("validation_name"),
        F.when(F.col("rejected"), "failed")
        .when(F.col("total") > 0, "fixed")
        .otherwise("passed")
        .alias("status"),
        F.lit(strategy).alias("strategy_applied"),
        F.when(F.col("rejected"), F.lit("undone: too many lines would be lost"))
        .when(F.col("total") > 0, F.format_string(f"{check.problem} {action} in %d lines", "total"))
        .otherwise(F.lit(f"no {check.problem}"))
        .alias("details"),
        F.col("total").alias("affected_lines_count"),
        F.when(F.col("rejected"), 0).otherwise(F.col("total")).alias("fixes_applied"),
    )


def raw_validation(
    lines: DataFrame,
    dataset: str,
    steps: Mapping[str, str] = DEFAULT_STEPS,
    include_passed: bool = False,
) -> RepairReport:
    """What the steps found and did, per file and check.

    ``report`` has counts; ``affected`` has one row per file, check and affected line. A
    repair that was undone is failed.
    """
    usable = _usable(steps)
    marked = _mark(lines, steps)
    blocks = _per_block(marked, len(usable))
    report = reduce(
        DataFrame.unionByName,
        [_step_report(blocks, i, dataset, *step) for i, step in enumerate(usable)],
    )
    affected = reduce(
        DataFrame.unionByName,
        [
            _line_numbers(marked, blocks, i).withColumn("validation_name", F.lit(name))
            for i, (name, _) in enumerate(usable)
        ],
    )
    if not include_passed:
        report = report.filter(F.col("status") != "passed")
    return RepairReport(report, affected.select("file", "validation_name", "line_no"))


def summary(report: DataFrame) -> DataFrame:
    """Number of results by status and by check."""

    def counts(column: str) -> DataFrame:
        return report.groupBy(F.col(column).alias("name")).agg(
            F.lit(column).alias("kind"), F.count(F.lit(1)).alias("n")
        )

    return counts("status").unionByName(counts("validation_name")).select("kind", "name", "n")


def failures(report: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failed results by dataset and check."""
    return (
        report.filter(F.col("status") == "failed")
        .orderBy("dataset_name", "validation_name")
        .limit(n)
    )
