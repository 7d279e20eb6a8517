"""Exact nearest-rank quantiles of several columns at once, at any size.

Spark's ``percentile`` interpolates and keeps every distinct value in one task;
``percentile_approx`` is bounded but inexact. Here the bounded sketch only narrows
the search: each pass shrinks, per wanted rank, an open value interval known to
hold it, until the rows left inside fit a fixed budget and the value can be picked
exactly. Every pass is one aggregate with map-side combine and one result row.
Values that repeat often sit at an interval end sooner or later, where they are
recognised by their count, so repeats need no extra room.

A table that grows by period can keep a mergeable sketch of each period. Merged, they give the
number of values and the first interval, so that only the counts and the pick read the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PICK = 50_000
SKETCH_ACCURACY = 20_000

#: Size of a stored sketch (about 80 kB), and the share by which its ranks may be wrong, doubled for safety.
SKETCH_SIZE = 4000
SKETCH_ERROR = 0.003


@dataclass
class _Target:
    """Wanted: zero-based ``rank`` among the ``size`` values in (lower, upper)."""

    column: str
    rank: int
    size: int
    margin: float
    lower: float | None = None
    upper: float | None = None
    found: float | None = None

    @property
    def values(self) -> Column:
        value = F.col(self.column)
        inside = ~F.isnan(value)
        if self.lower is not None:
            inside &= value > self.lower
        if self.upper is not None:
            inside &= value < self.upper
        return F.when(inside, value)

    def shrink(self, low: float, high: float, counts: dict[str, int]) -> None:
        """Move to the part around the rank; ``low`` and ``high`` bracket it."""
        offset = self.rank - counts["below"]
        inner = counts["between"]
        if 0 <= offset < counts["low"]:
            self.found = low
        elif 0 <= offset - counts["low"] < inner:
            self.lower, self.upper = low, high
            self.rank, self.size = offset - counts["low"], inner
        elif 0 <= offset - counts["low"] - inner < counts["high"]:
            self.found = high
        else:  # the sketch missed the rank: look wider next time
            self.margin *= 4


def _narrow(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    sketches = []
    for i, t in enumerate(targets):
        share = t.rank / (t.size - 1)
        ends = [max(share - t.margin, 0.0), min(share + t.margin, 1.0)]
        sketches.append(F.percentile_approx(t.values, ends, accuracy).alias(f"q{i}"))
    brackets = df.agg(*sketches).first()
    _shrink(df, targets, list(brackets))


def _shrink(df: DataFrame, targets: list[_Target], brackets: list[tuple[float, float]]) -> None:
    """Count the values around each bracket and move the targets to the part that has their rank."""
    counters = []
    for i, (t, (low, high)) in enumerate(zip(targets, brackets)):
        v = t.values
        counters.append(
            F.struct(
                F.count_if(v < low).alias("below"),
                F.count_if(v == low).alias("low"),
                F.count_if((v > low) & (v < high)).alias("between"),
                F.count_if((v == high) & F.lit(low < high)).alias("high"),
                F.count(v).alias("all"),
            ).alias(f"c{i}")
        )
    counted = df.agg(*counters).first()
    for i, (t, (low, high)) in enumerate(zip(targets, brackets)):
        if counted[f"c{i}"]["all"] != t.size:
            raise ValueError(f"{t.column} has {counted[f'c{i}']['all']} values, its sketches {t.size}")
        t.shrink(low, high, counted[f"c{i}"].asDict())


def sketches_by(df: DataFrame, columns: list[str], group: str = "period") -> DataFrame:
    """One row per group with a mergeable sketch of each column, without nulls and NaN."""
    values = [F.kll_sketch_agg_double(F.when(~F.isnan(c), F.col(c)), SKETCH_SIZE).alias(c) for c in columns]
    return df.groupBy(group).agg(*values)


def _first_brackets(sketches: DataFrame, targets: list[tuple[str, float]]) -> tuple[dict, dict]:
    """Numbers of values by column, and the interval in which each target lies, from merged sketches alone."""
    columns = sorted({c for c, _ in targets})
    merged = sketches.agg(*[F.kll_merge_agg_double(c, SKETCH_SIZE).alias(c) for c in columns])
    sizes = [F.coalesce(F.kll_sketch_get_n_double(c), F.lit(0)).alias(f"n_{c}") for c in columns]
    merged = merged.select("*", *sizes)
    ends = []
    for i, (c, share) in enumerate(targets):
        shares = F.array(F.lit(max(share - SKETCH_ERROR, 0.0)), F.lit(min(share + SKETCH_ERROR, 1.0)))
        ends.append(F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(c, shares)).alias(f"q{i}"))
    row = merged.select(*[f"n_{c}" for c in columns], *ends).first()
    return {c: row[f"n_{c}"] for c in columns}, {t: row[f"q{i}"] for i, t in enumerate(targets)}


def _pick(df: DataFrame, targets: list[_Target]) -> None:
    picks = [
        F.get(F.sort_array(F.collect_list(t.values)), F.lit(t.rank)).alias(f"v{i}")
        for i, t in enumerate(targets)
    ]
    row = df.agg(*picks).first()
    for i, t in enumerate(targets):
        t.found = row[f"v{i}"]


def nearest_quantiles(
    df: DataFrame,
    columns: list[str],
    shares: list[float],
    max_pick: int = MAX_PICK,
    accuracy: int = SKETCH_ACCURACY,
    sketches: DataFrame | None = None,
) -> dict[str, list[float | None]]:
    """Per column, the value at rank floor((n-1)*share + 0.5) for each share.

    Nulls and NaN do not count. ``df`` is scanned a few times, so pass a table that
    is stored or materialized. With ``sketches`` (rows of ``sketches_by`` that together stand for
    ``df``) it is scanned twice, as a rule: to count around the intervals, and to pick. Sketches of
    other rows than those of ``df`` are an error.
    """
    brackets = {}
    if sketches is None:
        sizes = df.agg(*[F.count(F.when(~F.isnan(c), F.col(c))).alias(c) for c in columns]).first()
    else:
        sizes, brackets = _first_brackets(sketches, [(c, s) for c in columns for s in shares])
    targets = {
        (c, s): _Target(
            column=c,
            rank=math.floor((sizes[c] - 1) * s + 0.5),
            size=sizes[c],
            margin=2.0 / accuracy,
        )
        for c in columns
        for s in shares
        if sizes[c]
    }
    known = [(t, brackets[key]) for key, t in targets.items() if key in brackets and t.size > max_pick]
    if known:
        _shrink(df, [t for t, _ in known], [b for _, b in known])
    while True:
        open_targets = [t for t in targets.values() if t.found is None]
        large = [t for t in open_targets if t.size > max_pick]
        if not large:
            break
        _narrow(df, large, accuracy)
    if open_targets:
        _pick(df, open_targets)
    return {
        c: [targets[c, s].found if (c, s) in targets else None for s in shares]
        for c in columns
    }
