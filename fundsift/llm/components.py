"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsift.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of those."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``edges``.

    ``edges`` has long columns a and b, in either direction, repeated or not; nulls and
    loops are left out. Each step is written to the shared folder. A star's centre may
    have any number of neighbours: minima are taken before the shuffle, and the joins
    back can be split.
    """
    clean = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()
    now = stage(clean, "edges")
    seen = _print_of(now)
    while seen[0]:
        now = stage(_small_star(stage(_large_star(now), "large-star")), "small-star")
        found = _print_of(now)
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
