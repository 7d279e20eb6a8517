"""Shards that each match the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranking cells per shuffle partition, and the most rows a cell should have.
CELLS_PER_PARTITION = 8
ROWS_PER_CELL = 20_000


def _unit(digest: Column) -> Column:
    """A hexadecimal digest as a number in [0, 1), from its first 32 bits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _ranked(rows: DataFrame, groups: list[str], unit: str, order: list[str], cells: int, name: str):
    """Add the rank from 1 within each group, where ``unit`` in [0, 1) is the leading order.

    A group is cut into cells by ``unit``; counts of cells give each cell's offset, and only
    a cell is sorted in one task, so a group may hold any share of the rows.
    """
    cut = rows.withColumn("_cell", F.floor(F.col(unit) * cells))
    key = [*groups, "_cell"]
    counts = cut.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    offsets = offsets.select(*[F.col(k).alias(f"_o{k}") for k in key], "_before")
    inside = cut.withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy(unit, *order)))
    same = [F.col(k).eqNullSafe(F.col(f"_o{k}")) for k in key]
    joined = inside.join(offsets, same, "left")
    return joined.withColumn(name, F.col("_at") + F.col("_before")).drop(
        "_cell", "_at", "_before", *[f"_o{k}" for k in key]
    )


def interleave(docs: DataFrame, shards: int, seed: str = "mix", key: str = "doc_id", source: str = "source") -> DataFrame:
    """Add ``shard`` and ``slot``; every shard has each source in proportion.

    Rows are shuffled within their source by a seeded digest of ``key`` and ``tie`` (any
    column that tells rows of one key apart, here a checksum of the row's text). The k-th
    of a source's n rows gets the fractional rank (k - u) / n, with u in (0, 1] drawn from
    the source's name so that small sources spread out. Sorted by that rank, the rows are
    cut into ``shards`` runs whose lengths differ by one at most; ``slot`` counts from 0
    within a shard. Null keys and a null source are values like others; rows that are equal
    in all columns may swap places. An empty table gives no rows. Needs columns ``key``,
    ``source`` and ``tie``.
    """
    spark = docs.sparkSession
    total = docs.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = max(CELLS_PER_PARTITION * partitions, math.ceil(total / ROWS_PER_CELL))
    name = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.col("tie").cast("string"))
    shuffled = docs.withColumn("_digest", F.md5(name.cast("binary")))
    shuffled = shuffled.withColumn("_draw", _unit(F.col("_digest")))
    ranked = _ranked(shuffled, [source], "_draw", ["_digest", key], cells, "_rank")
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_size"))
    ranked = ranked.join(sizes, F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
    named = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(source).cast("string"), F.lit("")))
    u = F.lit(1.0) - _unit(F.md5(named.cast("binary")))
    placed = ranked.withColumn("_fraction", (F.col("_rank") - u) / F.col("_size"))
    order = [source, "_digest", key]
    placed = _ranked(placed, [], "_fraction", order, cells, "_position")
    return (
        placed.withColumn("shard", F.expr(f"CAST((_position - 1) * {shards} DIV {max(total, 1)} AS INT)"))
        .withColumn("slot", F.expr(f"_position - 1 - (shard * {total}L + {shards - 1}) DIV {shards}"))
        .drop("_digest", "_draw", "_rank", "_size", "_fraction", "_position")
    )
