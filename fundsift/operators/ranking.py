"""Row numbers over groups that may be too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundsift.session import materialize


def top_n(
    df: DataFrame, group: list[str | Column], order: list[Column], n: int, name: str | None = None
) -> DataFrame:
    """First ``n`` rows of each group.

    The row-number filter lets Spark cut every group to ``n`` rows before the
    shuffle as well as after it, so a huge group costs its reducer only ``n`` rows
    per map task.
    """
    number = name or "_row"
    window = Window.partitionBy(*group).orderBy(*order)
    kept = df.withColumn(number, F.row_number().over(window)).filter(F.col(number) <= n)
    return kept if name else kept.drop(number)


def rank_within(
    df: DataFrame, group: str, order: list[Column], name: str, partitions: int | None = None
) -> DataFrame:
    """Number all rows of each group in ``order`` without a window per group.

    Few groups hold all rows here (one per investor profile), so a window would run
    in as many tasks. Instead the rows are range-partitioned by (group, order); a
    row's number is its position in its partition plus the rows of its group in
    earlier partitions. The sorted rows are stored first: the partition numbers must
    be the same for counting and for numbering, whatever is recomputed.

    ``order`` should end in a unique column, so that the result is repeatable.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(partitions, F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    # One row per (group, partition): at most groups + partitions rows in all.
    pieces = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first")
    )
    earlier = (
        Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.select(
        group,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        placed.join(F.broadcast(offsets), [group, "_part"])
        .withColumn(name, (F.col("_seq") + F.col("_shift") + 1).cast("int"))
        .drop("_part", "_seq", "_shift")
    )
