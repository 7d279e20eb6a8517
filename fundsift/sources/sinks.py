"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fundsift.sources.files import SEPARATOR


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = False, sort_by: list[str] | None = None
) -> DataFrame:
    """Store a table as Parquet and return it as read back.

    Files are sorted by ``sort_by``, so that scans with a filter on these columns skip parts of them.

    ``rebalance`` adds a shuffle that merges small and splits large output files of
    a partition; leave it off where the input already arrives by partition.
    """
    if rebalance:
        df = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    if sort_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return read_table(df.sparkSession, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, by: str, sort: list[str], buckets: int) -> DataFrame:
    """Store a table in ``buckets`` files by hash of ``by``, each sorted, and return it as read back.

    Windows, groups and joins over ``by`` then start from the files without an exchange. Choose the
    number of buckets for the largest table that is to be joined this way; a bucket is one task.
    """
    writer = df.repartition(buckets, by).write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, by).sortBy(*sort).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, schema: T.StructType, by: str, sort: list[str], buckets: int
) -> DataFrame:
    """A table stored by ``write_bucketed`` in another session, under a name that this one does not have."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) "
        f"SORTED BY ({', '.join(f'`{c}`' for c in sort)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def write_report(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Store a report as ``;``-separated text with a header, nulls as empty fields."""
    writer = (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("sep", SEPARATOR)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
