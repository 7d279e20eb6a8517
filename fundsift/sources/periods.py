"""Tables that grow and change by period: a run replaces its periods, or nothing.

Rows are stored as ``data/<period>/<version>``, and a manifest that names the valid version of each period
is written last. Readers take the newest complete manifest, so a run that breaks leaves the table
as it was; the next one overwrites what it left behind. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.session import file_names, remove

_MANIFEST = "period int, version long, n_rows long"


def _manifests(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in file_names(spark, f"{path}/manifest") if name.isdigit())


def _complete(spark: SparkSession, path: str) -> int | None:
    """Number of the newest manifest whose writing ended."""
    for number in reversed(_manifests(spark, path)):
        if "_SUCCESS" in file_names(spark, f"{path}/manifest/{number}"):
            return number
    return None


def manifest(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """Version and number of rows of each valid period, by period; nothing but the manifest is read."""
    number = _complete(spark, path)
    if number is None:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/{number}").collect()
    return {r.period: (r.version, r.n_rows) for r in sorted(rows)}


def stored_periods(spark: SparkSession, path: str) -> list[int]:
    return list(manifest(spark, path))


def write_data(df: DataFrame, path: str, version: int, period: str = "period") -> dict[int, int]:
    """Store rows as a version of their periods, which no reader sees yet; rows by period."""
    spark = df.sparkSession
    rows = df.withColumn("version", F.lit(version)).withColumn("period", F.col(period).cast("int"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("period", "version").parquet(f"{path}/data")
    found = spark.read.parquet(f"{path}/data").filter(F.col("version") == version)
    return {r.period: r.n for r in found.groupBy("period").agg(F.count(F.lit(1)).alias("n")).collect()}


def next_version(spark: SparkSession, path: str) -> int:
    """One after the newest manifest, complete or not."""
    return max(_manifests(spark, path), default=0) + 1


def write_periods(df: DataFrame, path: str, periods: Iterable[int] | None = None, period: str = "period") -> DataFrame:
    """Replace periods of the table at ``path`` by the rows of ``df`` and return the table.

    The periods are those that ``df`` has, and ``periods`` if given: of these, one without rows goes.
    Rows of another period than the given ones, or without a period, are an error. All other periods stay
    as they are and are not read.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    version, valid = next_version(spark, path), manifest(spark, path)
    wanted = None if periods is None else set(periods)
    found = write_data(df, path, version, period)
    if None in found or wanted is not None and not wanted.issuperset(found):
        raise ValueError(f"rows outside the periods to be written: {sorted(map(str, set(found) - (wanted or set())))}")
    valid = {p: v for p, v in valid.items() if p not in (wanted or ())}
    valid |= {p: (version, n) for p, n in found.items()}
    if next_version(spark, path) != version:
        raise RuntimeError(f"another run has written to {path} meanwhile")
    rows = [(p, *v) for p, v in sorted(valid.items())]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/{version}")
    return read_periods(spark, path) if valid else df.limit(0)


def read_periods(spark: SparkSession, path: str, num_periods: int | None = None, merge_schema: bool = False) -> DataFrame:
    """The table, or its latest ``num_periods`` periods; folders of other periods and versions are not even listed."""
    path = path.rstrip("/")
    valid = manifest(spark, path)
    wanted = sorted(valid, reverse=True)[: num_periods or None]
    if not wanted:
        raise ValueError(f"no periods are stored at {path}")
    folders = [f"{path}/data/period={p}/version={valid[p][0]}" for p in wanted]
    reader = spark.read.option("basePath", f"{path}/data").option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(*folders).drop("version")


def expire(spark: SparkSession, path: str) -> int:
    """Delete what the newest complete manifest does not name; returns how many folders went."""
    path = path.rstrip("/")
    newest, valid, gone = _complete(spark, path), manifest(spark, path), []
    if newest is None:
        return 0
    for folder in file_names(spark, f"{path}/data"):
        if not folder.startswith("period="):
            continue
        kept = valid.get(int(folder.split("=")[1]), (None,))[0]
        versions = [name for name in file_names(spark, f"{path}/data/{folder}") if name.startswith("version=")]
        gone += [f"{path}/data/{folder}/{name}" for name in versions if name != f"version={kept}"]
    gone += [f"{path}/manifest/{n}" for n in _manifests(spark, path) if n < newest]
    for folder in gone:
        remove(spark, folder)
    return len(gone)
