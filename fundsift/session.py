"""Spark session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "fundsift",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on; extra settings go in ``conf``.

    The number of shuffle partitions is left to the cluster unless given: adaptive
    execution merges small partitions and splits skewed join partitions from there.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Do not look up the call site of every Column operation while plans are built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose driver and executors are one machine, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fundsift-"))
    return context.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder in any file system that Spark reads; none if it is not there."""
    files, target = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, target = _file_system(spark, path)
    return files.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there.

    It is removed when this process ends.
    """
    path = f"{shared_dir(spark)}/fundsift/{name}-{uuid.uuid4().hex}"
    _SCRATCH[path] = spark
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written below ``path``, a scratch path, before this process ends."""
    remove(spark, path)
    _SCRATCH.pop(path, None)


@atexit.register
def remove_scratch() -> None:
    """Delete what this process wrote below ``scratch_path``, as far as it can be reached."""
    while _SCRATCH:
        path, spark = _SCRATCH.popitem()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            conf = spark._jvm.org.apache.hadoop.conf.Configuration()
            target.getFileSystem(conf).delete(target, True)
        except (Py4JError, OSError):  # Spark has gone already
            return


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back from there.

    For tables that are small beside the facts and read several times. The copy
    outlives any executor, later plans start from it, and each reads only its columns.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
