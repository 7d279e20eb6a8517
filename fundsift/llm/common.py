"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.session import drop_scratch, scratch_path

#: Characters that separate words, as a regular-expression class.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


#: Bytes of an Arrow batch at most. A batch is held by the JVM and by a Python worker, of each running task.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on, tables go to the session's Python workers in batches of ``BATCH_BYTES``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Where each staged table is.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Later plans start from the files, which no lost executor takes away. A grouped table
    that is joined back to its rows is staged as well: read from files, both sides of the
    join are shuffled for it, and adaptive execution can split a hot key.
    """
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[found] = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in tables:
        drop_scratch(df.sparkSession, _PATHS.pop(df))


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a job go as soon as it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def whole(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text, F.lit(""))
