"""Records of delimited files whose quoted fields hold line breaks, from splits of the files.

A line starts inside a quoted field if the quotes before it in its file are odd in number. Lines
with an odd number of quotes are counted per block (the part of a file that one task reads), the
counts are added up over the blocks of each file, and only inside blocks that have such
lines are they counted line by line. So a huge file is cut into records by many tasks at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundsift.session import materialize
from fundsift.sources.files import ENCODING, add_missing, drift_union, parse_lines, raw_lines

#: Most lines of one record. A stray quote would otherwise make one record of the rest of its file.
MAX_LINES = 10_000

_LINE = ["file", "block", "seq", "is_header", "line"]


def odd_quotes(line: Column) -> Column:
    """Whether a line opens or closes a quoted field that goes over its end; doubled quotes are even."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def _blocks(lines: DataFrame) -> DataFrame:
    """(file, block, turns, before): lines with odd quotes in the block, and in the file ahead of it."""
    counted = lines.groupBy("file", "block").agg(F.count_if(odd_quotes(F.col("line"))).alias("turns"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("before", F.coalesce(F.sum("turns").over(ahead), F.lit(0)))


def records(lines: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    r"""Lines joined to records, in the columns of ``raw_lines``; ``line`` may hold ``\n``.

    ``block`` and ``seq`` are those of the record's first line. Lines outside quotes are records as they
    are, and only blocks with lines of odd quotes are shuffled for counting. A record may begin and end
    in different blocks. One of more than ``max_lines`` lines, or one that its file does not
    end, is an error that names the file.
    """
    blocks = materialize(_blocks(lines))
    odd = odd_quotes(F.col("line"))
    placed = lines.join(blocks, ["file", "block"])
    in_order = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.count_if(odd).over(in_order), F.lit(0))
    turning = placed.filter("turns > 0").withColumn("before", F.col("before") + inside)
    counted = placed.filter("turns = 0").unionByName(turning)
    # A record over several lines has one number: half the odd lines before any of its lines.
    part = odd | (F.col("before") % 2 == 1)
    single = counted.filter(~part).select(_LINE)
    parts = counted.filter(part).select(*_LINE, F.floor(F.col("before") / 2).alias("record"))
    parts = materialize(parts)
    _check(parts, blocks, max_lines)
    ordered = F.array_sort(F.collect_list(F.struct("block", "seq", "is_header", "line")))
    joined = parts.groupBy("file", "record").agg(ordered.alias("parts"))
    first = F.col("parts")[0]
    whole = joined.select(
        "file",
        first["block"].alias("block"),
        first["seq"].alias("seq"),
        first["is_header"].alias("is_header"),
        F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("line"),
    )
    return single.unionByName(whole)


def _check(parts: DataFrame, blocks: DataFrame, max_lines: int) -> None:
    sizes = parts.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    longest = sizes.filter(F.col("n") > max_lines).select("file").first()
    if longest:
        raise ValueError(f"a record of more than {max_lines} lines in {longest.file}: a stray quote?")
    open_ended = blocks.groupBy("file").agg(F.sum("turns").alias("n")).filter("n % 2 = 1").select("file").first()
    if open_ended:
        raise ValueError(f"a quoted field is never closed in {open_ended.file}")


def scan_quoted_csv(
    spark: SparkSession,
    path: str,
    declared: T.StructType,
    num_periods: int | None = None,
    encoding: str = ENCODING,
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """As ``scan_partitioned_csv``, for files whose quoted fields hold line breaks.

    Files stay splittable. Line breaks of every kind come out as ``\\n``; blank lines between records are skipped.
    """
    tables = [
        parse_lines(records(lines, max_lines), header, declared)
        for header, lines in raw_lines(spark, path, num_periods, encoding).items()
    ]
    return add_missing(drift_union(tables), declared)
