"""Folders of monthly delimited files: listing, header vintages, typed scans.

A month is one file ``YYYYMM.csv``, or a folder of that name (or ``period=YYYYMM``)
with part files, as Spark writes them.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundsift.functions.columns import as_date
from fundsift.sources.schemas import for_header, with_old_names
from fundsift.sources.workbook import read_sheet

ENCODING = "ISO-8859-1"
SEPARATOR = ";"
_PERIOD = r"(?:^|[/=])(\d{6})(?:\.csv)?(?:/part-[^/]*)?$"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Table of the files below ``path`` (column ``path``); their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path")


def months(spark: SparkSession, path: str) -> list[str]:
    """Months below ``path``: files, or folders with part files. One entry per month."""
    month = F.regexp_replace("path", r"/part-[^/]*$", "")
    found = listing(spark, path).select(month.alias("month")).distinct()
    return sorted(row.month for row in found.collect())


def file_period(path: str) -> int | None:
    found = re.search(_PERIOD, path)
    return int(found.group(1)) if found else None


def path_period(path: Column) -> Column:
    return F.try_to_number(F.regexp_extract(path, _PERIOD, 1), F.lit("999999")).cast("int")


def latest_period(spark: SparkSession, path: str) -> DataFrame:
    """Latest month among the file names, as one row; names that are no month do not count."""
    return listing(spark, path).agg(F.max(path_period(F.col("path"))).alias("max_period"))


def max_period(spark: SparkSession, path: str) -> int:
    return latest_period(spark, path).first()[0]


def recent_months(found: list[str], num_periods: int | None) -> list[str]:
    """The latest ``num_periods`` months (all when None)."""
    if not num_periods:
        return found
    periods = sorted({p for p in map(file_period, found) if p is not None}, reverse=True)
    wanted = set(periods[:num_periods])
    return [f for f in found if file_period(f) in wanted]


def _decoded(encoding: str) -> Column:
    # The text source keeps the bytes of a line as they are.
    return F.decode(F.col("value").cast("binary"), encoding)


def vintages(spark: SparkSession, found: list[str], encoding: str = ENCODING) -> dict[str, list[str]]:
    """Months grouped by their header line.

    Spark reads a delimited file by position, so files whose headers differ must not
    share a scan. Part files of one month share a header; the typed scan fails otherwise.
    """

    def header(month: str) -> str | None:
        row = spark.read.text(month).select(_decoded(encoding).alias("line")).head()
        return row.line if row else None

    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(header, found))
    groups: dict[str, list[str]] = {}
    for line, month in zip(headers, found):
        if line:
            groups.setdefault(line, []).append(month)
    return groups


def header_columns(header: str) -> list[str]:
    return [name.strip().strip('"') for name in header.split(SEPARATOR)]


def unify_names(df: DataFrame) -> DataFrame:
    """Rename old column names where the new ones are missing."""
    return df.withColumnsRenamed(with_old_names(df.columns))


def drift_union(tables: list[DataFrame]) -> DataFrame:
    """Union of tables of different vintages: new names, missing columns null."""
    if not tables:
        raise ValueError("no tables to unite: no files with a header were found")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), map(unify_names, tables)
    )


def add_missing(df: DataFrame, declared: T.StructType) -> DataFrame:
    absent = {
        f.name: F.lit(None).cast(f.dataType) for f in declared.fields if f.name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def scan_partitioned_csv(
    spark: SparkSession,
    path: str,
    declared: T.StructType,
    num_periods: int | None = None,
    encoding: str = ENCODING,
) -> DataFrame:
    """All files of a folder as one typed table, plus ``period`` and ``file_name``.

    A value of the wrong type in a column that is read fails the read, and so does a
    line with too few or too many fields, or a file whose header differs from that of its
    month; ``columnPruning`` is off because a pruned parse would not see wrong lines.
    """
    files = recent_months(months(spark, path), num_periods)
    tables = []
    for header, members in vintages(spark, files, encoding).items():
        table = (
            spark.read.schema(for_header(header_columns(header), declared))
            .option("header", "true")
            .option("sep", SEPARATOR)
            .option("encoding", encoding)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .option("columnPruning", "false")
            .option("enforceSchema", "false")
            .option("recursiveFileLookup", "true")
            .csv(members)
        )
        tables.append(
            table.select(
                "*",
                path_period(F.col("_metadata.file_path")).alias("period"),
                F.col("_metadata.file_name").alias("file_name"),
            )
        )
    return add_missing(drift_union(tables), declared)


def raw_lines(
    spark: SparkSession, path: str, num_periods: int | None = None, encoding: str = ENCODING
) -> dict[str, DataFrame]:
    """Per header line, the text lines of its files.

    Columns: ``file``; ``block`` (where the piece read by one task starts in the
    file); ``seq`` (increasing by one per line within a block); ``is_header``; ``line``.
    Files are split as usual, so one large file is read by many tasks.
    """
    files = recent_months(months(spark, path), num_periods)
    return {
        header: spark.read.text(members).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            (
                (F.col("_metadata.file_block_start") == 0) & (_decoded(encoding) == F.lit(header))
            ).alias("is_header"),
            _decoded(encoding).alias("line"),
        )
        for header, members in vintages(spark, files, encoding).items()
    }


def parse_lines(lines: DataFrame, header: str, declared: T.StructType) -> DataFrame:
    """Lines of one vintage as a typed table, plus ``period`` and ``file_name``."""
    schema = for_header(header_columns(header), declared)
    data = ~F.col("is_header") & F.rlike("line", F.lit(r"\S"))
    row = F.from_csv(
        # Spark may test a parsed field before it drops the other lines.
        F.when(data, F.col("line")),
        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
        {"sep": SEPARATOR, "escape": '"', "mode": "FAILFAST"},
    )
    return (
        lines.filter(data)
        .select(
            row.alias("row"),
            path_period(F.col("file")).alias("period"),
            F.element_at(F.split("file", "/"), -1).alias("file_name"),
        )
        .select("row.*", "period", "file_name")
    )


def registry_source(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """Fund registry from a workbook, or from an exported sheet: Parquet, or delimited text with a header."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".xlsx"):
        return read_sheet(spark, path, declared)
    reader = spark.read.option("header", "true").option("sep", SEPARATOR).option("escape", '"')
    header = reader.csv(path).columns
    return add_missing(
        reader.schema(for_header(header, declared))
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .csv(path),
        declared,
    )


def recent_periods(df: DataFrame, num_periods: int | None, column: str = "period") -> DataFrame:
    """Rows of the latest ``num_periods`` periods of a table (all when None).

    The wanted periods become literals, which prune partitions of a stored table.
    """
    if not num_periods:
        return df
    newest = df.select(column).distinct().orderBy(F.desc(column)).limit(num_periods).collect()
    return df.filter(F.col(column).isin([row[0] for row in newest]))


def max_ref_date(quotas: DataFrame, latest_period: int, date: str = "DT_COMPTC") -> DataFrame:
    """Latest date within the latest period: one row, one column ``max_ref_date``."""
    return quotas.filter(F.col("period") == latest_period).agg(
        F.max(as_date(quotas, date)).alias("max_ref_date")
    )
