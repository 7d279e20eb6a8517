"""Positions with ids, their prices and their credit ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.functions.columns import digits

# Copies of one row written by one task; more copies are spread over several.
COPIES_PER_TASK = 100_000


def _content_hash(columns: list[str]) -> Column:
    # to_json leaves out nulls and keeps names, so neighbouring columns cannot run together.
    return F.md5(F.to_json(F.struct(*columns)))


def instrument_registry(holdings: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Holdings with an ``instrument_id`` that is unique and the same on every run.

    The id is made of the family, a hash of the row and a number that tells exact
    copies apart. Copies are first counted (so they collapse before the shuffle) and
    then written out again; many copies of one row are written by many tasks.
    """
    columns = holdings.columns
    counted = holdings.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))

    def numbered(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.withColumn("_copy", F.explode(F.sequence(first, last))).select(
            *columns,
            F.concat_ws("_", "blc_type", _content_hash(columns), F.col("_copy")).alias(
                "instrument_id"
            ),
        )

    few = numbered(
        counted.filter(F.col("_n") <= copies_per_task), F.lit(0).cast("long"), F.col("_n") - 1
    )
    blocks = (
        counted.filter(F.col("_n") > copies_per_task)
        .withColumn(
            "_from",
            F.explode(
                F.sequence(
                    F.lit(0).cast("long"), F.col("_n") - 1, F.lit(copies_per_task).cast("long")
                )
            ),
        )
        .repartition("_from", *columns)
    )
    many = numbered(
        blocks, F.col("_from"), F.least(F.col("_from") + copies_per_task, F.col("_n")) - 1
    )
    return few.unionByName(many)


def stored_instrument_registry(holdings: DataFrame) -> DataFrame:
    """The same for holdings read straight from Parquet, without any shuffle.

    File and row position identify a row of a stored table for good, so they serve as
    its number.
    """
    return holdings.select(
        "*",
        F.concat_ws(
            "_",
            "blc_type",
            F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1),
            F.col("_metadata.row_index"),
        ).alias("instrument_id"),
    )


def instrument_prices(registry: DataFrame, latest_period: int) -> DataFrame:
    """Position values; ``is_active`` marks those of the latest period."""
    return registry.select(
        "cnpj",
        "instrument_id",
        "period",
        F.col("VL_MERC_POS_FINAL").cast("double").alias("position_value"),
        F.col("TP_ATIVO").alias("asset_type"),
        F.when(F.col("period") == latest_period, 1).otherwise(0).alias("is_active"),
    )


def instrument_rating(registry: DataFrame) -> DataFrame:
    """Ratings of the rated credit instruments."""
    return registry.filter(
        (F.col("blc_type") == "blc_5") & F.col("GRAU_RISCO").isNotNull()
    ).select(
        "cnpj",
        "instrument_id",
        "period",
        digits("CNPJ_EMISSOR").alias("issuer_cnpj"),
        F.col("GRAU_RISCO").alias("credit_rating"),
        F.col("AG_RISCO").alias("rating_agency"),
    )
