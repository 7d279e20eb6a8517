"""Daily returns of months as they arrive: a stream of closed months with each fund's last quota as state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

NAV = T.StructType(
    [
        T.StructField("cnpj", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("quota_value", T.DoubleType()),
    ]
)
RETURNS = "cnpj long, date date, period int, quota_value double, quota_value_previous double, daily_return double"
_STATE = "date date, quota_value double"


def _of_fund(key: tuple[int], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Returns of the new rows of a fund: one a day at most, so they are few."""
    held = list(parts)
    rows = held[0] if len(held) == 1 else pd.concat(held)
    date, period, quota = (rows[c].to_numpy() for c in ("date", "period", "quota_value"))
    order = np.argsort(date, kind="stable")
    date, period, quota = date[order], period[order], quota[order]
    last_date, last = state.get if state.exists else (None, None)
    if last_date is not None and date[0] <= last_date:
        raise ValueError(f"fund {key[0]}: a row of {date[0]} arrived after {last_date}")
    before = np.append(np.nan if last is None else last, quota[:-1])
    base = np.where(before == 0, np.nan, before)
    with np.errstate(all="ignore"):
        change = (quota - base) / base
    state.update((date[-1], quota[-1]))
    known = np.isfinite(change)
    if known.any():
        found = {"date": date, "period": period, "quota_value": quota, "quota_value_previous": before, "daily_return": change}
        yield pd.DataFrame({"cnpj": key[0], **{name: values[known] for name, values in found.items()}})


def add_arrived(spark: SparkSession, source: str, target: str, checkpoint: str) -> DataFrame:
    """Read what is new below ``source``, append its returns at ``target``, stop, and return the table.

    ``source`` holds daily NAV as Parquet (columns ``NAV``; one row per fund and date, dates not null), and only
    closed months are put there, in any number of files at once. Returns are those that ``primary.daily_returns``
    has for all months together; ranks by latest date are not kept, since later months change them.
    A row that is not later than the fund's last one is an error. State and progress are in ``checkpoint``,
    in the shared folder; a run that breaks is repeated by the next one, without a row lost or doubled.
    """
    new = spark.readStream.schema(NAV).option("recursiveFileLookup", "true").parquet(source)
    made = new.groupBy("cnpj").applyInPandasWithState(_of_fund, RETURNS, _STATE, "append", "NoTimeout")
    run = (
        made.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination()
    return spark.read.schema(RETURNS).parquet(target).filter(F.col("cnpj").isNotNull())
