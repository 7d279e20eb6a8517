"""Keeping or dropping the rows of a table by a set of keys."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_keys(
    df: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi"
) -> DataFrame:
    """``df`` with (``left_semi``) or without (``left_anti``) the rows whose key is in ``keys``.

    One plain join: adaptive execution broadcasts the keys where their measured size
    allows it, and splits the rows of a hot key where it does not. A null key matches
    nothing, so such rows take no part in the join.
    """
    wanted = keys.select(*columns)
    if how != "left_anti":
        return df.join(wanted, columns, how)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(known).join(wanted, columns, how).unionByName(df.filter(~known))


def keep_keys(df: DataFrame, keys: DataFrame, column: str = "cnpj") -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``keys``."""
    return match_keys(df, keys, [column])


#: Most ranges of keys that a scan gets as its filter.
RANGES = 64


def key_ranges(keys: DataFrame, column: str, parts: int = RANGES) -> list[tuple[int, int]]:
    """At most ``parts`` intervals that hold all keys, whole numbers, with the wide gaps between them left out."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    width = (high - low) // parts + 1
    cell = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    found = keys.filter(F.col(column).isNotNull()).groupBy(cell.alias("cell")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    joined: list[tuple[int, int]] = []
    for r in sorted(found.collect()):
        if joined and r.low <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], r.high)
        else:
            joined.append((r.low, r.high))
    return joined


def keep_stored_keys(df: DataFrame, keys: DataFrame, column: str, parts: int = RANGES) -> DataFrame:
    """As ``keep_keys`` for whole numbers, when ``df`` is a stored table whose files are sorted by ``column``.

    The scan gets the ranges of the keys as a filter, by which it skips row groups and pages outside of
    them before the join sees a row. ``keys`` is read three times, so pass a stored table.
    """
    ranges = key_ranges(keys, column, parts)
    inside = [F.col(column).between(low, high) for low, high in ranges]
    return keep_keys(df.filter(reduce(or_, inside) if inside else F.lit(False)), keys, column)
