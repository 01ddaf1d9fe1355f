"""Operators on natural keys: keep-first, insert-if-absent, merge, incremental slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARLIEST_DAY = "0001-01-01"


def dedupe(df: DataFrame, keys, order) -> DataFrame:
    """First row per key under ``order``, which should be total so the survivor is fixed.

    The rank filter is pushed below the shuffle, so each task sends one row per key at most and a
    hot key costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def append_if_absent(new: DataFrame, existing: DataFrame, keys, order) -> DataFrame:
    """Rows of ``new`` to add: first per key, and not present in ``existing``.

    Null key parts never equal each other, so rows with one are all kept.
    """
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    keyed = dedupe(new.filter(~has_null), keys, order)
    return keyed.join(existing.select(*keys), list(keys), "left_anti").unionByName(new.filter(has_null))


def merge_upsert(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """``target`` with matched rows replaced by ``updates`` and the others inserted; nothing is deleted."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return updates.unionByName(kept)


def last_day(target: DataFrame, day: str = "trade_date") -> Column:
    """Latest day of the target as a scalar subquery; null for an empty target."""
    return target.agg(F.max(day).alias("last_day")).scalar()


def incremental_slice(src: DataFrame, target: DataFrame | None, day: str = "trade_date",
                      lookback_days: int = 0) -> DataFrame:
    """Source rows on or after the target's last day, less ``lookback_days``.

    A missing or empty target gives the whole source. Days before the slice are never picked up again.
    """
    if target is None:
        return src
    start = F.date_sub(last_day(target, day), lookback_days) if lookback_days else last_day(target, day)
    return src.filter(F.col(day) >= F.coalesce(start, F.lit(EARLIEST_DAY).cast("date")))
