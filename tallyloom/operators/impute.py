"""Filling nulls by mean, most frequent value or constant.

All fill values come from one stacked aggregate: each row gives one entry per column to fill, entries are counted and added up
by column and value before the shuffle, and what is left, a row per distinct value, is reduced to one row of fill values. That
row is a scalar subquery of the same query, so the input is read once for the values, whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_values(df: DataFrame, means=(), modes=()) -> DataFrame:
    """One row with a column per filled column: the mean of ``means``, the most frequent value of ``modes``, the smallest on ties."""
    means, modes = list(means), list(modes)
    names = [*means, *modes]

    def entry(at: int) -> Column:
        kinds = [F.lit(None).cast(df.schema[c].dataType) if i + len(means) != at else F.col(c) for i, c in enumerate(modes)]
        number = F.col(names[at]).cast("double") if at < len(means) else F.lit(None).cast("double")
        held = [v.alias(f"_v{i}") for i, v in enumerate(kinds)]
        return F.struct(F.lit(at).alias("_at"), F.col(names[at]).isNotNull().alias("_full"), number.alias("_number"), *held)

    values = [f"_v{i}" for i in range(len(modes))]
    stacked = df.select(F.inline(F.array(*[entry(i) for i in range(len(names))]))).filter("_full")
    counted = stacked.groupBy("_at", *values).agg(F.count(F.lit(1)).alias("_n"), F.sum("_number").alias("_sum"))

    def filled(at: int) -> Column:
        here = F.col("_at") == at
        if at < len(means):
            return F.try_divide(F.sum(F.when(here, F.col("_sum"))), F.sum(F.when(here, F.col("_n"))))
        value = F.col(values[at - len(means)])
        return F.min(F.when(here, F.struct((-F.col("_n")).alias("n"), value.alias("v"))))["v"]

    return counted.agg(*[filled(i).alias(c) for i, c in enumerate(names)])


def impute(df: DataFrame, means=(), modes=(), constants: dict | None = None) -> DataFrame:
    """Nulls become the mean, the most frequent value or a constant; a column without any value stays null."""
    names = [*means, *modes]
    if names:
        fill = F.struct(*[F.col(c) for c in names])
        row = fill_values(df, means, modes).select(fill.alias("fill")).scalar()
        df = df.withColumns({c: F.coalesce(F.col(c), row[c]) for c in names})
    return df.fillna(constants) if constants else df


def impute_mean(df: DataFrame, col: str) -> DataFrame:
    """Nulls become the mean of the other rows; an all-null column stays null."""
    return impute(df, means=[col])


def impute_mode(df: DataFrame, col: str) -> DataFrame:
    """Nulls become the most frequent value, the smallest one on ties."""
    return impute(df, modes=[col])


def impute_const(df: DataFrame, col: str, value) -> DataFrame:
    """Nulls become ``value``."""
    return impute(df, constants={col: value})
