"""Counts and profiles over whole tables, one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, ordered: bool = True) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), col) if ordered else counts


def class_sizes(df: DataFrame, label: str, classes) -> DataFrame:
    """One row: the number of rows of each listed class and of the smallest one."""
    counts = df.agg(*[F.count_if(F.col(label) == F.lit(c)).alias(str(c)) for c in classes])
    return counts.withColumn("smallest", F.least(*[F.col(f"`{c}`") for c in classes]))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, as rows (column, nulls)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.inline(rows))


def profile(df: DataFrame) -> DataFrame:
    """Type and non-null count per column, as rows (column, type, non_null, rows)."""
    kinds = dict(df.dtypes)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"),
                              F.col(c).alias("non_null"), F.col("_rows").alias("rows")) for c in df.columns])
    return counts.select(F.inline(rows))


def distinct_per_column(df: DataFrame, cols) -> dict[str, int]:
    """Approximate number of distinct values of several columns in one pass."""
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    return row.asDict()
