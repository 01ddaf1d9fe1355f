"""Frame-level helpers: columns, recoding, concatenation, heads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.hashing import keyed_hash

REFERENCE_YEAR = 2026


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop columns; absent ones are ignored."""
    return df.drop(*cols)


def require_or(df: DataFrame, col: str) -> Column:
    """The column, or a clear error where the frame lacks it."""
    if col not in df.columns:
        raise ValueError(f"column {col} is missing; columns are {', '.join(df.columns)}")
    return F.col(col)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the text columns."""
    return [name for name, kind in df.dtypes if kind == "string"]


def recode(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """Replace listed values, keep the others."""
    return df.replace(mapping, subset=[col])


def with_label(df: DataFrame, value, name: str = "label") -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


def filter_label(df: DataFrame, value, name: str = "label") -> DataFrame:
    """Rows of one class."""
    return df.filter(F.col(name) == F.lit(value))


def years_since(df: DataFrame, col: str, name: str = "outlet_years", base: int = REFERENCE_YEAR) -> DataFrame:
    """Age in years from a founding year."""
    return df.withColumn(name, F.lit(base) - F.col(col))


def ordinal(c: Column, codes: dict) -> Column:
    """Number for each listed text, null for others."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.try_element_at(table, c)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; absent columns become null, repeats stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unnest(df: DataFrame, keys, array: Column, name: str, pos: str | None = None) -> DataFrame:
    """One row per non-null element: (*keys, [pos,] name).

    The outer generator keeps the optimiser from adding a ``size(array) > 0`` filter below, which would
    compute a costly array a second time.
    """
    rows = (df.select(*keys, F.posexplode_outer(array).alias(pos, name)) if pos
            else df.select(*keys, F.explode_outer(array).alias(name)))
    return rows.filter(F.col(name).isNotNull())


def head(df: DataFrame, order, n: int = 5) -> DataFrame:
    """First ``n`` rows under ``order``."""
    return df.orderBy(*order).limit(n)


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in an order fixed by the key and the seed."""
    return df.orderBy(keyed_hash(F.col(key), seed), key)
