"""Alphabetical codes for text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import global_rank


def category_codes(df: DataFrame, cols) -> DataFrame:
    """Distinct values of text columns with codes 0, 1, 2, ... in alphabetical order: (column, value, code).

    All columns are read in one pass and ranked together in range partitions; a column's first rank is taken off.
    """
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])))
    ranked = global_rank(stacked.filter(F.col("value").isNotNull()).distinct(), [F.col("column"), F.col("value")], "_rank")
    first = ranked.groupBy("column").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, "column").select("column", "value", (F.col("_rank") - F.col("_first")).alias("code"))


def label_encode(df: DataFrame, cols, null_text: str | None = "nan") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace text columns by their codes; also return the code table (value column, code) of each column.

    Small code tables are broadcast by their measured size; a large one is joined by value, where Spark splits hot ones.
    """
    cols = list(cols)
    if null_text is not None:
        df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in cols})
    codes = category_codes(df, cols)
    tables, encoded = {}, df
    for c in cols:
        tables[c] = codes.filter(F.col("column") == c).select(F.col("value").alias(c), "code")
        encoded = encoded.join(tables[c], c, "left").withColumn(c, F.col("code")).drop("code")
    return encoded.select(*df.columns), tables
