"""Database tables over JDBC. Connection settings come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS, CONNECTIONS = 10_000, 16


def jdbc_options(url: str, properties: dict | None = None, **extra) -> dict[str, str]:
    """Reader or writer options with text values only."""
    merged = {"url": url, **(properties or {}), **extra}
    return {k: str(v) for k, v in merged.items() if v is not None}


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None, partition_column: str | None = None,
              lower=None, upper=None, partitions: int | None = None) -> DataFrame:
    """A table or ``(select ...) alias``; filters and columns are pushed to the database.

    With a partition column and its bounds, that many connections read in parallel.
    """
    options = jdbc_options(url, properties, dbtable=table, partitionColumn=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions)
    return spark.read.format("jdbc").options(**options).load()


def read_fact(spark: SparkSession, url: str, table: str, day: str, properties: dict | None = None) -> DataFrame:
    """Six columns of the broker matrix of one day; the day is compared as a typed value."""
    fact = read_jdbc(spark, url, table, properties)
    return fact.filter(F.col("trade_date") == F.lit(day).cast("date")).select(
        "buyer_broker", "seller_broker", "symbol", "total_volume", "total_amount", "trade_count")


def within_bounds(stored: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Rows of ``stored`` whose keys lie between the smallest and the largest of ``new``: literals that a database can filter by."""
    ends = new.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    for k in keys:
        low, high = ends[f"min_{k}"], ends[f"max_{k}"]
        if low is None:
            return stored.limit(0)
        stored = stored.filter(F.col(k).between(F.lit(low), F.lit(high)))
    return stored


def write_jdbc(df: DataFrame, url: str, table: str, keys=None, properties: dict | None = None,
               batch_rows: int = BATCH_ROWS, connections: int = CONNECTIONS) -> None:
    """Append rows, at most ``connections`` at a time. With ``keys``, rows already stored are skipped, so a
    repeated run does not break the primary key. Only stored keys between the smallest and largest new ones are read."""
    if keys:
        stored = within_bounds(read_jdbc(df.sparkSession, url, table, properties).select(*keys), df, keys)
        df = df.join(stored, list(keys), "left_anti")
    options = jdbc_options(url, properties, dbtable=table, batchsize=batch_rows, numPartitions=connections)
    df.write.format("jdbc").mode("append").options(**options).save()
