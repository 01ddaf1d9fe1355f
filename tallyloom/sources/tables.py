"""Parquet tables partitioned by day: create, register, replace and merge days."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.gold import daily_broker_summary, stage_trades, wash_trades
from tallyloom.operators.keyed import merge_upsert
from tallyloom.session import cut_lineage
from tallyloom.sources.bronze import read_or_none

BUCKETS = 64


def ensure_table(spark: SparkSession, name: str, contract: T.StructType, partition: str | None = None) -> None:
    """Create the table of a contract if absent. Parquet does not enforce not-null; the quality checks do."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields)
    layout = f" PARTITIONED BY (`{partition}`)" if partition else ""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}")


def register_views(silver: DataFrame, fact: DataFrame | None = None) -> dict[str, DataFrame]:
    """Temp views of the staged trades, the broker matrix and the wash trades, usable from SQL."""
    staged = stage_trades(silver)
    fact = daily_broker_summary(staged) if fact is None else fact
    views = {"stg_floorsheet": staged, "fact_daily_broker_summary": fact,
             "view_wash_trade_detection": wash_trades(fact)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def read_table(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame | None:
    """Table under its contract, or None before its first write."""
    return read_or_none(lambda: spark.read.schema(contract).parquet(path))


def overwrite_days(df: DataFrame, path: str, day: str = "trade_date", sort: str = "symbol") -> None:
    """Replace the days present in ``df``, leave the others: keys gone from a rebuilt day are gone from the table.

    Rows are placed by day and a hash, so a large day is written by several tasks; files are sorted for pruning.
    """
    placed = df.hint("rebalance", day) if day in df.columns else df
    (placed.sortWithinPartitions(day, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(path))


def days_of(table: DataFrame, updates: DataFrame, day: str = "trade_date") -> DataFrame:
    """Rows of ``table`` on the days present in ``updates``; other day folders are pruned at run time."""
    days = updates.select(day).distinct()
    return table.join(days, day, "left_semi").select(*table.columns)


def merge_days(updates: DataFrame, path: str, keys, contract: T.StructType, day: str = "trade_date",
               sort: str = "symbol") -> None:
    """Merge ``updates`` by key into the days they touch; keys of those days not in ``updates`` are kept.

    ``updates`` is read twice and should be materialised. The merged days are written to the checkpoint
    folder first: the path is never replaced while it is read.
    """
    target = read_table(updates.sparkSession, path, contract)
    if target is None:
        overwrite_days(updates, path, day, sort)
        return
    touched = days_of(target.select(*updates.columns), updates, day)
    overwrite_days(cut_lineage(merge_upsert(touched, updates, keys)), path, day, sort)


def create_bucketed(spark: SparkSession, name: str, contract: T.StructType, keys, day: str = "trade_date", buckets: int = BUCKETS) -> None:
    """Create a table with a folder per day, whose files hold one bucket of the keys each, sorted by them."""
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields if f.name != day)
    names = ", ".join(f"`{k}`" for k in keys if k != day)
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({others}, `{day}` {contract[day].dataType.simpleString()}) USING parquet "
              f"PARTITIONED BY (`{day}`) CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS")


def merged_bucketed(updates: DataFrame, name: str, keys, day: str = "trade_date", buckets: int = BUCKETS) -> DataFrame:
    """The days of a bucketed table that ``updates`` touches, with its rows merged by key. Only ``updates`` is shuffled.

    The updates are dealt out as the table's files are, so each task joins one bucket's files with its share of the updates.
    Key columns must not be null. ``updates`` is read twice and should be materialised; its days are few.
    """
    spark = updates.sparkSession
    days = [r[0] for r in updates.select(day).distinct().collect()]
    target = spark.table(name)
    bucketed = [k for k in keys if k != day]
    old = target.filter(F.col(day).isin(days)).select(*[F.col(c).alias(f"_old_{c}") for c in target.columns])
    new = updates.select(*target.columns).withColumn("_new", F.lit(True)).repartition(buckets, *bucketed)
    match = [F.col(f"_old_{k}") == F.col(k) for k in (*bucketed, day)]
    both = old.join(new, match, "full_outer")
    return both.select(*[F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in target.columns])


def merge_bucketed(updates: DataFrame, name: str, keys, day: str = "trade_date", buckets: int = BUCKETS) -> None:
    """Merge ``updates`` by key into the days of a bucketed table that they touch; other days stay as they are.

    The days are replaced when all of them are written, so readers and a failed run see the old ones.
    """
    with by_some_keys(updates.sparkSession):
        merged_bucketed(updates, name, keys, day, buckets).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)


@contextmanager
def by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Joins planned meanwhile may use a layout by some of their keys: files lie by all keys but the day, which has folders."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_rows(df: DataFrame, path: str, day: str) -> None:
    """Add rows to their day folders."""
    df.write.mode("append").partitionBy(day).parquet(path)
