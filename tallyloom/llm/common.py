"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage, ensure_checkpoint_dir

#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to a compressed table in the shared checkpoint folder and read again; row order may change.

    ``by`` names columns that get a folder per value, so that a filter on them reads no other rows.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(c: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_count(c: str | Column) -> Column:
    return F.regexp_count(text_of(c), F.lit(WORD)).cast("long")


def own(*names: str) -> list[str]:
    """Working column names that an input column is unlikely to bear."""
    return [f"__{n}" for n in names]


def empty_array(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def running_sum(values: Column) -> Column:
    """Inclusive running sums of an array of long, by blocks so that the work stays near linear."""
    starts = F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.slice(values, at, F.lit(BLOCK)))
    nothing = F.struct(F.lit(0).cast("long").alias("sum"), empty_array("bigint").alias("seen"))
    inner = F.transform(blocks, lambda block: F.aggregate(
        block, nothing, lambda acc, x: F.struct((acc["sum"] + x).alias("sum"),
                                                F.concat(acc["seen"], F.array(acc["sum"] + x)).alias("seen"))))
    start = F.struct(F.lit(0).cast("long").alias("sum"), empty_array("array<bigint>").alias("seen"))
    whole = F.aggregate(inner, start, lambda acc, b: F.struct(
        (acc["sum"] + b["sum"]).alias("sum"),
        F.concat(acc["seen"], F.array(F.transform(b["seen"], lambda v: v + acc["sum"]))).alias("seen")))
    return F.when(F.size(values) > 0, F.flatten(whole["seen"])).otherwise(empty_array("bigint"))


def ranked(df: DataFrame, order: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... under ``order`` (long), in range partitions and without one task seeing all.

    The sorted rows are checkpointed with the place each has in its partition; the rows of the partitions before it
    (one count per partition) are added. Rows equal in all of ``order`` are numbered in any order among themselves.
    """
    number, at, before = own("number", "at", "before")
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = cut_lineage(spread.sortWithinPartitions(*order).withColumn(number, F.monotonically_increasing_id()))
    placed = placed.withColumn(at, F.shiftright(number, 33))
    sizes = placed.groupBy(at).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(at, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).cast("long").alias(before))
    return (placed.join(F.broadcast(starts), at)  # one row per range partition
            .withColumn(name, F.col(before) + F.col(number).bitwiseAND(F.lit((1 << 33) - 1)))
            .drop(number, at, before))
