"""Building blocks that keep hot keys, global ranks and broadcasts safe on large tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.hashing import HASH_BITS, keyed_hash
from tallyloom.session import cut_lineage

ROWS_PER_TASK = 1_000_000
NULL_PARTS = 256
FILTER_BITS = 1 << 24


def hot_keys(df: DataFrame, keys, rows_per_task: int = ROWS_PER_TASK, weight: str | None = None) -> DataFrame:
    """Keys that hold more rows than one task should take, with the number of parts to split them into.

    ``weight`` names a column that already holds the rows per key; otherwise rows are counted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = (df.select(*keys, F.col(weight).alias("_rows")) if weight
              else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    return (counts.filter(F.col("_rows") > rows_per_task)
            .select(*keys, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_parts")))


def spread_join(facts: DataFrame, lookup: DataFrame, on, hot: DataFrame, how: str = "inner",
                spread_by=None) -> DataFrame:
    """Join a large table to a lookup, each hot key split over several tasks.

    Rows of ``facts`` with a hot key go to one of its parts by a hash of ``spread_by``; the lookup's
    rows of that key are copied to every part. Rows with a null key never match; they are spread as well, so that a
    left join does not send all of them to one task. The list of hot keys is sent to all tasks, so finding them moves no row of
    ``facts``: it has at most one key per ``rows_per_task`` rows.
    """
    on = [on] if isinstance(on, str) else list(on)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    null = F.lit(False)
    for c in on:
        null = null | F.col(c).isNull()
    spread = [F.col(c) for c in (spread_by or facts.columns)]
    hot = F.broadcast(hot)
    left = facts.join(hot, on, "left").withColumn("_part", F.pmod(
        F.xxhash64(*spread), F.when(null, F.lit(NULL_PARTS)).otherwise(parts)).cast("int")).drop("_parts")
    right = (lookup.filter(~null).join(hot, on, "left")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return left.join(right, [*on, "_part"], how).drop("_part")


def global_rank(df: DataFrame, order, name: str, parts: int | None = None) -> DataFrame:
    """Number the rows 1, 2, 3, ... under ``order`` without putting them into one task.

    Rows are range-partitioned and checkpointed, so the partition of a row is fixed; the start of each
    partition comes from the counts of the partitions before it (one row per partition).
    """
    order = list(order)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_bucket", F.spark_partition_id()))
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (placed.withColumn("_within", within)
            .join(F.broadcast(starts), "_bucket")
            .withColumn(name, (F.col("_start") + F.col("_within")).cast("int"))
            .drop("_bucket", "_start", "_within"))


def lowest_hash_cut(df: DataFrame, group: str, key: str, n: Column, seed: int, bits: int = 16) -> DataFrame:
    """Per group, the (hash, key) of the ``n``-th row in order of keyed hash: columns group, _cut_hash, _cut_key.

    A histogram over the top ``bits`` of the hash finds the bucket of the n-th row; only that bucket,
    about one row in 2^bits, is ranked. Groups must be few (classes), rows may be many.
    """
    hashed = df.select(group, key, keyed_hash(F.col(key), seed).alias("_hash")).withColumn(
        "_bucket", F.shiftright("_hash", HASH_BITS - bits))
    sizes = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    upto = F.sum("_size").over(Window.partitionBy(group).orderBy("_bucket"))
    edge = (sizes.withColumn("_below", upto - F.col("_size")).withColumn("_need", n - F.col("_below"))
            .filter((F.col("_need") >= 1) & (F.col("_need") <= F.col("_size")))
            .select(group, "_bucket", "_need"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_hash", key))
    return (hashed.join(F.broadcast(edge), [group, "_bucket"])  # one row per group
            .withColumn("_rank", rank).filter(F.col("_rank") == F.col("_need"))
            .select(group, F.col("_hash").alias("_cut_hash"), F.col(key).alias("_cut_key")))


def address_filter(df: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(_part, _bits): a Bloom filter of the keys with one hash; at most ``bits`` / 32,768 rows of 4 KB, whatever the input.

    Tasks build their own bitmaps and send those on, not the keys.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return (df.filter(F.col(key).isNotNull()).select(F.bitmap_bucket_number(place).alias("_part"), F.bitmap_bit_position(place).alias("_bit"))
            .groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def with_filter(df: DataFrame, key: str, keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter: all that are, and few others. Nothing but the filter moves."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marked = df.withColumns({"_part": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # The filter has a proven size: FILTER_BITS / 8 bytes at most.
    held = marked.join(F.broadcast(keys), "_part").filter(F.getbit(byte, F.pmod("_bit", F.lit(8)).cast("int")) == 1)
    return held.drop("_part", "_bit", "_bits")


def running_total(df: DataFrame, order, value: str, name: str, parts: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows before each row under ``order``, in range partitions like ``global_rank``."""
    order = list(order)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_bucket", F.spark_partition_id()))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    starts = sums.select("_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))  # one row per partition
    before = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_before", F.coalesce(F.sum(value).over(before), F.lit(0))).join(F.broadcast(starts), "_bucket")
            .withColumn(name, (F.col("_start") + F.col("_before")).cast("long")).drop("_bucket", "_before", "_start"))
