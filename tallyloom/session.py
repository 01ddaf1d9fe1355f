"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC dates and strict (ANSI) casts."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, else one beside the warehouse's tables in local runs."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(shared)
    return context.getCheckpointDir()  # Spark makes a folder of its own in it


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _cut_with(df: DataFrame, name: str, value: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        return cut_lineage(df.select("*"))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut_placed(df: DataFrame) -> DataFrame:
    """Like :func:`cut_lineage`; later steps know which partition holds which rows, which an adaptive plan does not tell them."""
    return _cut_with(df, "spark.sql.adaptive.enabled", "false")


def to_each(rows: DataFrame, n: int, name: str) -> DataFrame:
    """``n`` partitions with all stored rows each and the partition's number as ``name``: read from the store, so no copy is shuffled.

    For :func:`cut_apart` only. The number is not a literal, so all partitions run the same compiled code.
    """
    return reduce(DataFrame.unionAll, [rows.coalesce(1)] * n).withColumn(name, F.spark_partition_id())


def cut_apart(df: DataFrame) -> DataFrame:
    """Like :func:`cut_lineage`; the members of a union keep partitions of their own, also where each has a single one."""
    return _cut_with(df, "spark.sql.unionOutputPartitioning", "false")


def write_staged(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to a table in the checkpoint folder and read again; ``by`` names columns that get a folder per value.

    Unlike a checkpoint this is a write, so observed counts are complete afterwards, and a filter on ``by`` reads its folder alone.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
