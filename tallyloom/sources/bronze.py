"""Raw document folders: locate, read and land."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import FLOORSHEET_DOCUMENT, FOREX_DOCUMENT

FEEDS = {"forex": FOREX_DOCUMENT, "floorsheet": FLOORSHEET_DOCUMENT}


def day_path(root: str, feed: str, day: str) -> str:
    """File of one day: ``root/raw/feed/YYYY/MM/DD/feed.json``. A ``*`` part in ``day`` makes a glob."""
    return f"{root}/raw/{feed}/{day.replace('-', '/')}/{feed.rsplit('/', 1)[-1]}.json"


def read_forex(spark: SparkSession, path: str) -> DataFrame:
    """Exchange-rate documents, one per file, under the declared schema."""
    return spark.read.schema(FOREX_DOCUMENT).option("multiLine", True).json(path)


def read_floorsheet(spark: SparkSession, path: str) -> DataFrame:
    """Trade documents, one per file, under the declared schema."""
    return spark.read.schema(FLOORSHEET_DOCUMENT).option("multiLine", True).json(path)


def read_or_none(read) -> DataFrame | None:
    """Result of ``read()``, or None where the path is missing or holds no rows; other errors stay errors."""
    try:
        df = read()
        return None if df.isEmpty() else df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_fallback(payloads: DataFrame, day: Column) -> DataFrame:
    """Trade documents with failed fetches (null ``trades``) turned into documents without trades."""
    trades = FLOORSHEET_DOCUMENT["trades"].dataType
    return payloads.select(
        F.coalesce("status", F.lit("SUCCESS")).alias("status"),
        F.coalesce(F.col("date"), day.cast("string")).alias("date"),
        F.coalesce("trades", F.array().cast(trades)).alias("trades"),
        day.cast("date").alias("dt"))


def land_bronze(df: DataFrame, root: str, feed: str) -> None:
    """Write documents as JSON lines under ``root/raw/feed/dt=...``; the days in ``df`` are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
     .partitionBy("dt").json(f"{root}/raw/{feed}"))


def read_landed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Landed documents with their day column ``dt``; a filter on ``dt`` prunes folders."""
    schema = T.StructType([*FEEDS[feed].fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(schema).json(f"{root}/raw/{feed}")
