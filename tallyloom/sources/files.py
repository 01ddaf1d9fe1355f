"""CSV and labelled text sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with a header under a declared schema. Set ``multi_line`` off where no field holds a line break: such
    files are split over many tasks."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("escape", '"').csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_labelled(spark: SparkSession, path: str, text_col: str, label_col: str, fmt: str = "parquet") -> DataFrame:
    """A labelled set as columns ``text`` and ``label``, whatever they are called in the file."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
