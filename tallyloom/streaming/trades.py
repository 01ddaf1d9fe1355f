"""Landed documents as a stream: every micro-batch goes through the job's own steps into the same tables.

The batch operators are used unchanged; the stream only decides which documents are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom import contracts as K
from tallyloom.operators import gold, silver
from tallyloom.plans.daily import raise_alerts, table_paths, take_in
from tallyloom.session import cut_lineage
from tallyloom.sources.bronze import FEEDS
from tallyloom.sources.tables import overwrite_days, read_table


def read_documents(spark: SparkSession, root: str, feed: str = "floorsheet", files_per_batch: int = 1000) -> DataFrame:
    """Stream of landed documents, at most ``files_per_batch`` new files at a time."""
    schema = T.StructType([*FEEDS[feed].fields, T.StructField("dt", T.DateType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(f"{root}/raw/{feed}")


def merge_batch(documents: DataFrame, root: str, feed: str = "floorsheet", run: str = "stream", alerts: bool = True) -> dict:
    """Merge one batch of documents; for trades also the matrix and the alerts of the days touched.

    Rows that miss a required column or break a rule are stored with their reasons under ``run``. Stored and new rows of a day
    compete under one order, so neither the cut into batches nor a repeated batch changes the tables.
    """
    spark, paths = documents.sparkSession, table_paths(root)
    counts = take_in(documents.drop("dt"), feed, root, run, compete=True)
    if feed == "floorsheet" and counts["days"]:
        trades = read_table(spark, paths["trades"], K.TRADES).filter(F.col("trade_date").isin(counts["days"]))
        fact = silver.with_audit(gold.daily_broker_summary(gold.stage_trades(trades)), "created_at")
        overwrite_days(cut_lineage(fact), paths["fact"])
        if alerts:
            counts["alerts"] = sum(raise_alerts(spark, str(d), root) for d in counts["days"])
    return counts


def run_available(spark: SparkSession, root: str, progress: str, files_per_batch: int = 1000, feed: str = "floorsheet",
                  alerts: bool = True) -> StreamingQuery:
    """Process all documents not seen before and stop; ``progress`` keeps track of them, one folder per feed."""
    return (read_documents(spark, root, feed, files_per_batch).writeStream
            .foreachBatch(lambda batch, number: merge_batch(batch, root, feed, f"stream-{number}", alerts))
            .option("checkpointLocation", progress).trigger(availableNow=True).start())
