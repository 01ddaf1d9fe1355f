"""Alert rows from outliers, and the list of open alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import ALERT_KEYS
from tallyloom.functions.market import alert_details
from tallyloom.operators.keyed import append_if_absent

# Fixed values of an alert made from an outlier.
SPIKE = "SUSPICIOUS_VOLUME_SPIKE"
SPIKE_SCORE = "0.95"
ALERT_ORDER = ("total_amount", "seller_broker")


def alert_candidates(outliers: DataFrame) -> DataFrame:
    """One candidate per outlier row, with the columns that decide which one of a key is kept."""
    return outliers.select(
        F.col("trade_date").alias("alert_date"),
        F.lit(SPIKE).alias("alert_type"),
        F.col("buyer_broker").alias("broker_id"),
        "symbol",
        F.lit(SPIKE_SCORE).cast("decimal(5,4)").alias("risk_score"),
        alert_details(F.col("total_volume"), F.col("total_amount")).alias("details"),
        F.lit(False).alias("is_reviewed"),
        F.xxhash64("trade_date", F.lit(SPIKE), "buyer_broker", "symbol").alias("alert_id"),
        "total_amount", "seller_broker")


def build_alerts(outliers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Alerts to add: of several outliers of one key the one with the largest amount, then smallest seller.

    Keys already in ``existing`` are skipped, so a repeated run adds nothing.
    """
    candidates = alert_candidates(outliers)
    order = [F.desc("total_amount"), F.asc("seller_broker")]
    if existing is None:
        existing = candidates.select(*ALERT_KEYS).limit(0)
    return append_if_absent(candidates, existing, ALERT_KEYS, order).drop(*ALERT_ORDER)


def open_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts not reviewed yet, newest first."""
    return alerts.filter(~F.col("is_reviewed")).orderBy(
        F.desc("alert_date"), "alert_type", "broker_id", "symbol")
