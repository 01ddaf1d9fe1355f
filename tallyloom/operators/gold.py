"""Staged trades, the daily broker matrix and reciprocal (wash) trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import SUMMARY_KEYS
from tallyloom.functions.market import RISK_TIERS, classify_risk, symmetry_ratio
from tallyloom.operators.keyed import incremental_slice, merge_upsert

MIN_MATCHED_AMOUNT = 500_000
STAGED_COLUMNS = ("contract_id", "trade_date", "symbol", "buyer_broker", "seller_broker",
                  "quantity", "rate", "total_amount", "processed_at")


def stage_trades(silver: DataFrame) -> DataFrame:
    """Dated trades with positive quantity and amount, symbols upper-cased and trimmed."""
    kept = silver.filter(F.col("trade_date").isNotNull() & (F.col("quantity") > 0) & (F.col("total_amount") > 0))
    return kept.withColumn("symbol", F.upper(F.trim("symbol"))).select(
        *[c for c in STAGED_COLUMNS if c in silver.columns])


def daily_broker_summary(staged: DataFrame) -> DataFrame:
    """Volume, amount and trade count per day, buyer, seller and symbol."""
    return staged.groupBy(*SUMMARY_KEYS).agg(
        F.sum("quantity").cast("bigint").alias("total_volume"),
        F.sum("total_amount").cast("decimal(18,2)").alias("total_amount"),
        F.count("contract_id").cast("int").alias("trade_count"),
    )


def refresh_fact(staged: DataFrame, target: DataFrame | None, lookback_days: int = 0) -> DataFrame:
    """The matrix after reprocessing from the target's last day on; a first run builds it all."""
    fresh = daily_broker_summary(incremental_slice(staged, target, lookback_days=lookback_days))
    return fresh if target is None else merge_upsert(target.select(*fresh.columns), fresh, SUMMARY_KEYS)


def _matched(volume_one, volume_two, amount_one, amount_two, count_one, count_two) -> list:
    return [
        volume_one.alias("volume_a_to_b"),
        volume_two.alias("volume_b_to_a"),
        (volume_one + volume_two).alias("aggregate_matched_volume"),
        (amount_one + amount_two).cast("decimal(19,2)").alias("aggregate_matched_amount"),
        (count_one + count_two).alias("total_reciprocal_trades"),
        symmetry_ratio(volume_one, volume_two).alias("volume_symmetry_ratio"),
    ]


def reciprocal_pairs(fact: DataFrame) -> DataFrame:
    """Broker pairs that traded a symbol in both directions on one day, each pair once (self-join form)."""
    measures = ("total_volume", "total_amount", "trade_count")
    there = fact.filter(F.col("buyer_broker") < F.col("seller_broker")).select(
        "trade_date", "symbol", F.col("buyer_broker").alias("broker_a"), F.col("seller_broker").alias("broker_b"),
        *[F.col(m).alias(f"{m}_1") for m in measures])
    back = fact.filter(F.col("buyer_broker") > F.col("seller_broker")).select(
        "trade_date", "symbol", F.col("seller_broker").alias("broker_a"), F.col("buyer_broker").alias("broker_b"),
        *[F.col(m).alias(f"{m}_2") for m in measures])
    pairs = there.join(back, ["trade_date", "symbol", "broker_a", "broker_b"])
    return pairs.select("trade_date", "symbol", "broker_a", "broker_b",
                        *_matched(*[F.col(f"{m}_{i}") for m in measures for i in (1, 2)]))


def reciprocal_pairs_agg(fact: DataFrame) -> DataFrame:
    """Same rows as :func:`reciprocal_pairs` from one aggregate: the fact is read and shuffled once."""
    forward = F.col("buyer_broker") < F.col("seller_broker")
    measures = ("total_volume", "total_amount", "trade_count")
    legs = []
    for m in measures:
        legs.append(F.max(F.when(forward, F.col(m))).alias(f"{m}_1"))
        legs.append(F.max(F.when(~forward, F.col(m))).alias(f"{m}_2"))
    pairs = (fact.filter(F.col("buyer_broker") != F.col("seller_broker"))
             .groupBy("trade_date", "symbol",
                      F.least("buyer_broker", "seller_broker").alias("broker_a"),
                      F.greatest("buyer_broker", "seller_broker").alias("broker_b"))
             .agg(*legs)
             .filter(F.col("total_volume_1").isNotNull() & F.col("total_volume_2").isNotNull()))
    return pairs.select("trade_date", "symbol", "broker_a", "broker_b",
                        *_matched(*[F.col(f"{m}_{i}") for m in measures for i in (1, 2)]))


def wash_trades_of(pairs: DataFrame, min_amount=MIN_MATCHED_AMOUNT, tiers=RISK_TIERS) -> DataFrame:
    """Threshold, risk label (on the unrounded ratio) and rounding of matched pairs."""
    return pairs.filter(F.col("aggregate_matched_amount") >= F.lit(min_amount)).select(
        "trade_date", "symbol", "broker_a", "broker_b",
        "aggregate_matched_volume", "aggregate_matched_amount", "total_reciprocal_trades",
        F.round("volume_symmetry_ratio", 4).alias("volume_symmetry_ratio"),
        classify_risk(F.col("aggregate_matched_amount"), F.col("volume_symmetry_ratio"), tiers)
        .alias("risk_classification"))


def wash_trades(fact: DataFrame, min_amount=MIN_MATCHED_AMOUNT, tiers=RISK_TIERS, ordered: bool = True) -> DataFrame:
    """Suspicious reciprocal trades, largest amount first."""
    found = wash_trades_of(reciprocal_pairs_agg(fact), min_amount, tiers)
    return found.orderBy(F.desc("aggregate_matched_amount")) if ordered else found


def for_day(fact: DataFrame, day: str, columns=("buyer_broker", "seller_broker", "symbol",
                                                "total_volume", "total_amount", "trade_count")) -> DataFrame:
    """One day's rows of the matrix; a partition filter where the table is partitioned by day."""
    return fact.filter(F.col("trade_date") == F.lit(day).cast("date")).select(*columns)
