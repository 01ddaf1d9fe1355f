"""Expressions for the broker-pair and alert tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk labels with the amount and symmetry each must exceed, strongest first.
RISK_TIERS = (
    ("HIGH_SUSPICION_CIRCULAR_WASH", 5_000_000, 0.80),
    ("MEDIUM_SUSPICION_RECIPROCAL", 1_000_000, 0.60),
)
LOWEST_RISK = "LOW_RISK_MATCH"


def symmetry_ratio(volume_one: Column, volume_two: Column) -> Column:
    """Smaller leg divided by larger leg, unrounded."""
    return F.least(volume_one, volume_two).cast("double") / F.greatest(volume_one, volume_two).cast("double")


def classify_risk(amount: Column, ratio: Column, tiers=RISK_TIERS, otherwise: str = LOWEST_RISK) -> Column:
    """First tier whose two limits are both exceeded."""
    label = F.lit(otherwise)
    for name, min_amount, min_ratio in reversed(tiers):
        label = F.when((amount > F.lit(min_amount)) & (ratio > F.lit(min_ratio)), F.lit(name)).otherwise(label)
    return label


def alert_details(volume: Column, amount: Column) -> Column:
    """Readable one-line reason of an alert."""
    return F.concat(F.lit("Volume: "), volume.cast("string"), F.lit(" Amount: NRs."), amount.cast("string"))


def day_folder(day: Column) -> Column:
    """Date as a year/month/day path."""
    return F.date_format(day, "yyyy/MM/dd")
