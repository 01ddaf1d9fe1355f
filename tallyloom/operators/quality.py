"""Declared checks: null, range and key violations, and the split into good and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _violated(rule: str) -> Column:
    return F.coalesce(~F.expr(rule), F.lit(False))


def check_not_null(df: DataFrame, cols) -> DataFrame:
    """Nulls in columns that must have none: rows (column, violations)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in cols])))


def check_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that break each rule: rows (rule, violations). A null result passes."""
    counts = df.agg(*[F.count_if(_violated(rule)).alias(name) for name, rule in rules.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules])))


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def with_reasons(df: DataFrame, rules: dict[str, str], required=()) -> DataFrame:
    """Add the names of all broken checks, joined by commas; empty for good rows."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c}_missing")) for c in required]
    reasons += [F.when(_violated(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reasons", F.array_join(F.array(*reasons), ","))


def quarantine(df: DataFrame, rules: dict[str, str], required=()) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reasons."""
    marked = with_reasons(df, rules, required)
    return marked.filter(F.col("reasons") == "").drop("reasons"), marked.filter(F.col("reasons") != "")


def require_clean(df: DataFrame, what: str, cols=(), rules: dict[str, str] | None = None) -> None:
    """Fail where a check finds violations (a step between two stages of a daily run)."""
    checks = [F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in cols]
    checks += [F.count_if(_violated(rule)).alias(name) for name, rule in (rules or {}).items()]
    found = {k: v for k, v in df.agg(*checks).first().asDict().items() if v}
    if found:
        raise ValueError(f"{what}: " + ", ".join(f"{k} {v}" for k, v in found.items()))
