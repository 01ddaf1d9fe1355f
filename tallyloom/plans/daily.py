"""The daily job: raw documents of one date to clean tables, matrix, checks, scores and alerts.

    python -m tallyloom.plans.daily 2026-01-05 /data/lake
"""

from __future__ import annotations

import datetime
import logging
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import contracts as K
from tallyloom.operators import alerts, gold, isolation, quality, silver
from tallyloom.operators.keyed import EARLIEST_DAY, last_day
from tallyloom.session import cut_lineage, get_session, write_staged
from tallyloom.sources.bronze import day_path, read_floorsheet, read_forex, read_landed
from tallyloom.sources.tables import append_rows, days_of, merge_days, overwrite_days, read_table

log = logging.getLogger(__name__)


def table_paths(root: str) -> dict[str, str]:
    """Folders of the tables the job writes."""
    return {"forex": f"{root}/silver/forex_rates", "trades": f"{root}/silver/trades",
            "fact": f"{root}/gold/daily_broker_summary", "alerts": f"{root}/gold/risk_alerts",
            "rejected": f"{root}/silver/rejected"}


@dataclass(frozen=True)
class Feed:
    """How the documents of one feed become rows of one table."""

    read: Callable[[SparkSession, str], DataFrame]
    typed: Callable[[DataFrame], DataFrame]
    first: Callable[[DataFrame], DataFrame]
    audit: str
    day: str
    sort: str
    contract: T.StructType
    keys: tuple[str, ...]
    rules: dict[str, str]
    table: str


FEEDS = {
    "forex": Feed(read_forex, lambda raw: silver.typed_forex(silver.flatten_forex(raw)), silver.first_rates, "ingested_at",
                  "rate_date", "currency_iso3", K.FOREX_RATES, K.FOREX_KEYS, K.FOREX_RULES, "forex"),
    "floorsheet": Feed(read_floorsheet, lambda raw: silver.typed_trades(silver.flatten_trades(raw)), silver.first_trades, "processed_at",
                       "trade_date", "symbol", K.TRADES, K.TRADE_KEYS, K.TRADE_RULES, "trades"),
}


def _sources(spark: SparkSession, root: str, feed: str, day: str) -> Iterator[DataFrame]:
    """Raw documents of a day: from landed day partitions, then from one file per day; missing paths are passed over."""
    for load in (lambda: read_landed(spark, root, feed).filter(F.col("dt") == F.lit(day).cast("date")).drop("dt"),
                 lambda: FEEDS[feed].read(spark, day_path(root, feed, day))):
        try:
            yield load()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise


def _keep_rejected(rejected: DataFrame, path: str, feed: str, day: str) -> None:
    """Store a run's rejected rows as JSON with their reasons; a repeated run replaces its own."""
    rows = rejected.select(F.lit(feed).alias("feed"), F.lit(day).alias("run_day"), "reasons",
                           F.to_json(F.struct(*[c for c in rejected.columns if c != "reasons"])).alias("row"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feed", "run_day").parquet(path))


def take_in(documents: DataFrame, feed: str, root: str, run: str, compete: bool = False) -> dict:
    """Merge documents into the clean table of their feed. Returns documents, rows, rejected, merged, and the days merged.

    The documents are read once: one write puts good and rejected rows into folders of their own and counts both on the way.
    Rows that miss a required column or break a rule go to the rejected table of ``run``, before one row per key is chosen among
    the good ones, so a bad version of a key never displaces a good one. With ``compete`` stored and new rows of a key are
    ranked together, so the cut into runs does not matter; otherwise the new row wins.
    """
    spark, plan, paths = documents.sparkSession, FEEDS[feed], table_paths(root)
    read, typed, kept = Observation(), Observation(), Observation()
    one = F.lit(1)
    marked = quality.with_reasons(plan.typed(documents.observe(read, F.count(one).alias("documents"))), plan.rules, K.required_columns(plan.contract))
    marked = marked.withColumn("rejected", F.col("reasons") != "").observe(typed, F.count(one).alias("rows"), F.count_if("rejected").alias("rejected"))
    staged = write_staged(marked, "rejected")
    counts = {"documents": 0, "rows": 0, "rejected": 0} | read.get | typed.get | {"merged": 0, "days": []}
    if counts["rejected"]:
        log.warning("%s: %s rows of %s are rejected, see %s", run, counts["rejected"], feed, paths["rejected"])
        _keep_rejected(staged.filter("rejected").drop("rejected"), paths["rejected"], feed, run)
    if counts["rows"] == counts["rejected"]:
        return counts
    good = plan.first(staged.filter(~F.col("rejected")).drop("rejected", "reasons"))
    fresh = write_staged(silver.with_audit(good, plan.audit).observe(kept, F.count(one).alias("merged")))
    counts |= kept.get
    target = paths[plan.table]
    stored = read_table(spark, target, plan.contract) if compete else None
    if stored is not None:
        both = fresh.unionByName(days_of(stored.select(*fresh.columns), fresh, plan.day))
        overwrite_days(cut_lineage(plan.first(both)), target, plan.day, plan.sort)
    elif compete:
        overwrite_days(fresh, target, plan.day, plan.sort)
    else:
        merge_days(fresh, target, plan.keys, plan.contract, plan.day, plan.sort)
    counts["days"] = [r[0] for r in fresh.select(plan.day).distinct().orderBy(plan.day).collect()]
    return counts


def clean_day(spark: SparkSession, day: str, root: str) -> dict[str, int]:
    """Merge the run's documents into the clean tables; a feed without data is skipped with a warning.

    A document may hold rows of other days: they are merged by key, so nothing stored before is lost. Returns rows merged.
    """
    written = {}
    for feed in FEEDS:
        for documents in _sources(spark, root, feed, day):
            counts = take_in(documents, feed, root, day)
            if counts["documents"]:
                written[feed] = counts["merged"]
                if feed == "floorsheet" and counts["days"]:
                    written["days"] = counts["days"]
                break
        else:
            log.warning("no %s documents for %s, skipped", feed, day)
    return written


def summarise(spark: SparkSession, root: str, lookback_days: int = 0, days=()) -> None:
    """Bring the broker matrix up to date from its last day on, and for ``days``, which may be earlier; merge by key."""
    paths = table_paths(root)
    trades = read_table(spark, paths["trades"], K.TRADES)
    if trades is None:
        return
    target = read_table(spark, paths["fact"], K.BROKER_SUMMARY)
    # Only the days to be reprocessed are read, checked and merged; older days stay untouched.
    ready = gold.stage_trades(trades)
    staged = gold.incremental_slice(ready, target, lookback_days=lookback_days)
    if days and target is not None:
        late = ready.filter(F.col("trade_date").isin(list(days)) & (F.col("trade_date") < F.coalesce(
            F.date_sub(last_day(target), lookback_days), F.lit(EARLIEST_DAY).cast("date"))))
        staged = staged.unionByName(late)
    quality.require_clean(staged, "staged trades", ["contract_id", "symbol"])
    fresh = cut_lineage(silver.with_audit(gold.daily_broker_summary(staged), "created_at"))
    quality.require_clean(fresh, "broker matrix", ["total_volume", "total_amount"])
    merge_days(fresh, paths["fact"], K.SUMMARY_KEYS, K.BROKER_SUMMARY)


def raise_alerts(spark: SparkSession, day: str, root: str) -> int:
    """Score a day and add alerts that are not there yet. Returns how many were added."""
    paths = table_paths(root)
    fact = read_table(spark, paths["fact"], K.BROKER_SUMMARY)
    today = None if fact is None else fact.filter(F.col("trade_date") == F.lit(day).cast("date")).drop("created_at")
    if today is None or today.isEmpty():
        log.warning("no broker matrix for %s, scoring skipped", day)
        return 0
    found = isolation.outliers(isolation.isolation_scores(today))
    stored = read_table(spark, paths["alerts"], K.RISK_ALERTS)
    if stored is not None:
        stored = stored.filter(F.col("alert_date") == F.lit(day).cast("date"))
    new = cut_lineage(silver.with_audit(alerts.build_alerts(found, stored), "created_at"))
    new, unfit = quality.quarantine(new, K.ALERT_RULES)
    if not unfit.isEmpty():
        log.warning("alerts of %s are rejected, see %s", day, paths["rejected"])
        _keep_rejected(unfit, paths["rejected"], "alerts", day)
    added = new.count()
    if added:
        append_rows(new, paths["alerts"], "alert_date")
    return added


def run_day(spark: SparkSession, day: str | None, root: str, lookback_days: int = 0) -> dict[str, int]:
    """All steps of one date in order: clean, summarise, check, score, alert. Running a date again changes nothing."""
    if not day:
        raise ValueError("a run date (YYYY-MM-DD) is needed")
    datetime.date.fromisoformat(day)
    counts = clean_day(spark, day, root)
    days = counts.pop("days", [])
    summarise(spark, root, lookback_days, days)
    counts["alerts"] = sum(raise_alerts(spark, d, root) for d in sorted({day, *map(str, days)}))
    return counts


def main(arguments: list[str]) -> int:
    if len(arguments) != 2:
        print("usage: python -m tallyloom.plans.daily YYYY-MM-DD ROOT", file=sys.stderr)
        return 1
    spark = get_session("tallyloom-daily")
    try:
        log.info("rows: %s", run_day(spark, *arguments))
        return 0
    except Exception:
        log.exception("run of %s failed", arguments[0])
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main(sys.argv[1:]))
