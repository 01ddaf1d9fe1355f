"""Daily job, landed files, tables, CSV and the stream."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import contracts as K
from tallyloom.plans import daily
from tallyloom.plans import fixtures as fx
from tallyloom.sources import bronze, files, jdbc, tables
from tallyloom.streaming import trades as stream

DAYS = ("1998-06-15", "1998-06-16", "1998-06-17")


def land(spark, small, root, days):
    docs = fx.floorsheet_documents(spark, small).filter(F.col("date").substr(1, 4) == "1998")
    # A few dense days out of a year of trades.
    shifted = docs.withColumn("dt", F.element_at(F.array(*[F.lit(d) for d in DAYS]), (F.dayofyear(F.col("date").cast("date")) % 3 + 1)))
    docs = shifted.withColumn("date", F.col("dt")).withColumn("dt", F.col("dt").cast("date")).filter(F.col("date").isin(list(days)))
    bronze.land_bronze(docs, root, "floorsheet")


def fact_rows(spark, root):
    return tables.read_table(spark, daily.table_paths(root)["fact"], K.BROKER_SUMMARY).drop("created_at")


def test_run_day_twice(spark, small, tmp_path):
    root = str(tmp_path)
    land(spark, small, root, DAYS)
    for day in DAYS[:2]:
        counts = daily.run_day(spark, day, root)
        assert counts["floorsheet"] > 0 and counts["alerts"] >= 1
    before = {tuple(r) for r in fact_rows(spark, root).collect()}
    again = daily.run_day(spark, DAYS[1], root)
    assert again["alerts"] == 0
    assert {tuple(r) for r in fact_rows(spark, root).collect()} == before
    assert daily.run_day(spark, "2001-01-01", root) == {"alerts": 0}
    with pytest.raises(ValueError):
        daily.run_day(spark, None, root)


def test_stream_equals_batch(spark, small, tmp_path):
    batch, live = str(tmp_path / "batch"), str(tmp_path / "live")
    land(spark, small, batch, DAYS)
    for day in DAYS:
        daily.run_day(spark, day, batch)
    for days in (DAYS[:2], DAYS[2:]):
        land(spark, small, live, days)
        stream.run_available(spark, live, str(tmp_path / "progress"), files_per_batch=2).awaitTermination()
    one, two = fact_rows(spark, batch), fact_rows(spark, live).select(*fact_rows(spark, batch).columns)
    assert one.count() > 0
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def _table(spark, root, name, contract, drop):
    found = tables.read_table(spark, daily.table_paths(root)[name], contract)
    return sorted(tuple(r) for r in found.drop(*drop).select(*sorted(set(contract.names) - set(drop))).collect())


@pytest.mark.parametrize("files_per_batch", [1, 50])
def test_stream_treats_bad_rows_as_the_job_does(spark, tmp_path, files_per_batch):
    rows = [[("c1", "ABC", "1", "2", "5", "10", "100.50", "x"), (None, "ABC", "1", "2", "5", "10", "7", "x")],
            [("c1", "ABC", "1", "2", "5", "10", "-5.00", "x"), ("zero", "ABC", "1", "2", "0", "10", "100", "x")],
            [("c1", "ABC", "1", "2", "5", "10", "100.60", "x"), ("c2", "ABC", "2", "1", "5", "10", "n/a", "x"), ("c3", "XYZ", "2", "1", "9", "10", "90", "x")]]
    batch, live = str(tmp_path / "batch"), str(tmp_path / "live")
    for i, part in enumerate(rows):
        doc = spark.createDataFrame([("SUCCESS", "2026-01-05", part)], K.FLOORSHEET_DOCUMENT).withColumn("dt", F.lit("2026-01-05").cast("date"))
        for root in (batch, live):
            (doc.coalesce(1).write.mode("append").option("ignoreNullFields", False).partitionBy("dt").json(f"{root}/raw/floorsheet"))
        if i < 2:
            stream.run_available(spark, live, str(tmp_path / "progress"), files_per_batch).awaitTermination()
    stream.run_available(spark, live, str(tmp_path / "progress"), files_per_batch).awaitTermination()
    daily.run_day(spark, "2026-01-05", batch)
    for name, contract, drop in (("trades", K.TRADES, ["processed_at"]), ("fact", K.BROKER_SUMMARY, ["created_at"])):
        assert _table(spark, live, name, contract, drop) == _table(spark, batch, name, contract, drop)
    assert [r[0] for r in tables.read_table(spark, daily.table_paths(live)["trades"], K.TRADES).filter("contract_id = 'c1'").select("total_amount").collect()] == [Decimal("100.50")]
    reasons = [sorted((r["feed"], r["reasons"], r["row"]) for r in spark.read.parquet(daily.table_paths(root)["rejected"]).collect()) for root in (batch, live)]
    assert reasons[0] == reasons[1] and [r[1] for r in reasons[0]] == ["amount_not_negative", "contract_id_missing", "quantity_positive", "total_amount_missing"]


def test_forex_stream_and_trade_alerts(spark, small, tmp_path):
    batch, live = str(tmp_path / "batch"), str(tmp_path / "live")
    documents = fx.forex_documents(spark, small).limit(40).withColumn("dt", F.lit("1998-06-15").cast("date"))
    for root in (batch, live):
        bronze.land_bronze(documents, root, "forex")
        land(spark, small, root, DAYS[:1])
    alerts = daily.run_day(spark, DAYS[0], batch)["alerts"]
    for feed in ("forex", "floorsheet"):
        stream.run_available(spark, live, str(tmp_path / feed), feed=feed).awaitTermination()
    assert alerts > 0 and _table(spark, live, "alerts", K.RISK_ALERTS, ["created_at"]) == _table(spark, batch, "alerts", K.RISK_ALERTS, ["created_at"])
    rates = _table(spark, live, "forex", K.FOREX_RATES, ["ingested_at"])
    assert rates and rates == _table(spark, batch, "forex", K.FOREX_RATES, ["ingested_at"])


def test_intake_reads_documents_once_and_counts_on_the_way(spark, small, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    documents = fx.floorsheet_documents(spark, small).limit(300)
    n = documents.count()
    counts = daily.take_in(documents.mapInArrow(seen, documents.schema), "floorsheet", str(tmp_path), "run")
    stored = tables.read_table(spark, daily.table_paths(str(tmp_path))["trades"], K.TRADES)
    assert reads.value == counts["documents"] == n and stored.count() == counts["merged"] > 0
    assert counts["rejected"] == spark.read.parquet(daily.table_paths(str(tmp_path))["rejected"]).count() > 0
    assert [r[0] for r in stored.select("trade_date").distinct().orderBy("trade_date").collect()] == counts["days"]


def test_checkpoint_folder_is_the_same_at_every_call(spark):
    from tallyloom.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_fallback_document(spark, tmp_path):
    failed = spark.createDataFrame([(None, None, None)], bronze.FLOORSHEET_DOCUMENT)
    bronze.land_bronze(bronze.with_fallback(failed, F.lit("2026-01-05")), str(tmp_path), "floorsheet")
    back = bronze.read_landed(spark, str(tmp_path), "floorsheet").collect()
    assert len(back) == 1 and back[0]["trades"] == [] and back[0]["date"] == "2026-01-05"


def test_partition_pruning(spark, small, tmp_path):
    tables.overwrite_days(fx.fact(spark, small), str(tmp_path / "fact"))
    df = tables.read_table(spark, str(tmp_path / "fact"), K.BROKER_SUMMARY)
    from tallyloom.operators.gold import for_day
    plan = for_day(df, "1998-06-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan


def test_bucketed_merge_shuffles_the_updates_only(spark, small):
    from tallyloom.operators.keyed import merge_upsert
    contract = T.StructType([f for f in K.BROKER_SUMMARY.fields if f.name != "created_at"])
    fact = fx.fact(spark, small).select(*contract.names)
    stored = fact.filter("trade_date < '1995-01-01'").checkpoint()
    changed = (fact.filter("trade_date > '1994-06-01' AND trade_date < '1995-02-01'").withColumn("total_volume", F.col("total_volume") + 1)).checkpoint()
    tables.create_bucketed(spark, "bucketed_fact", contract, K.SUMMARY_KEYS, buckets=8)
    tables.create_bucketed(spark, "bucketed_fact", contract, K.SUMMARY_KEYS, buckets=8)
    for updates in (stored, changed, changed):
        tables.merge_bucketed(updates, "bucketed_fact", K.SUMMARY_KEYS, buckets=8)
    want, got = merge_upsert(stored, changed, K.SUMMARY_KEYS), spark.table("bucketed_fact").select(*contract.names)
    assert got.count() == want.count() > stored.count() and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    with tables.by_some_keys(spark):
        plan = tables.merged_bucketed(changed, "bucketed_fact", K.SUMMARY_KEYS, buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_csv_round_trip(spark, tmp_path):
    rows = [("u", "s", 'a "quoted", title', "two\nlines", "2026-01-05", "Real")]
    df = spark.createDataFrame(rows, K.NEWS)
    files.write_csv(df, str(tmp_path / "csv"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "csv"), K.NEWS).collect()] == rows


def test_create_table(spark):
    tables.ensure_table(spark, "gold_alerts", K.RISK_ALERTS, "alert_date")
    tables.ensure_table(spark, "gold_alerts", K.RISK_ALERTS, "alert_date")
    assert set(spark.table("gold_alerts").columns) == set(K.RISK_ALERTS.names)


def test_jdbc_options():
    made = jdbc.jdbc_options("jdbc:x", {"user": "u"}, dbtable="t", numPartitions=4, lowerBound=None)
    assert made == {"url": "jdbc:x", "user": "u", "dbtable": "t", "numPartitions": "4"}


def test_stored_keys_are_read_within_bounds(spark, tmp_path):
    spark.range(1000).selectExpr("id", "CAST(id % 10 AS STRING) AS k", "date_add(DATE '2026-01-01', CAST(id % 100 AS INT)) AS day").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    new = stored.filter("id IN (205, 350, 299)").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS STRING) AS k, CAST(NULL AS DATE) AS day"))
    found = jdbc.within_bounds(stored, new, ["id", "day"])
    assert {r["id"] for r in found.collect()} == {i for i in range(205, 351) if 5 <= i % 100 <= 99}
    assert "PushedFilters: [IsNotNull(id), IsNotNull(day), GreaterThanOrEqual(id,205), LessThanOrEqual(id,350)" in found._jdf.queryExecution().executedPlan().toString()
    assert jdbc.within_bounds(stored, new.limit(0), ["id"]).count() == 0


def land_trades(spark, root, day, trades, dated=None):
    """One document landed on ``day`` whose trades are (contract, quantity); ``dated`` is the date it states."""
    rows = [(c, "ABC", "1", "2", str(q), "10", "100.5", "11:00") for c, q in trades]
    doc = spark.createDataFrame([("SUCCESS", dated or day, rows)], K.FLOORSHEET_DOCUMENT)
    bronze.land_bronze(doc.withColumn("dt", F.lit(day).cast("date")), root, "floorsheet")


def stored_trades(spark, root):
    table = tables.read_table(spark, daily.table_paths(root)["trades"], K.TRADES)
    return {(r["contract_id"], str(r["trade_date"])) for r in table.collect()}


def test_late_document_keeps_stored_trades(spark, tmp_path):
    root = str(tmp_path)
    land_trades(spark, root, "2026-01-07", [("a", 5), ("b", 6)])
    daily.run_day(spark, "2026-01-07", root)
    land_trades(spark, root, "2026-01-08", [("late", 7)], dated="2026-01-07")
    daily.run_day(spark, "2026-01-08", root)
    assert stored_trades(spark, root) == {(c, "2026-01-07") for c in ("a", "b", "late")}
    assert [r["trade_count"] for r in fact_rows(spark, root).collect()] == [3]


def test_late_day_reaches_matrix(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2026-01-05", "2026-01-07", "2026-01-06"):
        land_trades(spark, root, day, [(f"c{day}", 5)])
        daily.run_day(spark, day, root)
    before = sorted(map(tuple, fact_rows(spark, root).collect()))
    assert [str(r[0]) for r in fact_rows(spark, root).select("trade_date").orderBy("trade_date").collect()] == ["2026-01-05", "2026-01-06", "2026-01-07"]
    daily.run_day(spark, "2026-01-06", root)
    assert sorted(map(tuple, fact_rows(spark, root).collect())) == before


def test_rejected_rows(spark, tmp_path):
    root = str(tmp_path)
    good = ("ok", "ABC", "1", "2", "5", "10", "100", "11:00")
    bad = [("no_symbol", None, "1", "2", "5", "10", "100", "x"), ("no_amount", "ABC", "1", "2", "5", "10", "n/a", "x"), ("below", "ABC", "1", "2", "5", "-1", "100", "x")]
    doc = spark.createDataFrame([("SUCCESS", "2026-01-05", [good, *bad])], K.FLOORSHEET_DOCUMENT)
    bronze.land_bronze(doc.withColumn("dt", F.lit("2026-01-05").cast("date")), root, "floorsheet")
    for _ in range(2):
        daily.run_day(spark, "2026-01-05", root)
        assert stored_trades(spark, root) == {("ok", "2026-01-05")}
        reasons = sorted(r["reasons"] for r in spark.read.parquet(daily.table_paths(root)["rejected"]).collect())
        assert reasons == ["rate_not_negative", "symbol_missing", "total_amount_missing"]


def test_rows_are_rejected_before_one_per_key_is_kept(spark, tmp_path):
    root = str(tmp_path)
    rows = [("pair", "ABC", "1", "2", "5", "10", "-100", "x"), ("pair", "ABC", "1", "2", "5", "10", "100", "x"),
            (None, "ABC", "1", "2", "5", "10", "100", "x"), ("zero", "ABC", "1", "2", "0", "10", "100", "x"), ("none", "ABC", "1", "2", None, "10", "100", "x")]
    doc = spark.createDataFrame([("SUCCESS", "2026-01-05", rows), ("SUCCESS", "2026-01-05", [])], K.FLOORSHEET_DOCUMENT)
    bronze.land_bronze(doc.withColumn("dt", F.lit("2026-01-05").cast("date")), root, "floorsheet")
    daily.run_day(spark, "2026-01-05", root)
    stored = tables.read_table(spark, daily.table_paths(root)["trades"], K.TRADES).collect()
    assert [(r["contract_id"], int(r["total_amount"])) for r in stored] == [("pair", 100)]
    reasons = sorted(r["reasons"] for r in spark.read.parquet(daily.table_paths(root)["rejected"]).collect())
    assert reasons == ["amount_not_negative", "contract_id_missing", "quantity_missing", "quantity_positive"]


def test_links_as_a_parser_sees_them(spark):
    from tallyloom.functions.html import page_hrefs
    page = """<a data-href="x" href="y">1</a><A class=b HREF='q&amp;r'>2</A><a href=bare>3</a><a data-href="no">4</a><abbr href="z">5</abbr><a title="t" href = "a b">6</a>"""
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(page_hrefs(F.col("html"))).first()[0] == ["y", "q&r", "bare", "a b"]


@pytest.mark.parametrize("n", [300, 512, 600, 25_600])
def test_every_tree_gets_its_sample(spark, n):
    from tallyloom.operators.isolation import _sampled
    rows = spark.range(n).select(F.lit(1).alias("day"), F.xxhash64("id").alias("_id"), F.lit(n).alias("_n"), F.col("id").cast("double").alias("v"))
    rows = rows.withColumn("_draw", F.shiftrightunsigned(F.xxhash64("_id", F.lit("draw")), 32))
    sizes = {r["_tree"]: r["count"] for r in _sampled(rows, "day", 100, 256).groupBy("_tree").count().collect()}
    assert sizes == {t: 256 for t in range(100)}


def test_many_values_are_encoded(spark):
    from tallyloom.operators import encode
    encoded, codes = encode.label_encode(spark.range(120_000).select(F.col("id").cast("string").alias("v")), ["v"])
    assert encoded.agg(F.max("v"), F.countDistinct("v")).first() == (119_999, 120_000)
