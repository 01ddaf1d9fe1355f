"""Raw documents, keys, pairs, alerts and quality on small literal rows."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom import contracts as K
from tallyloom.functions.casting import to_day, to_dec, to_int, to_long
from tallyloom.operators import alerts, gold, isolation, keyed, quality, silver
from tallyloom.sources import bronze

FACT = ("trade_date string, buyer_broker int, seller_broker int, symbol string, total_volume long, "
        "total_amount decimal(18,2), trade_count int")


def fact(spark, rows):
    made = [(d, b, s, y, v, Decimal(str(a)), n) for d, b, s, y, v, a, n in rows]
    return spark.createDataFrame(made, FACT).withColumn("trade_date", F.col("trade_date").cast("date"))


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_lenient_casts(spark):
    df = spark.createDataFrame([("1,200",), ("12.7",), (" 12 ",), ("abc",), (None,), ("1e3",), ("99999999999",)], "t string")
    got = df.select(to_int(F.col("t")), to_long(F.col("t")), to_dec(F.col("t"), 12, 2)).collect()
    assert [r[0] for r in got] == [None, 12, 12, None, None, None, None]
    assert [r[1] for r in got] == [None, 12, 12, None, None, None, 99999999999]
    assert got[1][2] == Decimal("12.70") and got[3][2] is None
    days = spark.createDataFrame([("2026-13-01",), ("2026-01-05",), ("x",)], "t string").select(to_day(F.col("t"))).collect()
    assert [str(r[0]) for r in days] == ["None", "2026-01-05", "None"]


def trade(**over):
    base = {"contract_id": "c1", "symbol": " abc ", "buyer_broker": "7", "seller_broker": "9", "quantity": "100",
            "rate": "250.50", "amount": "25050", "trade_time": "11:03:22"}
    return {**base, **over}


def test_floorsheet_files(spark, tmp_path):
    docs = {"2026-01-05": [trade(), trade(), trade(contract_id="c2", quantity="1,200"), trade(contract_id=None)],
            "2026-01-06": [trade(amount="1"), trade(contract_id="c3", quantity="12.7")], "2026-01-07": []}
    for day, trades in docs.items():
        path = bronze.day_path(str(tmp_path), "floorsheet", day)
        folder = tmp_path / "raw" / "floorsheet" / day.replace("-", "/")
        folder.mkdir(parents=True)
        with open(path, "w") as f:
            json.dump({"status": "SUCCESS", "date": day, "trades": trades}, f, indent=1)
    raw = bronze.read_floorsheet(spark, bronze.day_path(str(tmp_path), "floorsheet", "2026-01-*"))
    got = rows_of(silver.clean_trades(silver.flatten_trades(raw)), "contract_id", F.col("trade_date").cast("string"), "symbol", "quantity")
    assert got == [("c1", "2026-01-05", "ABC", 100), ("c1", "2026-01-06", "ABC", 100), ("c3", "2026-01-06", "ABC", 12)]
    assert bronze.read_or_none(lambda: bronze.read_floorsheet(spark, str(tmp_path / "none.json"))) is None


def test_forex_edges(spark, tmp_path):
    doc = {"status": {"code": 200, "message": "OK"}, "data": {"payload": [
        {"date": "2026-01-05", "rates": [
            {"currency": {"iso3": "usd", "name": "Dollar", "unit": 1}, "buy": "143.10", "sell": "143.70"},
            {"currency": {"iso3": None, "name": "Unknown", "unit": 1}, "buy": "x", "sell": "1"}]},
        {"date": "2026-01-06", "rates": []}]}}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    raw = bronze.read_forex(spark, str(tmp_path / "f.json"))
    assert silver.flatten_forex(raw).count() == 3
    rates = silver.clean_forex(silver.flatten_forex(raw))
    assert rows_of(rates, "currency_iso3", "buying_rate") == [("USD", Decimal("143.1000"))]
    empty = raw.select("status", F.struct(F.array().cast(raw.schema["data"].dataType["payload"].dataType).alias("payload")).alias("data"))
    assert silver.clean_forex(silver.flatten_forex(empty)).count() == 0


def test_pairs_and_tiers(spark):
    d = "2026-01-05"
    df = fact(spark, [
        (d, 1, 2, "A", 90, 400000, 1), (d, 2, 1, "A", 100, 600000, 1),              # exactly 1,000,000 at 0.9: low
        (d, 1, 2, "B", 60, 500000.01, 1), (d, 2, 1, "B", 100, 500000, 1),           # just above, ratio 0.60: low
        (d, 1, 2, "C", 61, 500000.01, 1), (d, 2, 1, "C", 100, 500000, 1),           # ratio 0.61: medium
        (d, 1, 2, "D", 80, 2500000.01, 1), (d, 2, 1, "D", 100, 2500000, 1),         # ratio 0.80: medium
        (d, 1, 2, "E", 81, 2500000.01, 1), (d, 2, 1, "E", 100, 2500000, 1),         # ratio 0.81: high
        (d, 1, 2, "F", 1, 250000, 1), (d, 2, 1, "F", 1, 250000, 1),                 # exactly 500,000: kept
        (d, 1, 2, "G", 1, 249999.99, 1), (d, 2, 1, "G", 1, 250000, 1),              # below: dropped
        (d, 7, 7, "H", 1, 9000000, 1), (d, 3, 4, "I", 1, 9000000, 1),               # self trade, one side only
        (d, 5, 6, "J", 1, 9000000, 1), ("2026-01-06", 6, 5, "J", 1, 9000000, 1)])   # different days
    found = {r["symbol"]: r["risk_classification"].split("_")[0] for r in gold.wash_trades(df).collect()}
    assert found == {"A": "LOW", "B": "LOW", "C": "MEDIUM", "D": "MEDIUM", "E": "HIGH", "F": "LOW"}
    one, two = gold.reciprocal_pairs(df), gold.reciprocal_pairs_agg(df)
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    swapped = df.select("trade_date", F.col("seller_broker").alias("buyer_broker"), F.col("buyer_broker").alias("seller_broker"),
                        "symbol", "total_volume", "total_amount", "trade_count")
    again = gold.wash_trades(swapped)
    assert again.exceptAll(gold.wash_trades(df)).count() == 0


def test_merge_append_slice(spark):
    target = fact(spark, [("2026-01-05", 1, 2, "A", 1, 1, 1), ("2026-01-06", 1, 2, "A", 2, 2, 1)])
    updates = fact(spark, [("2026-01-06", 1, 2, "A", 9, 9, 1), ("2026-01-07", 1, 2, "A", 3, 3, 1)])
    merged = keyed.merge_upsert(target, updates, K.SUMMARY_KEYS)
    assert sorted(r["total_volume"] for r in merged.collect()) == [1, 3, 9]
    assert keyed.merge_upsert(merged, updates, K.SUMMARY_KEYS).exceptAll(merged).count() == 0
    days = lambda df: sorted(str(r[0]) for r in df.select("trade_date").collect())
    assert days(keyed.incremental_slice(merged, target)) == ["2026-01-06", "2026-01-07"]
    assert days(keyed.incremental_slice(merged, target, lookback_days=1)) == ["2026-01-05", "2026-01-06", "2026-01-07"]
    assert len(days(keyed.incremental_slice(merged, target.limit(0)))) == len(days(keyed.incremental_slice(merged, None))) == 3
    once = keyed.dedupe(merged, ["symbol"], ["total_volume"])
    assert [r["total_volume"] for r in once.collect()] == [1]
    assert keyed.dedupe(once, ["symbol"], ["total_volume"]).exceptAll(once).count() == 0


def test_alerts_once(spark):
    found = fact(spark, [("2026-01-05", 1, 2, "A", 1, 10, 1), ("2026-01-05", 1, 3, "A", 2, 20, 1),
                         ("2026-01-05", 1, 2, None, 3, 5, 1), ("2026-01-05", 1, 3, None, 4, 5, 1)])
    first = alerts.build_alerts(found)
    assert rows_of(first, "symbol", "details") == sorted([
        ("A", "Volume: 2 Amount: NRs.20.00"), (None, "Volume: 3 Amount: NRs.5.00"), (None, "Volume: 4 Amount: NRs.5.00")], key=repr)
    assert rows_of(alerts.build_alerts(found, first), "symbol") == [(None,), (None,)]
    assert alerts.open_alerts(first.withColumn("is_reviewed", F.lit(True))).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([("a", 5), ("a", 0), (None, None)], "id string, quantity long")
    assert dict(quality.check_not_null(df, ["id", "quantity"]).collect()) == {"id": 1, "quantity": 1}
    assert dict(quality.check_rules(df, {"positive": "quantity > 0"}).collect()) == {"positive": 1}
    assert rows_of(quality.check_unique(df.filter("id is not null"), ["id"]), "id", "rows") == [("a", 2)]
    good, bad = quality.quarantine(df, {"positive": "quantity > 0"}, ["id"])
    assert good.count() == 1 and rows_of(bad, "reasons") == [("id_missing",), ("positive",)]
    with pytest.raises(ValueError, match="positive 1"):
        quality.require_clean(df, "rows", rules={"positive": "quantity > 0"})


def test_isolation_forest(spark):
    rows = [("2026-01-05", i % 40, i // 40, f"S{i % 7}", 100 + i % 13, 1000 + i % 17, 1 + i % 3) for i in range(600)]
    rows.append(("2026-01-05", 99, 98, "ODD", 90000, 9000000, 500))
    rows += [("2026-01-06", i, i + 1, "T", 10 + i, 100 + i, 1) for i in range(20)]
    df = fact(spark, rows)
    scored = isolation.isolation_scores(df, trees=50)
    day = scored.filter("trade_date = date'2026-01-05'")
    flagged = isolation.outliers(day)
    assert "ODD" in [r["symbol"] for r in flagged.collect()]
    assert scored.count() == len(rows) and 1 <= flagged.count() <= 7
    # Neither the partitioning nor the chunk size changes a score.
    again = isolation.isolation_scores(df.repartition(7), trees=50, rows_per_chunk=100)
    assert again.exceptAll(scored).count() == 0 and scored.exceptAll(again).count() == 0


def test_forest_functions_run_without_the_package(tmp_path):
    """Workers may lack this package; the functions sent to them must not need it."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    sent = tmp_path / "sent.bin"
    sent.write_bytes(cloudpickle.dumps((isolation.grow_forest, isolation.path_scores)))
    code = ("import pickle, sys, numpy as np; grow, score = pickle.load(open(sys.argv[1], 'rb'));"
            "x = np.arange(30.0).reshape(10, 3); f = grow(x, np.zeros(10, dtype=np.int64), 1, 42);"
            "assert len(score(x, f, 10)) == 10 and 'tallyloom' not in sys.modules")
    subprocess.run([sys.executable, "-c", code, str(sent)], check=True, cwd=str(tmp_path))
