"""Time the headline queries. Prints one JSON line; BENCH_SF_DIR and BENCH_CPUS choose tables and cores."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.plans.registry import QUERIES
from tallyloom.session import get_session

HEADLINE = (
    "f1_wash_trades", "c1_reciprocal_pairs", "d1_broker_matrix", "d15_dedupe", "a2_floorsheet_roundtrip",
    "a1_forex_roundtrip", "c2_append_if_absent", "c3_merge_upsert", "l2_refresh_fact", "k2_rules", "d6_impute",
    "i13_label_encode", "i7_balance", "h11_clean_text", "i5_tfidf", "i8_nb_model", "i9_nb_predict", "d12_class_report",
    "j6_articles", "j4_links", "i20_vocabulary", "i23_next_words", "i17_isolation_scores",
    "i23_kneser_ney", "c5_claim_pages",
)


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(QUERIES["d2_row_counts"], spark, folder)
    seconds = {name: round(run(QUERIES[name], spark, folder), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
