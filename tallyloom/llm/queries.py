"""The queries of this subpackage over the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from tallyloom.llm import backoff, bwt_dedup, decision_list, filter_audit, license_join, line_blocks, packing, pivotal, secrets, simhash, syncmers, term_pipeline, warc
from tallyloom.llm.common import table

QUERIES = {
    "op1_syncmer_fingerprints": lambda spark, d: syncmers.op1_fingerprints(table(spark, d, "documents")),
    "op2_source_mix": lambda spark, d: pivotal.op2_source_mix(table(spark, d, "documents")),
    "op3_quality_rules": lambda spark, d: decision_list.op3_quality_rules(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_main_text": lambda spark, d: line_blocks.op4_main_text(table(spark, d, "pages")),
    "op5_backoff_scores": lambda spark, d: backoff.op5_backoff_scores(table(spark, d, "documents")),
    "op6_simhash_groups": lambda spark, d: simhash.op6_simhash(table(spark, d, "documents")),
    "op7_suffix_dedup": lambda spark, d: bwt_dedup.op7_suffix_dedup(table(spark, d, "documents")),
    "op8_warc": lambda spark, d: warc.op8_warc(table(spark, d, "pages")),
    "op9_best_fit_packing": lambda spark, d: packing.op9_packing(table(spark, d, "documents")),
    "op10_secret_scans": lambda spark, d: secrets.op10_secret_scans(table(spark, d, "documents")),
    "op11_filter_audit": lambda spark, d: filter_audit.op11_filter_audit(table(spark, d, "documents"), table(spark, d, "labels")),
    "op12_ranked_search": lambda spark, d: term_pipeline.op12_ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op13_license_scans": lambda spark, d: license_join.op13_license_scans(table(spark, d, "documents")),
}

ORACLES: dict[str, str] = {
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_ranked_search": term_pipeline.OP12_SQL,
    "op13_license_scans": license_join.OP13_SQL,
}
