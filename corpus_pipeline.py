"""From raw documents to packed sequences: quality rules, near-duplicates, secrets, source mix, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decision_list, packing, pivotal, secrets, simhash
from tallyloom.llm.common import table
from tallyloom.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rule or the decision list learned from the labels rejects."""
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group linked by SimHash fingerprints of four words, four bits apart at most."""
    return simhash.keep_first(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; no document goes. n_chars follows the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out or repeats documents so that each source has its share of the words."""
    return pivotal.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a packed sequence."""
    return packing.op9_packing(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: No stage but the base rule can be written as SQL (learned rules, linked fingerprints, random rounding, tokens).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared folder and read again by the next."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
