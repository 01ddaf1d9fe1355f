"""Saving and loading of fitted models: a folder with a table per part and one row of settings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.forest import Forest
from tallyloom.operators.linear import LinearModel
from tallyloom.operators.text_forest import TextForest
from tallyloom.operators.tfidf import Tfidf


def _write(path: str, settings: dict, **tables: DataFrame) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    spark.range(1).selectExpr(f"'{json.dumps(settings)}' AS settings").write.mode("overwrite").parquet(f"{path}/settings")


def _vocabulary(vocabulary: Tfidf) -> dict:
    return {"limit": vocabulary.limit, "rows_per_task": vocabulary.rows_per_task}


def save_model(model: Forest | TextForest | LinearModel, path: str) -> None:
    """Write a fitted model, replacing an older one at that path."""
    if isinstance(model, Forest):
        _write(path, {"kind": "forest", "features": model.features}, trees=model.table)
    elif isinstance(model, TextForest):
        _write(path, {"kind": "text forest", "classes": model.classes, "ngram": model.ngram, **_vocabulary(model.vocabulary)},
               trees=model.table, index=model.index, terms=model.vocabulary.terms)
    else:
        _write(path, {"kind": "linear", "classes": model.classes, "passes": model.passes, **_vocabulary(model.vocabulary)},
               weights=model.weights, terms=model.vocabulary.terms)


def load_model(path: str) -> Forest | TextForest | LinearModel:
    """Read a model written by :func:`save_model`."""
    spark = SparkSession.active()
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    settings = json.loads(table("settings").first()["settings"])
    if settings["kind"] == "forest":
        return Forest(tuple(settings["features"]), table("trees"))
    vocabulary = Tfidf(table("terms"), settings["limit"], settings["rows_per_task"])
    if settings["kind"] == "linear":
        return LinearModel(tuple(settings["classes"]), vocabulary, table("weights"), settings["passes"])
    return TextForest(tuple(settings["classes"]), tuple(settings["ngram"]), vocabulary, table("index"), table("trees"))
