"""Multinomial Naive Bayes on long weight tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators.tfidf import Tfidf, lookup_terms
from tallyloom.session import write_staged

ALPHA = 1.0


@dataclass(frozen=True)
class NaiveBayes:
    """``priors``: one row, log prior per class; ``terms``: (term, log_probs), both aligned with ``classes``."""

    classes: tuple
    priors: DataFrame
    terms: DataFrame


def _per_class(make, classes) -> Column:
    return F.array(*[make(c) for c in classes])


def fit_nb(weights: DataFrame, docs: DataFrame, classes, label: str = "label", alpha: float = ALPHA) -> NaiveBayes:
    """Class log priors from ``docs`` and smoothed term log probabilities from ``weights``.

    One aggregate per table: the classes are known, so each term becomes one row with one sum per class.
    """
    classes = tuple(classes)
    priors = docs.agg(F.count_if(F.col(label).isin(list(classes))).alias("_n"),
                      *[F.count_if(F.col(label) == F.lit(c)).alias(f"_c{i}") for i, c in enumerate(classes)]).select(
        F.array(*[F.log(F.when(F.col(f"_c{i}") > 0, F.col(f"_c{i}").cast("double") / F.col("_n"))
                        .otherwise(F.raise_error(F.lit(f"class {c} has no rows")).cast("double")))
                  for i, c in enumerate(classes)]).alias("log_priors"))
    sums = weights.groupBy("term").agg(*[
        F.sum(F.when(F.col(label) == F.lit(c), F.col("weight")).otherwise(0.0)).alias(f"_s{i}")
        for i, c in enumerate(classes)])
    sums = write_staged(sums)  # read for the mass and for the rows
    mass = sums.agg(F.struct(F.count(F.lit(1)).alias("terms"),
                             *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(classes))]).alias("_mass"))
    total = mass.scalar()
    terms = sums.withColumn("_total", total).select("term", F.array(*[
        F.log((F.col(f"_s{i}") + alpha) / (F.col(f"_total._s{i}") + alpha * F.col("_total.terms")))
        for i in range(len(classes))]).alias("log_probs"))
    return NaiveBayes(classes, priors, terms)


def class_terms(model: NaiveBayes) -> DataFrame:
    """Log probability of each term in each class: (term, label, log_prob)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col("log_probs")[i].alias("log_prob"))
                      for i, c in enumerate(model.classes)])
    return model.terms.select("term", F.inline(pairs))


def class_priors(model: NaiveBayes) -> DataFrame:
    """Log prior of each class: (label, log_prior)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col("log_priors")[i].alias("log_prior"))
                      for i, c in enumerate(model.classes)])
    return model.priors.select(F.inline(pairs))


def top_class_terms(model: NaiveBayes, k: int = 20, digits: int | None = None) -> DataFrame:
    """The ``k`` most likely terms of each class, alphabetical on ties: (label, rank, term, log_prob)."""
    terms = class_terms(model)
    if digits is not None:
        terms = terms.withColumn("log_prob", F.round("log_prob", digits))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("log_prob"), "term"))
    return terms.withColumn("rank", rank).filter(F.col("rank") <= k).select("label", "rank", "term", "log_prob")


def class_scores(weights: DataFrame, docs: DataFrame, model: NaiveBayes, vocabulary: Tfidf, key: str) -> DataFrame:
    """Joint log likelihood per document and class: (key, s0, s1, ...).

    Every document adds its priors, so one without a known term is scored by them alone.
    """
    span = range(len(model.classes))
    prior = model.priors.scalar()
    known = lookup_terms(weights.select(key, "term", "weight"), model.terms, vocabulary).select(
        key, *[(F.col("weight") * F.col("log_probs")[i]).alias(f"s{i}") for i in span])
    base = docs.select(key).withColumn("_p", prior).select(key, *[F.col("_p")[i].alias(f"s{i}") for i in span])
    return known.unionByName(base).groupBy(key).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in span])


def predict_nb(weights: DataFrame, docs: DataFrame, model: NaiveBayes, vocabulary: Tfidf, key: str) -> DataFrame:
    """Predicted class, class probabilities and confidence in percent per document."""
    names = [f"s{i}" for i in range(len(model.classes))]
    scores = class_scores(weights, docs, model, vocabulary, key)
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    shares = [F.exp(F.col(n) - F.col("_best")) for n in names]
    prediction = F.lit(None).cast("string")
    for n, c in reversed(list(zip(names, model.classes))):
        prediction = F.when(F.col(n) == F.col("_best"), F.lit(str(c))).otherwise(prediction)
    total = sum(shares[1:], shares[0])
    probs = scores.withColumn("_best", best).select(
        key, prediction.alias("prediction"), F.array(*[s / total for s in shares]).alias("probabilities"))
    return probs.withColumn("confidence", F.array_max("probabilities") * 100.0)


def save_nb(model: NaiveBayes, path: str) -> None:
    """Write the model as two Parquet tables."""
    model.priors.withColumn("classes", F.array(*[F.lit(str(c)) for c in model.classes])) \
        .write.mode("overwrite").parquet(f"{path}/priors")
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")


def load_nb(spark: SparkSession, path: str) -> NaiveBayes:
    """Read a model written by :func:`save_nb`."""
    priors = spark.read.parquet(f"{path}/priors")
    classes = tuple(priors.select("classes").first()[0])
    return NaiveBayes(classes, priors.select("log_priors"), spark.read.parquet(f"{path}/terms"))
