"""Suggestions from the whole seed: interpolated Kneser-Ney probabilities of orders 1 to 4, kept per context.

The highest order counts how often a word follows three others; a lower one counts how many different words come before
the shorter run (Kneser, Ney, "Improved backing-off for m-gram language modeling", 1995; Chen, Goodman, 1998, for the
interpolation). Every run that occurs has a row with its probability, which takes that of the run without its first word from
the table one order below: one join per order, as long as the runs that occur.

The best next word of a context is the best of the words seen after it, or the best one of the shorter context at the share
that is left to it: words not seen after a context keep the order they have below. So no context meets the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import let, sequence_words
from tallyloom.operators.frames import unnest
from tallyloom.operators.skew import ROWS_PER_TASK, hot_keys, spread_join
from tallyloom.session import cut_lineage, write_staged

ORDER, DISCOUNT = 4, 0.75
#: Probabilities are compared to so many digits; of equal ones the first word of the alphabet is taken.
DIGITS = 12


def _runs(words: Column, n: int) -> Column:
    """(context, word) of each run of ``n`` words: all but the last one joined, and the last."""
    def at(w: Column, i: Column) -> Column:
        before = [F.get(w, i + k) for k in range(n - 1)]
        return F.struct(F.concat_ws(" ", *before).alias("context"), F.get(w, i + (n - 1)).alias("word"))

    starts = lambda w: F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
    return let(words, lambda w: F.transform(starts(w), lambda i: at(w, i)))


def run_counts(lines: DataFrame, n: int, line: str = "line") -> DataFrame:
    """(context, tail, word, n): how often each run of ``n`` words occurs within the lines."""
    rows = unnest(lines, [], _runs(sequence_words(F.col(line)), n), "_r").select("_r.*")
    counts = rows.groupBy("context", "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("context", _shorter(n).alias("tail"), "word", "n")


def _shorter(n: int) -> Column:
    """The context of a run of ``n`` words without its first word."""
    return F.lit("") if n == 2 else F.regexp_replace("context", r"^[^ ]+ ", "")


def _shares(counts: DataFrame) -> DataFrame:
    """(context, left): the share of each context's probability that is left to the shorter one; with its total."""
    return counts.groupBy("context").agg(F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("kinds")).select(
        "context", "total", "kinds", (F.col("kinds") * DISCOUNT / F.col("total")).alias("left"))


def _best(scored: DataFrame, by) -> DataFrame:
    """The most likely word of each context, first in the alphabet on ties."""
    order = F.struct(-F.round("prob", DIGITS), F.col("word"), F.col("prob"))
    top = scored.groupBy(*by).agg(F.min(order).alias("_t"))
    return top.select(*by, F.col("_t.word").alias("word"), F.col("_t.prob").alias("prob"))


def fit_kneser_ney(lines: DataFrame, order: int = ORDER, line: str = "line", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(size, context, word, prob): the most likely next word after each context of ``size`` words that occurs, size 0 for none."""
    def preceded(counts: DataFrame) -> DataFrame:  # how many different words come before the run
        return counts.groupBy(F.col("tail").alias("context"), "word").agg(F.count(F.lit(1)).alias("n"))

    # The highest order is read twice, the others once; tables are kept as files, which are smaller than checkpoints.
    counted = {n: run_counts(lines, n, line) for n in range(2, order + 1)}
    counted[order] = write_staged(counted[order].drop("tail")).withColumn("tail", _shorter(order))
    alone = write_staged(preceded(counted[2]).drop("context"))  # words that come before each word
    total = alone.agg(F.sum("n").cast("double")).scalar()
    below = alone.select(F.lit("").alias("context"), "word", "n", (F.col("n") / total).alias("prob"))
    best = _best(below, ["context"])
    tables = [best.select(F.lit(0).alias("size"), "context", "word", "prob")]
    for n in range(2, order + 1):
        runs = (counted[n] if n == order else write_staged(preceded(counted[n + 1]))).withColumn("tail", _shorter(n))
        shares = write_staged(_shares(runs))
        lower = below.select(F.col("context").alias("tail"), "word", F.col("prob").alias("_p"))
        # A run's shorter form may end very many runs: such forms are split. The order below has counted the runs of a form,
        # and the shares those of a context.
        many = hot_keys(below.withColumnRenamed("context", "tail"), ["tail", "word"], rows_per_task, weight="n")
        forms = spread_join(runs, lower, ["tail", "word"], many, spread_by=["context"]).drop("tail")
        held = shares.select("context", "total", "left")
        at_context = spread_join(forms, held, "context", hot_keys(shares, "context", rows_per_task, weight="kinds"), spread_by=["word"])
        prob = (F.col("n") - DISCOUNT) / F.col("total") + F.col("left") * F.col("_p")
        scored = at_context.select("context", "word", "n", prob.alias("prob"))
        below = write_staged(scored) if n < order else scored  # the last one is read once
        fallback = best.select(F.col("context").alias("tail"), "word", F.col("prob").alias("_p"))
        asked = shares.select("context", "left", _shorter(n).alias("tail"))
        rest = spread_join(asked, fallback, "tail", hot_keys(asked, "tail", rows_per_task), spread_by=["context"]).select(
            "context", "word", (F.col("left") * F.col("_p")).alias("prob"))
        best = write_staged(_best(below.drop("n").unionByName(rest), ["context"]))
        tables.append(best.select(F.lit(n - 1).alias("size"), "context", "word", "prob"))
    made = tables[0]
    for t in tables[1:]:
        made = made.unionByName(t)
    return made


def suggest(seeds: DataFrame, model: DataFrame, text: str = "seed", order: int = ORDER, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``next_word`` and ``prob`` by the longest end of the seed, up to ``order`` - 1 words, that the model knows."""
    keyed = cut_lineage(seeds.withColumn("_id", F.monotonically_increasing_id()).withColumn("_w", sequence_words(F.col(text))))
    ends = F.transform(F.sequence(F.lit(0), F.least(F.size("_w"), F.lit(order - 1))), lambda k: F.struct(
        k.alias("size"), F.concat_ws(" ", F.slice("_w", F.size("_w") - k + 1, k)).alias("context")))
    asked = keyed.select("_id", F.inline(ends))
    found = spread_join(asked, model, ["size", "context"], hot_keys(asked, ["size", "context"], rows_per_task), spread_by=["_id"])
    longest = found.groupBy("_id").agg(F.max(F.struct("size", "word", "prob")).alias("_f"))
    return keyed.join(longest, "_id", "left").select(*seeds.columns, F.col("_f.word").alias("next_word"), F.col("_f.prob").alias("prob"))
