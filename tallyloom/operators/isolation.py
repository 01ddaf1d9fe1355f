"""Isolation forest per day over a table of any size.

Method: Liu, Ting, Zhou, "Isolation Forest", 2008. Every day has its own forest. Trees grow from
hash-drawn samples, so the result depends on the rows and the seed only, not on partitioning.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.hashing import HASH_BITS
from tallyloom.session import cut_lineage

# Send this module's functions with the tasks: executors need numpy and pandas, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = ("total_volume", "total_amount", "trade_count")
CONTAMINATION, TREES, SAMPLE, SEED = 0.01, 100, 256, 42
ROWS_PER_CHUNK = 100_000
SCORE_DIGITS = 6
ALL_TREES = -1


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` leaves."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n, 3) - 1.0) + np.euler_gamma) - 2.0 * (np.maximum(n, 3) - 1.0) / np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, big))


def grow_forest(x: np.ndarray, tree: np.ndarray, trees: int, seed: int) -> tuple:
    """Grow all trees together, level by level. Heap layout: children of node i are 2i+1 and 2i+2.

    Returns feature (-1 in leaves), threshold and leaf path length, each of shape (trees, nodes).
    """
    sizes = np.bincount(tree, minlength=trees)
    height = max(1, math.ceil(math.log2(max(int(sizes.max(initial=0)), 2))))
    nodes = 2 ** (height + 1) - 1
    rng = np.random.default_rng(seed)
    feature = np.full((trees, nodes), -1, dtype=np.int64)
    threshold = np.zeros((trees, nodes))
    path = np.zeros((trees, nodes))
    node = np.zeros(len(x), dtype=np.int64)
    live = np.arange(len(x))
    for depth in range(height + 1):
        width, first = 2 ** depth, 2 ** depth - 1
        slots = trees * width
        # Draws are made for every slot, so a tree does not depend on which other nodes are in use.
        pick = rng.random((slots, x.shape[1]))
        where = rng.random(slots)
        if len(live) == 0:
            continue
        slot = tree[live] * width + (node[live] - first)
        order = np.argsort(slot, kind="stable")
        live, slot = live[order], slot[order]
        used, start, count = np.unique(slot, return_index=True, return_counts=True)
        low = np.minimum.reduceat(x[live], start, axis=0)
        high = np.maximum.reduceat(x[live], start, axis=0)
        spread = high > low
        t, n = used // width, used % width + first
        splits = spread.any(axis=1) & (count > 1) & (depth < height)
        path[t, n] = depth + _mean_path(count)
        if not splits.any():
            live = live[:0]
            continue
        chosen = np.where(spread, pick[used], -1.0).argmax(axis=1)
        rows = np.arange(len(used))
        lo, hi = low[rows, chosen], high[rows, chosen]
        cut = lo + where[used] * (hi - lo)
        cut = np.where(cut >= hi, lo, cut)
        feature[t[splits], n[splits]] = chosen[splits]
        threshold[t[splits], n[splits]] = cut[splits]
        group = np.repeat(rows, count)
        goes_on = splits[group]
        live, group = live[goes_on], group[goes_on]
        right = x[live, chosen[group]] > cut[group]
        node[live] = 2 * node[live] + 1 + right
    return feature, threshold, path


def path_scores(x: np.ndarray, forest: tuple, sample: int, block: int = 20_000) -> np.ndarray:
    """Anomaly score 2^(-mean path / c(sample)) of each row; near 1 is odd, near 0 is ordinary."""
    feature, threshold, path = forest
    trees = np.arange(feature.shape[0])[:, None]
    height = int(math.log2(feature.shape[1] + 1)) - 1
    scale = float(_mean_path(np.array([sample]))[0])
    mean = np.empty(len(x))
    for first in range(0, len(x), block):
        part = x[first:first + block]
        rows = np.arange(len(part))[None, :]
        node = np.zeros((feature.shape[0], len(part)), dtype=np.int64)
        for _ in range(height):
            f = feature[trees, node]
            right = part[rows, np.maximum(f, 0)] > threshold[trees, node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        mean[first:first + block] = path[trees, node].mean(axis=0)
    return np.power(2.0, -mean / scale) if scale > 0 else np.full(len(x), 0.5)


def _sampled(rows: DataFrame, by: str, trees: int, sample: int) -> DataFrame:
    """Rows each tree grows from: min(sample, n) of a day's n rows per tree, drawn by hash."""
    pool = trees * sample
    # Copies of a row: half as many again as fill all trees from n rows, so none falls short; the rank cuts the rest.
    copies = F.least(F.lit(trees), F.ceil(F.lit(1.5 * pool) / F.col("_n"))).cast("int")
    # Large days: keep four times the rows needed, long before any sort.
    share = F.lit(4.0 * pool) / F.col("_n") * F.lit(float(2 ** HASH_BITS))
    drawn = rows.filter((F.col("_n") <= 4 * pool) | (F.col("_draw") < share)).withColumn("_copies", copies)
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    ranked = F.array_sort(F.transform(every, lambda t: F.struct(F.xxhash64(F.col("_id"), t).alias("h"), t.alias("t"))))
    some = F.transform(F.slice(ranked, F.lit(1), F.col("_copies")), lambda s: s["t"])
    # Days no larger than a sample: every tree grows from all rows, sent once under the mark ALL_TREES.
    chosen = (F.when(F.col("_n") <= sample, F.array(F.lit(ALL_TREES)))
              .when(F.col("_copies") == 1, F.array(F.pmod(F.xxhash64("_id", F.lit(-1)), F.lit(trees)).cast("int")))
              .otherwise(some))
    assigned = drawn.withColumn("_tree", F.explode_outer(chosen)).withColumn("_order", F.xxhash64("_id", "_tree"))
    rank = F.row_number().over(Window.partitionBy(by, "_tree").orderBy("_order", "_id"))
    return assigned.withColumn("_rank", rank).filter(F.col("_rank") <= sample)


def isolation_scores(fact: DataFrame, by: str = "trade_date", keys=("buyer_broker", "seller_broker", "symbol"),
                     features=FEATURES, contamination: float = CONTAMINATION, trees: int = TREES,
                     sample: int = SAMPLE, seed: int = SEED, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Score every row of every day and mark the strangest share: adds ``score`` and ``prediction`` (-1 = outlier).

    A day is scored in chunks of about ``rows_per_chunk`` rows. Each chunk meets the same small sample of
    its day, grows the same forest from it and scores its own rows, so no task holds a whole large day.
    """
    features, keys = list(features), list(keys)
    sizes = fact.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.ceil(F.col("_n") / F.lit(rows_per_chunk)).cast("int")
    rows = (fact.withColumn("_id", F.xxhash64(by, *keys, F.lit(seed)))
            .join(sizes, by)
            .withColumn("_draw", F.shiftrightunsigned(F.xxhash64("_id", F.lit("draw")), 64 - HASH_BITS))
            .withColumn("_chunk", F.pmod(F.xxhash64("_id", F.lit("chunk")), chunks).cast("int")))
    numbers = [F.col(c).cast("double").alias(c) for c in features]
    samples = (_sampled(rows.select(by, *numbers, "_n", "_id", "_draw"), by, trees, sample)
               .withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
               .select(F.col(by).alias("_sample_of"), F.col("_chunk").alias("_sample_chunk"), "_id", "_tree", *features))
    wanted = rows.select(by, "_chunk", "_n", *fact.drop(by).columns)
    kept = [f for f in fact.schema.fields]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def score(part: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
        out = part[[f.name for f in kept]].copy()
        if len(out) == 0:
            return out.assign(score=pd.Series(dtype=float))
        drawn = drawn.sort_values(["_tree", "_id"], kind="stable")
        grown, tree = drawn[features].to_numpy(float), drawn["_tree"].to_numpy(np.int64)
        if len(tree) and tree[0] == ALL_TREES:
            grown, tree = np.tile(grown, (trees, 1)), np.repeat(np.arange(trees), len(tree))
        forest = grow_forest(grown, tree, trees, seed)
        rows_in = out[features].astype(float).to_numpy()
        return out.assign(score=path_scores(rows_in, forest, int(min(sample, part["_n"].iloc[0]))))

    # A fixed number of partitions: growing forests costs time, not bytes, so small data must stay spread out.
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = wanted.repartition(parts, by, "_chunk").groupBy(by, "_chunk")
    drawn_rows = samples.repartition(parts, "_sample_of", "_sample_chunk").groupBy("_sample_of", "_sample_chunk")
    scored = placed.cogroup(drawn_rows).applyInPandas(score, schema).withColumn("score", F.round("score", SCORE_DIGITS))
    # Read twice below (percentile and flags): keep the scores instead of growing the forests again.
    return flag_outliers(cut_lineage(scored), by, contamination)


def flag_outliers(scored: DataFrame, by: str = "trade_date", contamination: float = CONTAMINATION) -> DataFrame:
    """Mark rows whose score lies above the (1 - contamination) percentile of their day with -1, others with 1.

    Scores are rounded, so a day has at most a million distinct ones; the percentile is exact and reads
    those with their counts.
    """
    counts = scored.groupBy(by, "score").agg(F.count(F.lit(1)).alias("_times"))
    cuts = counts.groupBy(by).agg(F.percentile("score", 1.0 - contamination, F.col("_times")).alias("_cut"))
    return scored.join(cuts, by).withColumn(
        "prediction", F.when(F.col("score") > F.col("_cut"), F.lit(-1)).otherwise(F.lit(1))).drop("_cut")


def outliers(scored: DataFrame) -> DataFrame:
    """Rows marked as outliers."""
    return scored.filter(F.col("prediction") == -1)
