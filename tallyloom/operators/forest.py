"""Regression forest of trees grown to the end, kept as a table with one row per tree.

Every tree draws its own rows: a row is taken k times by a tree with the chance of a bootstrap sample (Poisson), fixed by a
hash of the row and the tree, so a fit does not depend on partitioning. Every tree draws from all rows, as many as there are.
Rows are stored once and read by the task of each tree, which keeps those that the tree drew: no copy of them is shuffled. A
tree is grown in one task, level by level over all its nodes at once, with exact thresholds and no limit on depth unless the
caller sets one. Neither rows nor trees pass through the driver.

A task holds the rows that its tree drew, so it grows with the table; attributes and orders take 16 bytes a row and attribute.
A tree has less than twice as many nodes as rows drawn. Scoring takes each distinct row of attributes once:
a task holds a share of the trees (``NODES_PER_HOLDER``) and its rows pass by them in batches, so trees are sent out once for
each task that works at a time and not once for so many rows.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import cut_apart, cut_lineage, to_each, write_staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES, SEED = 100, 42
#: A node takes 13 bytes in a task that scores, so a task holds 260 MB of trees at most, or one tree.
ROWS_PER_BLOCK, NODES_PER_HOLDER = 50_000, 20_000_000
#: Trees whose values are added first, so that sums do not depend on the number of holders.
TREES_PER_GROUP = 10
#: No bootstrap of mean 1 takes a row more often (chance below 1e-10).
MOST_COPIES = 12
#: Scores that differ by rounding alone are equal.
TIE = 1e-12
HASH_RANGE = float(1 << 32)
TREE = ("tree int, depth int, feature array<int>, threshold array<double>, child array<int>, value array<double>, "
        "importance array<double>")


@dataclass(frozen=True)
class Forest:
    """``table`` holds a row per tree (``TREE``): the attribute a node splits on (-1 at a leaf), the number of its left child
    (the right one follows), its mean, and each attribute's share of the tree's gain."""

    features: tuple[str, ...]
    table: DataFrame


def _copies(mean: float, draw: Column) -> Column:
    """How often a row is drawn, by a uniform number in [0, 1)."""
    chance, below, taken = math.exp(-mean), 0.0, F.lit(0)
    for k in range(MOST_COPIES):
        below += chance
        taken = taken + F.when(draw >= below, 1).otherwise(0)
        chance *= mean / (k + 1)
    return taken


def drawn_rows(rows: DataFrame, trees: int, mean: float, seed: int, first: int | Column = 0) -> DataFrame:
    """The rows of each tree from ``first`` on with the number of times it drew them: adds ``_tree`` and ``_times``; ``_id`` names a row."""
    number = lambda t: F.shiftrightunsigned(F.xxhash64(F.col("_id"), t, F.lit(seed)), 32)
    # Only trees that draw a row are unnested, not a row for each tree.
    least = math.ceil(math.exp(-mean) * HASH_RANGE)
    hit = F.filter(F.sequence(F.lit(first), F.lit(first + trees - 1)), lambda t: number(t) >= least)
    return (rows.withColumn("_tree", F.explode(hit)).withColumn("_draw", number(F.col("_tree")) / HASH_RANGE)
            .withColumn("_times", _copies(mean, F.col("_draw"))).drop("_draw"))


def _best_splits(x: np.ndarray, w: np.ndarray, wy: np.ndarray, orders: list[np.ndarray], starts: np.ndarray, seg: np.ndarray):
    """(score, attribute, threshold) of the best cut of each node; attribute -1 where no cut exists."""
    score, chosen, cut = np.full(len(starts), -1.0), np.full(len(starts), -1), np.zeros(len(starts))
    before_w, before_y = np.zeros(len(starts)), np.zeros(len(starts))
    total_w, total_y = np.add.reduceat(w[orders[0]], starts), np.add.reduceat(wy[orders[0]], starts)
    together = seg[:-1] == seg[1:]
    for j, order in enumerate(orders):
        values, cw, cy = x[:, j][order], np.cumsum(w[order]), np.cumsum(wy[order])
        at = np.flatnonzero((values[:-1] < values[1:]) & together)
        if not len(at):
            continue
        before_w[1:], before_y[1:] = cw[starts[1:] - 1], cy[starts[1:] - 1]
        node = seg[at]
        left_w, left_y = cw[at] - before_w[node], cy[at] - before_y[node]
        right_w, right_y = total_w[node] - left_w, total_y[node] - left_y
        found = left_y * left_y / left_w + right_y * right_y / right_w
        heads = np.append(0, np.flatnonzero(np.diff(node)) + 1)
        most = np.maximum.reduceat(found, heads)
        hit = np.flatnonzero(found >= np.repeat(most * (1 - TIE), np.diff(np.append(heads, len(node)))))
        first = np.append(0, np.flatnonzero(np.diff(node[hit])) + 1)
        nodes = node[hit[first]]
        better = most > score[nodes] * (1 + TIE)  # of equal cuts the first attribute's first one is taken
        nodes, place = nodes[better], at[hit[first[better]]]
        low, high = values[place], values[place + 1]
        middle = (low + high) / 2
        score[nodes], chosen[nodes], cut[nodes] = most[better], j, np.where(middle >= high, low, middle)
    return score - total_y * total_y / total_w, chosen, cut


def _divided(order: np.ndarray, right: np.ndarray, on_left: np.ndarray) -> np.ndarray:
    """Rows of each node put into those of its two children, order kept; ``on_left`` marks the places of left children."""
    out = np.empty_like(order)
    out[on_left], out[~on_left] = order[~right], order[right]
    return out


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int | None = None) -> dict:
    """One tree over the rows of ``x`` with weights ``w``: nodes are cut while their targets differ and a cut exists."""
    middle = float(np.average(y, weights=w))
    y = y - middle
    wy = w * y
    kind = np.int32 if len(y) < 1 << 31 else np.int64
    orders = [np.argsort(x[:, j], kind="stable").astype(kind) for j in range(x.shape[1])]
    over = np.zeros(len(y), bool)  # of a row that lies to the right of its node's cut
    sizes, nodes = np.array([len(y)]), np.array([0])
    feature, threshold, child, value = [np.array([-1])], [np.zeros(1)], [np.zeros(1, np.int64)], [np.array([middle])]
    importance, depth, made = np.zeros(x.shape[1]), 0, 1
    while len(nodes) and (max_depth is None or depth < max_depth):
        starts = np.append(0, np.cumsum(sizes)[:-1])
        seg = np.repeat(np.arange(len(sizes)), sizes)
        targets = y[orders[0]]
        mixed = np.maximum.reduceat(targets, starts) > np.minimum.reduceat(targets, starts)
        gain, chosen, cut = _best_splits(x, w, wy, orders, starts, seg)
        parts = mixed & (chosen >= 0)
        if not parts.any():
            break
        np.add.at(importance, chosen[parts], np.maximum(gain[parts], 0.0))
        if not parts.all():
            kept = parts[seg]
            orders = [o[kept] for o in orders]
        sizes, chosen, cut, nodes = sizes[parts], chosen[parts], cut[parts], nodes[parts]
        starts = np.append(0, np.cumsum(sizes)[:-1])
        seg = np.repeat(np.arange(len(sizes)), sizes)
        above = x[orders[0], chosen[seg]] > cut[seg]
        over[orders[0]] = above
        n_right = np.add.reduceat(above.astype(np.int64), starts)
        both = np.stack([sizes - n_right, n_right], axis=1).ravel()
        on_left = np.repeat(np.arange(len(both)) % 2 == 0, both)
        orders = [_divided(o, over[o], on_left) for o in orders]
        first = made + 2 * np.arange(len(nodes))
        for level, known in ((feature, chosen), (threshold, cut), (child, first)):
            level[depth][nodes - (made - len(level[depth]))] = known  # the newest level's nodes are the last ones made
        made += 2 * len(nodes)
        sizes, nodes, depth = both, (first[:, None] + np.arange(2)).ravel(), depth + 1
        starts = np.append(0, np.cumsum(sizes)[:-1])
        means = np.add.reduceat(wy[orders[0]], starts) / np.add.reduceat(w[orders[0]], starts)
        feature.append(np.full(len(nodes), -1))
        threshold.append(np.zeros(len(nodes)))
        child.append(np.zeros(len(nodes), np.int64))
        value.append(means + middle)
    total = importance.sum()
    return {"depth": depth, "feature": np.concatenate(feature), "threshold": np.concatenate(threshold), "child": np.concatenate(child),
            "value": np.concatenate(value), "importance": importance / total if total > 0 else importance}


def tree_values(tree: dict, x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row reaches."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    open_ = rows
    while len(open_):
        here = node[open_]
        inner = tree["feature"][here] >= 0
        open_, here = open_[inner], here[inner]
        node[open_] = tree["child"][here] + (x[open_, tree["feature"][here]] > tree["threshold"][here])
    return tree["value"][node]


def _numbers(table: pa.Table, names) -> np.ndarray:
    return np.stack([table[n].to_numpy() for n in names], axis=1) if table.num_rows else np.empty((0, len(names)))


def _complete(df: DataFrame, columns) -> Column:
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return whole


def fit_forest(df: DataFrame, target: str, features, trees: int = TREES, max_depth: int | None = None, seed: int = SEED,
               key: str | None = None) -> Forest:
    """Grow the trees from all complete rows. ``key`` names the rows; without one, equal rows are drawn together."""
    features = tuple(features)
    inputs = [f"_x{i}" for i in range(len(features))]
    named = F.xxhash64(F.col(key)) if key else F.xxhash64(*[F.col(c) for c in (*features, target)])
    rows = write_staged(df.filter(_complete(df, (*features, target))).select(  # read by each tree: made once
        named.alias("_id"), F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(i) for c, i in zip(features, inputs)]))

    def grow(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        group = pa.Table.from_batches(parts)
        order = np.lexsort((group["_y"].to_numpy(), group["_id"].to_numpy()))
        tree, y, w = group["_tree"][0].as_py(), group["_y"].to_numpy()[order], group["_times"].to_numpy()[order].astype(float)
        x = np.empty((len(order), len(inputs)), order="F")  # an attribute lies together, and is not copied once more
        for j, name in enumerate(inputs):
            x[:, j] = group[name].to_numpy()[order]
        del parts, group, order
        made = grow_tree(x, y, w, max_depth)
        columns = {"tree": pa.array([tree], pa.int32()), "depth": pa.array([made["depth"]], pa.int32())}
        kinds = {"feature": pa.int32(), "child": pa.int32()}
        for name in ("feature", "threshold", "child", "value", "importance"):
            columns[name] = pa.array([made[name]], pa.list_(kinds.get(name, pa.float64())))
        yield pa.record_batch(columns)

    # A partition for each tree, which reads all rows and keeps the drawn ones.
    drawn = drawn_rows(to_each(rows, trees, "_part"), 1, 1.0, seed, F.col("_part")).drop("_part")
    return Forest(features, cut_apart(drawn.mapInArrow(grow, TREE)))


def _held(trees: pa.Table) -> list[dict]:
    """Trees in few bytes: a node needs its threshold or, at a leaf, its value."""
    out = []
    for i in range(trees.num_rows):
        feature, number = trees["_feature"][i].values.to_numpy(), trees["_number"][i].values.to_numpy()
        out.append({"group": trees["_group"][i].as_py(), "feature": feature.astype(np.min_scalar_type(min(-1, -1 - int(feature.max())))), "threshold": number, "child": trees["_child"][i].values.to_numpy(),
                    "value": number})
    return out


def _summer(inputs: list[str], whole: bool):
    """Sums over each group of a holder's trees, or of ``whole`` forests over all groups; in each partition its trees come before its rows."""
    def add_up(batches):
        trees, at = [], None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            ends = np.append(0, np.flatnonzero(np.diff(part["_at"].to_numpy())) + 1)
            for first, size in zip(ends, np.diff(np.append(ends, part.num_rows))):
                run = part.slice(first, size)
                if not size:
                    continue
                if at != run["_at"][0].as_py():
                    trees, at = [], run["_at"][0].as_py()
                n = size - run["_tree"].null_count
                trees += _held(run.slice(0, n))
                if size == n:
                    continue
                x, sums = _numbers(run.slice(n), inputs), {}
                for tree in trees:
                    sums.setdefault(tree["group"], np.zeros(size - n))
                    sums[tree["group"]] += tree_values(tree, x)
                parts = [sum(sums.values(), np.zeros(size - n))] if whole else list(sums.values())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(size - n + 1) * len(parts), pa.int32()), pa.array(np.stack(parts, axis=1).ravel()))
                yield from run.slice(n).select([*inputs, "_holder"]).append_column("_sums", lists).to_batches()

    return add_up


def score_forest(df: DataFrame, forest: Forest, name: str = "prediction") -> DataFrame:
    """Add the mean over all trees; rows with a missing attribute get null. The rows are staged, so columns must be of kinds that Parquet holds."""
    inputs = [f"_x{i}" for i in range(len(forest.features))]
    values = F.struct(*[F.col(c).cast("double").alias(i) for c, i in zip(forest.features, inputs)])
    stored = write_staged(df)  # made once, so a row's attributes are fixed
    placed = stored.withColumn("_row", F.when(_complete(stored, forest.features), values))
    ready = cut_lineage(placed.filter(F.col("_row").isNotNull()).select("_row").distinct().select("_row.*"))
    known = forest.table.agg(F.count(F.lit(1)).alias("trees"), F.coalesce(F.sum(F.size("child")), F.lit(0)).alias("nodes")).first()
    groups = max(1, -(-known["trees"] // TREES_PER_GROUP))
    holders = max(1, min(groups, -(-known["nodes"] // NODES_PER_HOLDER)))
    blocks = max(1, min(-(-ready.count() // ROWS_PER_BLOCK), df.sparkSession.sparkContext.defaultParallelism))
    place = (F.col("_block") * holders + F.col("_holder")).cast("int").alias("_at")
    number = F.zip_with("threshold", F.zip_with("feature", "value", lambda f, v: F.when(f < 0, v)), lambda t, v: F.coalesce(v, t))
    trees = (forest.table.select("tree", "feature", number.alias("_number"), "child", F.pmod("tree", F.lit(groups)).alias("_group"))
             .withColumn("_holder", F.floor(F.col("_group") * holders / groups).cast("int"))
             .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    none = [F.lit(None).cast("double").alias(i) for i in inputs]
    sent = trees.select(place, "_holder", "_group", F.col("tree").alias("_tree"), F.col("feature").alias("_feature"), "_number", F.col("child").alias("_child"), *none)
    asked = (ready.withColumn("_block", F.pmod(F.xxhash64(*inputs), F.lit(blocks)))
             .withColumn("_holder", F.explode(F.sequence(F.lit(0), F.lit(holders - 1)))))
    blank = [F.lit(None).cast(sent.schema[c].dataType).alias(c) for c in ("_group", "_tree", "_feature", "_number", "_child")]
    both = sent.unionByName(asked.select(place, "_holder", *blank, *inputs)).repartitionById(blocks * holders, F.col("_at"))
    kinds = ", ".join(f"{i} double" for i in inputs)
    parts = both.sortWithinPartitions("_at", F.col("_group").asc_nulls_last(), "_tree").mapInArrow(
        _summer(inputs, holders == 1), f"{kinds}, _holder int, _sums array<double>")
    # Added in the order of the groups, so the last digit does not depend on which task ends first.
    ordered = parts.groupBy(F.struct(*inputs).alias("_row")).agg(F.array_sort(F.collect_list(F.struct("_holder", "_sums"))).alias("_s"))
    total = F.aggregate(F.flatten(F.col("_s._sums")), F.lit(0.0), lambda a, s: a + s)
    means = ordered.select("_row", F.try_divide(total, F.lit(known["trees"])).alias(name))
    return placed.drop(name).join(means, "_row", "left").drop("_row")


def forest_importances(forest: Forest) -> DataFrame:
    """(feature, importance): each attribute's mean share of the gain; the shares add up to 1."""
    each = forest.table.select(F.posexplode("importance").alias("at", "share")).groupBy("at").agg(F.avg("share").alias("share"))
    total = F.sum("share").over(Window.partitionBy(F.lit(0)))  # one row per attribute
    name = F.get(F.array(*[F.lit(f) for f in forest.features]), F.col("at"))
    return each.select(name.alias("feature"), F.when(total > 0, F.col("share") / total).otherwise(0.0).alias("importance"))
