"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document's expected copies are the target over the source's size. The whole
copies are given, the fraction is rounded: two documents at a time, mass (words) moves from one to the other, in a random
direction that keeps the expectation, until one of them is at no copy or one whole copy. What the last document of a
block is left with goes up a tree of blocks, 256 to one, until a source has a single fraction left. So a source's words
differ from its target by less than one document.

Only DataFrame functions run. Documents are dealt to blocks by a hash of their key, about ``BLOCK`` to a block, so one
large source is many blocks. Equal rows (same source, key and size) are one unit and get the same copies. A null text
has size 0 and is taken zero times; a null source is one source, listed last; a null key is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import empty_array, own, ranked, word_count
from tallyloom.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_BITS, FAN_BITS = 7, 8
UNIT = "key:string,size:bigint,rows:bigint,mass:double"
SEED = 11


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size, ...): one row per source.

    Weights repeat along the sources by code point, null last. The share of all sizes is divided by weight; a target
    stops at ``most`` times its source's size and the excess goes to the others. Each round needs three sums.
    """
    order, weight, cap = own("order", "weight", "cap")
    table = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("__null", F.col("source").isNull().cast("int"))
    rows = cut_lineage(ranked(named, ["__null", "source"], order)
                       .withColumn(weight, F.get(table, (F.col(order) % len(weights)).cast("int")))
                       .withColumn(cap, F.col("source_size") * float(most)))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, before = 0.0, -1
    while True:  # a level per round; sources at their cap only become more
        above = F.col(cap) < F.lit(level) * F.col(weight)
        capped, n, free = rows.agg(F.sum(F.when(above, F.col(cap)).otherwise(0.0)), F.sum(above.cast("long")),
                                   F.sum(F.when(above, 0.0).otherwise(F.col(weight)))).first()
        if n is None or n == before or not free:
            break
        before, level = n, (total - capped) / free
    return rows.select("source", "source_size", *[c for c in sizes.columns if c not in ("source", "source_size")],
                       F.least(F.col(cap), F.lit(level) * F.col(weight)).alias("target"))


def _draw(a: Column, b: Column, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED + level), a, b), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _fold(units: Column, level: int) -> Column:
    """Round the units of a block: (left: the last one with a fraction, done: (key, size, rows, up))."""
    start = F.struct(F.element_at(units, 1).alias("left"),
                     empty_array("struct<key:string,size:bigint,rows:bigint,up:boolean>").alias("done"))

    def decided(x: Column, up: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["size"].alias("size"), x["rows"].alias("rows"), up.alias("up"))

    def holding(x: Column, mass: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["size"].alias("size"), x["rows"].alias("rows"), mass.alias("mass"))

    def step(acc: Column, b: Column) -> Column:
        a, whole = acc["left"], (lambda x: (x["size"] * x["rows"]).cast("double"))
        room_a, room_b = whole(a) - a["mass"], whole(b) - b["mass"]
        to_a, to_b = F.least(room_a, b["mass"]), F.least(a["mass"], room_b)
        gains = _draw(a["key"], b["key"], level) * (to_a + to_b) <= to_b  # the larger the way back, the likelier
        cases = [  # (condition, who is decided, up or not, who stays, with which mass)
            (gains & (room_a <= b["mass"]), a, True, b, b["mass"] - room_a),
            (gains, b, False, a, a["mass"] + b["mass"]),
            (a["mass"] <= room_b, a, False, b, a["mass"] + b["mass"]),
        ]
        left, done = holding(a, a["mass"] - room_b), decided(b, F.lit(True))
        for when, out, up, stays, mass in reversed(cases):
            left = F.when(when, holding(stays, mass)).otherwise(left)
            done = F.when(when, decided(out, F.lit(up))).otherwise(done)
        return F.struct(left.alias("left"), F.concat(acc["done"], F.array(done)).alias("done"))

    return F.aggregate(F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0))), start, step)


def round_copies(units: DataFrame, blocks_of: Column) -> DataFrame:
    """Round (source, key, size, rows, mass) to (source, key, size, rows, up), source by source.

    ``blocks_of``: how many leaf blocks the row's source has (a power of two of the row count, not of the data's skew).
    """
    block, level = "__block", 0
    todo = units.withColumn(block, F.pmod(F.xxhash64(F.lit(SEED), "key", "size"), blocks_of))
    decided = None
    while True:
        unit = F.struct(F.xxhash64(F.lit(SEED + 100), "key", "size").alias("at"), F.struct(
            "key", "size", "rows", "mass").alias("unit"))
        folded = (todo.groupBy("source", block).agg(F.array_sort(F.collect_list(unit)).alias("units"))
                  .select("source", block, _fold(F.transform("units", lambda u: u["unit"]), level).alias("r")))
        folded = cut_lineage(folded.select("source", block, "r.left", "r.done"))
        done = folded.select("source", F.explode("done").alias("d")).select("source", "d.*")
        decided = done if decided is None else decided.unionByName(done)
        if not folded.filter(F.col(block) > 0).limit(1).count():
            break
        todo = folded.select("source", "left.*", F.shiftright(block, FAN_BITS).alias(block))
        level += 1
    last = folded.select("source", "left.*").select(
        "source", "key", "size", "rows", (_draw(F.col("key"), F.lit("last"), 99) * F.col("size") * F.col("rows") < F.col("mass")).alias("up"))
    return decided.unionByName(last)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """One row per distinct (source, key, size): source_size, target, rows (how many such rows), copies of each."""
    sized = docs.select(F.col(source).cast("string").alias("source"), F.col(key).cast("string").alias("key"), word_count(text).alias("size"))
    units = cut_lineage(sized.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("rows")))
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    aims = cut_lineage(targets(sizes, weights, share, most))
    aims = aims.withColumn("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    leaf = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("units").cast("double"))) - BLOCK_BITS)).cast("long")
    joined = units.join(aims.withColumn("leaves", leaf), units["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    part = F.col("copies") - F.floor("copies")
    split = joined.withColumn("part", part).withColumn("mass", F.col("size") * F.col("rows") * part)
    some = split.filter((F.col("size") > 0) & (F.col("part") > 0)).select("source", "key", "size", "rows", "mass", "leaves")
    up = round_copies(some, F.col("leaves")).withColumnRenamed("up", "__up").drop("rows")
    same = [split["source"].eqNullSafe(up["source"]), split["key"].eqNullSafe(up["key"]), split["size"] == up["size"]]
    return split.join(up, same, "left").select(
        split["source"], split["key"], split["size"], split["rows"], split["source_size"], split["target"],
        F.when(split["size"] == 0, F.lit(0)).otherwise(
            F.floor(split["copies"]).cast("int") + F.coalesce(F.col("__up"), F.lit(False)).cast("int")).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix has them: rows left out, once or repeated; same columns."""
    text, source, key = (options.get(k, d) for k, d in (("text", "text"), ("source", "source"), ("key", "doc_id")))
    k, s, n = own("key", "source", "size")
    plan = mix(docs, **options).filter(F.col("copies") > 0).select(
        F.col("key").alias(k), F.col("source").alias(s), F.col("size").alias(n), F.col("copies").alias("__copies"))
    left = docs.withColumns({"__k": F.col(key).cast("string"), "__s": F.col(source).cast("string"), "__n": word_count(text)})
    same = [left["__k"].eqNullSafe(plan[k]), left["__s"].eqNullSafe(plan[s]), left["__n"] == plan[n]]
    return (left.join(plan, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_source_mix(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words the mix takes of it."""
    kind = docs.schema["doc_id"].dataType
    plan = mix(docs.select("doc_id", "text", "source"))
    each = plan.withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select(F.col("key").cast(kind).alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("source"), F.col("copies"))
