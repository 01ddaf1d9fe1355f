"""How filters interact: what each of five filters removes at each step of each of their 120 orders.

A document is reduced to the set of filters it fails, a mask of five bits. Only the counts per part and mask go on, at most
32 cells a part; each cell is folded across the array of all orders, which gives 600 weighted steps, and the steps of the
cells of a part are summed element by element. The cost after the one pass over the texts does not depend on their number.

Defined results: a null text is empty; a null part is the empty string. A row without an id has no smaller id, so it never
fails E; rows with the same id and text are no copies of each other. A document with several labels counts as good or
toxic where one of them says so. An empty table gives no rows. Texts are read whole whatever their length. Other columns
are not read, so their names do not matter.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def text_failures(text: Column) -> dict[str, Column]:
    """The failure condition of each filter that a text alone decides."""
    words = F.array_remove(F.split(text, BLANKS), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def document_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask, n): equal rows as one with their number; bit i is set where the i-th of ``FILTERS`` fails.

    A text is E if it is not the one with the smallest id among equal texts. Texts are compared by SHA-256. Rows meet the
    smallest id under (text, id), not under the text alone, so a crowd of copies is spread over all tasks.
    """
    found = text_failures(F.col("text"))
    mask = sum((F.when(fails, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0)) for name, fails in found.items()), F.lit(0))
    read = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of(F.col(text).cast("string")).alias("text"))
    rows = written(read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
                   .groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = rows.groupBy("digest").agg(F.min("id").alias("first")).withColumnRenamed("digest", "of")
    marked = rows.join(first, (F.col("digest") == F.col("of")) & (F.col("id") == F.col("first")), "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copy, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    return marked.select("id", "part", mask.alias("mask"), "n").groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))


def mask_cells(masks: DataFrame, labels: DataFrame, key: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, docs, good, toxic): the documents of each part that fail exactly these filters, and their labels."""
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max((F.col(good) == 1).cast("int")).alias("good"), F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))

    def weight(name: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(F.col(name), F.lit(0))).alias(name)

    return masks.join(marks, "id", "left").groupBy("part", "mask").agg(F.sum("n").alias("docs"), weight("good"), weight("toxic"))


def folded(mask: Column, docs: Column, good: Column, toxic: Column) -> Column:
    """What the documents of one cell add to each step of each order: 600 structs of ``COUNTS``, order by order."""
    orders = F.array(*[F.array(*[F.lit(1 << FILTERS.index(c)) for c in order]) for order in ORDERS])

    def step(acc: Column, bit: Column) -> Column:
        fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(acc["seen"]) != 0
        shares = ((~fails & ~gone, docs), (fails & ~gone, docs), (fails & gone, docs), (mask == bit, docs), (fails & ~gone, good), (fails & ~gone, toxic))
        row = F.struct(*[F.when(held, n).otherwise(F.lit(0)).cast("bigint").alias(c) for c, (held, n) in zip(COUNTS, shares)])
        return F.struct((acc["seen"] + bit).alias("seen"), F.concat(acc["steps"], F.array(row)).alias("steps"))

    start = F.struct(F.lit(0).alias("seen"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda acc: acc["steps"])))


def order_steps(cells: DataFrame) -> DataFrame:
    """(part, filter_order, step, filter, *COUNTS, shapley): one row per part, order and step, zeros included."""
    def added(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))

    c = F.col
    steps = cells.select("part", folded(c("mask"), c("docs"), c("good"), c("toxic")).alias("steps"))
    none = F.array_repeat(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in COUNTS]), len(ORDERS) * len(FILTERS))
    # A part has at most 32 cells, so the gathered arrays are bounded.
    merged = steps.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", F.aggregate("cells", none, added).alias("steps"))
    rows = merged.select("part", F.posexplode("steps").alias("at", "counts"))
    names, size = F.array(*[F.lit(o) for o in ORDERS]), len(FILTERS)
    placed = rows.select("part", F.get(names, F.floor(c("at") / size).cast("int")).alias("filter_order"),
                         (c("at") % size + 1).cast("int").alias("step"), "counts.*")
    placed = placed.withColumn("filter", F.substring("filter_order", c("step"), F.lit(1)))
    return placed.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The steps of all orders over all documents; see ``order_steps``."""
    return order_steps(mask_cells(document_masks(docs, key, text, part), labels, key))


def op11_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(docs, labels).select("part", "filter_order", "step", *COUNTS, "shapley")


OP11_SQL = r"""
WITH read AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM read GROUP BY t),
failed AS (
  SELECT part, doc_id,
         (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(doc_id > first, false)::INT AS e
  FROM read JOIN firsts USING (t)),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS docs, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
orders AS (
  SELECT [p.x, q.x, r.x, s.x, u.x] AS o FROM letters p, letters q, letters r, letters s, letters u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (
  SELECT part, array_to_string(list_transform(o, lambda i: chr(64 + i::INT)), '') AS filter_order, k.x AS step, o[k.x] AS f, docs, good, toxic,
         fails[o[k.x]] = 1 AS fails_it, list_sum(fails) = 1 AS alone,
         len(list_filter(o[1:k.x - 1], lambda i: fails[i] = 1)) > 0 AS gone
  FROM cells, orders, letters k),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fails_it AND NOT gone THEN docs ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails_it AND NOT gone THEN docs ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails_it AND gone THEN docs ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails_it AND alone THEN docs ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fails_it AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fails_it AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
