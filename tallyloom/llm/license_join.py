"""License scans by an exact set-similarity join of text blocks with license templates; built-in functions only.

All texts are cut into blocks that overlap by half, so that every run of words as long as a template lies whole in a block.
A block holds a license if it contains nine tenths or more of the template's distinct words. Template words are ordered by
their frequency in the whole corpus, rarest first. A block that reaches the threshold must hold one of the first words of the
template in that order (prefix filter), enough template words at all (length filter), and enough of them before and after
the shared one (positional filter); what is left is verified by intersection. No pair at or above the threshold is missed.

Only texts with a prefix word are cut into blocks, and only template words are placed in them, so the shuffled rows are few
and short; the templates are a fixed list (or the caller's), so their tables may be broadcast.

Beside this, fixed phrases are found at all places where their words stand in a row.

Defined results: a null or empty text has no words, places or labels, and score 0. Rows with the same id and text have the
same result, each in a row of its own; rows with a null id or a repeated id and other texts are documents of their own. Texts
are read whole. Labels are sorted, so ties need no order. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import empty_array, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all ASCII but digits and letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Least containment as a fraction, and the least number of words that a block advances by.
REACHED, OF, LEAST_SPAN = 9, 10, 8

# Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Public license notices, a label and its wording.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    """The words of a text, A to Z in lower case."""
    return F.array_remove(F.split(F.translate(text_of(text), UPPER, LOWER), GAPS), "")


def read_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, name, words): the name stands for all rows with the same id and text."""
    body = text_of(F.col(text).cast("string"))
    return docs.select(F.col(key).alias("id"), F.concat_ws("/", F.col(key).cast("string"), F.md5(body)).alias("name"), words_of(body).alias("words"))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, label, words, span): distinct words of each template, and its length as a power of two."""
    made = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(body).alias("body")) for i, (label, body) in enumerate(templates)]
    rows = spark.range(1).select(F.inline(F.array(*made)))
    words = words_of(F.col("body"))
    span = F.greatest(F.lit(LEAST_SPAN), F.pow(2, F.ceil(F.log2(F.size(words).cast("double"))))).cast("int")
    return rows.select("template", "label", F.array_distinct(words).alias("words"), span.alias("span")).filter(F.size("words") > 0)


def word_order(rows: DataFrame, table: DataFrame) -> DataFrame:
    """(word, rank): the words of all templates, those rarest in the corpus first."""
    vocabulary = table.select(F.explode("words").alias("word")).distinct()
    found = rows.select(F.explode_outer("words").alias("word")).join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # As many rows as the templates have words, whatever the corpus holds.
    rank = F.row_number().over(Window.orderBy(F.coalesce(F.col("n"), F.lit(0)), "word"))
    return written(vocabulary.join(found, "word", "left").select("word", rank.alias("rank")))


def _least(size: Column) -> Column:
    """Words that must be shared with a template of that many words."""
    return F.floor((size * REACHED + (OF - 1)) / OF).cast("int")


def template_prefixes(table: DataFrame, order: DataFrame) -> DataFrame:
    """(template, label, span, ranks, size, least, place, rank): a row for each prefix word of each template."""
    ranked = table.select("template", "label", "span", F.explode("words").alias("word")).join(F.broadcast(order), "word")
    sets = ranked.groupBy("template", "label", "span").agg(F.array_sort(F.collect_set("rank")).alias("ranks"))
    sized = sets.withColumn("size", F.size("ranks")).withColumn("least", _least(F.col("size")))
    return sized.select("*", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - F.col("least") + 1)).alias("place", "rank"))


def license_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(name, label, template, first_word, n_words, containment): every block that reaches the threshold of a template."""
    return _matches(read_words(docs, key, text), template_table(docs.sparkSession, templates))


def _matches(rows: DataFrame, table: DataFrame) -> DataFrame:
    c = F.col
    order = word_order(rows, table)
    prefixes = template_prefixes(table, order)
    first_words = prefixes.join(order, "rank").agg(F.collect_set("word")).scalar()
    placed = (rows.filter(F.arrays_overlap("words", F.coalesce(first_words, empty_array("string"))))
              .select("name", F.posexplode_outer("words").alias("at", "word")).join(F.broadcast(order), "word"))
    # A word lies in the block that starts at or before it and, as blocks overlap by half, in the one before.
    held = F.flatten(F.transform("spans", lambda s: F.array(
        F.struct(s.alias("span"), F.floor(c("at") / s).cast("int").alias("block")),
        F.struct(s.alias("span"), F.floor(c("at") / s).cast("int") - F.lit(1)).cast("struct<span:int,block:int>"))))
    spans = table.agg(F.collect_set("span")).scalar()
    cells = placed.withColumn("spans", spans).select("name", "rank", F.inline(held)).filter("block >= 0")
    blocks = cells.groupBy("name", "span", "block").agg(F.array_sort(F.collect_set("rank")).alias("held"))
    probes = blocks.select("*", F.size("held").alias("n_held"), F.posexplode("held").alias("q", "rank"))
    reach = F.least(c("place"), c("q")) + 1 + F.least(c("size") - c("place"), c("n_held") - c("q")) - 1
    met = probes.join(F.broadcast(prefixes), ["span", "rank"]).filter((c("n_held") >= c("least")) & (reach >= c("least")))
    once = met.select("name", "span", "block", "template", "label", "held", "ranks", "size", "least").distinct()
    shared = once.withColumn("shared", F.size(F.array_intersect("held", "ranks"))).filter(c("shared") >= c("least"))
    return shared.select("name", "label", "template", (c("block") * c("span")).cast("long").alias("first_word"),
                         (c("span") * 2).alias("n_words"), (c("shared") / c("size")).alias("containment"))


def _phrase_places(words: Column) -> dict[str, dict[str, Column]]:
    """Places of each phrase in `` word word ``: their number, the first and the last start."""
    found = {}
    for phrase, label in PHRASES:
        parts = F.split(words, rf"(?<=\x20){phrase}(?=\x20)")

        def between(part: Column) -> Column:
            return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) - 1).cast("long")

        held = words.contains(f" {phrase} ")
        total = between(words)
        found[label] = {
            "n": F.when(held, F.size(parts) - 1).otherwise(0).cast("long"),
            "first": F.when(held, between(F.get(parts, F.lit(0)))),
            "last": F.when(held, total - between(F.element_at(parts, -1)) - len(phrase.split())),
        }
    return found


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document with its phrase places, the labels of phrases and templates, and the greatest containment."""
    rows = read_words(docs, key, text)
    found = _matches(rows, template_table(docs.sparkSession, templates)).groupBy("name").agg(
        F.collect_set("label").alias("labels"), F.max("containment").alias("containment"))
    spaced = rows.select("id", "name", F.size("words").cast("long").alias("n_words"), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("line"))
    places = _phrase_places(F.col("line"))
    n_base = sum((p["n"] for p in places.values()), F.lit(0).cast("long"))
    base = F.array_sort(F.array_compact(F.array(*[F.when(p["n"] > 0, F.lit(label)) for label, p in places.items()])))
    based = spaced.select("id", "name", "n_words", n_base.alias("n_base"), F.least(*[p["first"] for p in places.values()]).alias("first_word"),
                          F.greatest(*[p["last"] for p in places.values()]).alias("last_word"), base.alias("base"))
    both = F.array_sort(F.array_union("base", F.coalesce("labels", empty_array("string"))))
    score = F.greatest(F.coalesce("containment", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return based.join(found, "name", "left").select(
        F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"), score.alias("score"))


def op13_license_scans(docs: DataFrame) -> DataFrame:
    return scan(docs)


def _rows(pairs: Sequence[tuple[str, str]]) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in pair) + ")" for pair in pairs)


#: Every block against every template, without any filter.
OP13_SQL = rf"""
WITH phrases(phrase, label) AS (VALUES {_rows(PHRASES)}),
templates(label, body) AS (VALUES {_rows(TEMPLATES)}),
read AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
  SELECT doc_id, label, i - 1 AS pos FROM (
    SELECT doc_id, words, label, string_split(phrase, ' ') AS p, unnest(range(1, len(words) + 1)) AS i
    FROM read, phrases WHERE contains(' ' || array_to_string(words, ' ') || ' ', ' ' || phrase || ' '))
  WHERE words[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id),
parts AS (SELECT row_number() OVER () AS template, label, regexp_extract_all(translate(body, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM templates),
wanted AS (
  SELECT DISTINCT template, label, len(list_distinct(words)) AS size, greatest({LEAST_SPAN}, pow(2, ceil(log2(len(words)))))::BIGINT AS span, unnest(words) AS word
  FROM parts),
spread AS (SELECT doc_id, unnest(range(0, len(words))) AS pos, unnest(words) AS word FROM read),
held AS (
  SELECT DISTINCT doc_id, template, label, size, word, unnest([pos // span, pos // span - 1]) AS block FROM spread JOIN wanted USING (word)),
shared AS (SELECT doc_id, template, label, size, block, count(DISTINCT word) AS n FROM held WHERE block >= 0 GROUP BY ALL),
matched AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(n::DOUBLE / size) AS containment FROM shared WHERE {OF} * n >= {REACHED} * size GROUP BY doc_id)
SELECT r.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       greatest(coalesce(containment, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END)::DOUBLE AS score
FROM read r LEFT JOIN base b USING (doc_id) LEFT JOIN matched m USING (doc_id)
"""
