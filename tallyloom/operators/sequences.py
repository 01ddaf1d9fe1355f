"""Vocabulary ids, prefix sequences, padding and next-word tables over lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import REST, sequence_words
from tallyloom.operators.frames import unnest
from tallyloom.operators.skew import ROWS_PER_TASK, global_rank, hot_keys, running_total, spread_join
from tallyloom.session import cut_lineage


def text_lines(df: DataFrame, keys, text: str = "text") -> DataFrame:
    """One row per line of text: (*keys, line_no, line)."""
    return unnest(df, keys, F.split(text, "\n"), "line", "line_no")


def line_words(lines: DataFrame, keys) -> DataFrame:
    """One row per word: (*keys, pos, word)."""
    return unnest(lines, keys, sequence_words(F.col("line")), "word", "pos")


def vocabulary(lines: DataFrame, keys) -> DataFrame:
    """Word ids from 1 on, by frequency, then by first place in the text: (word, freq, word_id)."""
    words = line_words(lines, keys)
    stats = words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"),
                                      F.min(F.struct(*keys, "pos")).alias("_first"))
    return global_rank(stats, [F.desc("freq"), F.asc("_first")], "word_id").select("word", "freq", "word_id")


def encode_lines(lines: DataFrame, vocab: DataFrame, keys, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each line as an array of word ids; words outside the vocabulary are left out: (*keys, ids)."""
    words = line_words(lines, keys)
    hot = hot_keys(vocab, "word", rows_per_task, weight="freq")
    coded = spread_join(words, vocab.select("word", "word_id"), "word", hot, spread_by=[*keys, "pos"])
    ordered = coded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "word_id"))).alias("_w"))
    return ordered.select(*keys, F.col("_w.word_id").alias("ids"))


def prefix_sequences(encoded: DataFrame, keys, ids: str = "ids") -> DataFrame:
    """All beginnings of two or more ids of each line: (*keys, size, seq)."""
    long_enough = encoded.filter(F.size(ids) >= 2)
    sizes = long_enough.select(*keys, ids, F.explode(F.sequence(F.lit(2), F.size(ids))).alias("size"))
    return sizes.select(*keys, "size", F.slice(ids, F.lit(1), F.col("size")).alias("seq"))


def pad_left(seqs: DataFrame, seq: str = "seq", length: Column | None = None) -> DataFrame:
    """Fill with zeros on the left to the longest size; the last id becomes the target: adds ``x`` and ``y``.

    The target stays one number, the index of the class. Pass ``length`` where the longest size is known.
    """
    if length is None:
        length = seqs.agg(F.max(F.size(seq))).scalar()
    filled = seqs.withColumn("_m", length)
    padded = F.concat(F.array_repeat(F.lit(0), F.col("_m") - F.size(seq)), F.col(seq))
    return (filled.withColumn("x", F.slice(padded, F.lit(1), F.col("_m") - 1))
            .withColumn("y", F.element_at(seq, -1)).drop("_m"))


def ragged_sequences(encoded: DataFrame, keys, ids: str = "ids") -> DataFrame:
    """Lines with two or more ids, each stored once: (*keys, ids, n_prefixes, first), kept.

    ``first`` counts the beginnings of all lines before, so beginning number n of the whole table is found by a filter. What is
    written grows with the words; a long line changes nothing in the rows of the others.
    """
    lines = encoded.filter(F.size(ids) >= 2).select(*keys, F.col(ids).alias("ids"), (F.size(ids) - 1).cast("long").alias("n_prefixes"))
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A fixed number of partitions: lines are few bytes, but their beginnings are many rows, so they must stay spread out.
    return cut_lineage(running_total(lines, keys, "n_prefixes", "first").repartition(parts, *keys))


def prefix_views(ragged: DataFrame, keys, start: int = 0, stop: int | None = None) -> DataFrame:
    """Beginnings ``start`` to ``stop`` (exclusive) of the whole table, or all: (*keys, number, size, seq), cut when they are read."""
    wanted, low, high = ragged, F.lit(2), F.size("ids")
    if start:
        wanted = wanted.filter(F.col("first") + F.col("n_prefixes") > start)
        low = F.greatest(low.cast("long"), F.lit(start) - F.col("first") + 2).cast("int")
    if stop is not None:
        wanted = wanted.filter(F.col("first") < stop)
        high = F.least(high.cast("long"), F.lit(stop) - F.col("first") + 1).cast("int")
    sizes = wanted.filter(low <= high).select(*keys, "ids", "first", F.explode(F.sequence(low, high)).alias("size"))
    return sizes.select(*keys, (F.col("first") + F.col("size") - 2).alias("number"), "size", F.slice("ids", F.lit(1), F.col("size")).alias("seq"))


def padded_views(ragged: DataFrame, keys, start: int = 0, stop: int | None = None, length: Column | None = None) -> DataFrame:
    """The same beginnings filled with zeros on the left to the longest line of the whole table, last id as target."""
    if length is None:
        length = ragged.agg(F.max(F.size("ids"))).scalar()
    return pad_left(prefix_views(ragged, keys, start, stop), length=length)


def next_word_table(lines: DataFrame, keys) -> DataFrame:
    """Most frequent follower of each word, alphabetical on ties: (word, next_word)."""
    words = sequence_words(F.col("line"))
    shifted = lines.select(words.alias("_w")).select(F.arrays_zip(
        F.col("_w").alias("word"), F.slice("_w", 2, REST).alias("next_word")).alias("_z"))
    pairs = unnest(shifted, [], F.col("_z"), "_p").select("_p.word", "_p.next_word").filter(F.col("next_word").isNotNull())
    counts = pairs.groupBy("word", "next_word").agg(F.count(F.lit(1)).alias("times"))
    rank = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("times"), "next_word"))
    return counts.withColumn("_rank", rank).filter(F.col("_rank") == 1).select("word", "next_word")


def follow_chain(table: DataFrame, k: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The next ``k`` words after each word, found once per distinct word: (word, next_words)."""
    # Each step reads the one before twice (rows and hot keys): both are kept, or the work would double per step.
    table = cut_lineage(table)
    steps = table.select("word", F.array("next_word").alias("next_words"), F.col("next_word").alias("_at"))
    step = table.select(F.col("word").alias("_at"), F.col("next_word").alias("_to"))
    for _ in range(k - 1):
        # Words without a follower end their chain; followers many words lead to are split.
        hot = hot_keys(steps, "_at", rows_per_task)
        joined = spread_join(steps, step, "_at", hot, how="left", spread_by=["word"])
        steps = cut_lineage(joined.select(
            "word",
            F.when(F.col("_to").isNull(), F.col("next_words"))
            .otherwise(F.concat("next_words", F.array("_to"))).alias("next_words"),
            F.col("_to").alias("_at")))
    return steps.select("word", "next_words")


def next_words(seeds: DataFrame, table: DataFrame, k: int, text: str = "seed",
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each seed text continued by up to ``k`` words; seeds without a known last word stay as they are."""
    chain = follow_chain(table, k, rows_per_task)
    last = seeds.withColumn("word", F.try_element_at(sequence_words(F.col(text)), F.lit(-1)))
    hot = hot_keys(last, "word", rows_per_task)
    joined = spread_join(last, chain, "word", hot, how="left")
    return joined.withColumn(
        "continued", F.concat_ws(" ", F.col(text), F.coalesce(F.col("next_words"), F.array().cast("array<string>")))
    ).drop("word", "next_words")
