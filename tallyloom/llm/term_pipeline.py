"""Ranked lexical search by pipelined term partitioning, with integer scores.

The terms of the queries are dealt to ``OWNERS`` by hash. Queries travel in bundles of ``BUNDLE`` items; a bundle meets the
documents in blocks of ``BLOCK`` rows, and for each block it carries a sparse accumulator, the documents reached so far and
their sums, from owner to owner. An owner is one stage: a cogroup of the bundle, that is its accumulators and its items' terms
that the owner has, with the owner's postings of that block, which adds the contributions. After the last owner each block keeps the best documents of each item
(no other can be among the best of all), and a ranked window takes the best over all blocks.

A task holds ``BUNDLE`` x ``BLOCK`` sums at most, whatever the input, and no key has more rows than a block has documents:
a term that all documents hold is as many postings a block as any block has rows. Sums are 64-bit integers, so neither
the order of the owners nor a repeated task changes a score.

Defined results: a null or empty text has no terms; documents without terms count nowhere. Each row is a document of its
own, also with a repeated or null id, and each item row a query of its own, also with a repeated or null id. Equal scores are
ranked by ascending id, nulls last, then by row. Items without a known term, and empty tables, give no rows.
Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import ranked, text_of, written
from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OWNERS, BUNDLE, BLOCK_BITS = 4, 128, 12
BLOCK = 1 << BLOCK_BITS
TOP = 20
ROWS_AT_ONCE = 1 << 16
ITSELF = -1  # the number of the empty term that every document brings along
CARRIED = "bundle bigint, block bigint, slot smallint, docs binary, sums binary"
BEST = "bundle bigint, block bigint, slot smallint, doc smallint, doc_id bigint, score bigint"


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text_of(text.cast("string")), UPPER, LOWER), GAPS), "")


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(item_id, bundle, slot) of the items, and (term, term_id, owner, bundle, slot, times): how often each item asks for each term."""
    plain = items.select(F.col(key).alias("item_id"), F.col(text).cast("string").alias("text"))
    numbered = written(ranked(plain, ["item_id", "text"], "number").select(
        "item_id", "text", F.floor(F.col("number") / BUNDLE).alias("bundle"), F.pmod("number", F.lit(BUNDLE)).cast("smallint").alias("slot")))
    asked = numbered.select("bundle", "slot", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term", "bundle", "slot").agg(F.count(F.lit(1)).alias("times"))
    numbers = ranked(asked.select("term").distinct(), ["term"], "term_id")
    owner = F.pmod(F.xxhash64("term_id"), F.lit(OWNERS)).cast("int").alias("owner")
    return numbered.drop("text"), written(asked.join(numbers, "term").select("term", "term_id", owner, "bundle", "slot", "times"))


def _counted(source):
    """(row, doc_id, n, term, tf) of each document's terms, and an empty term that stands for the document itself."""
    names, kinds = ["row", "doc_id", "n", "term", "tf"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    out: list[list] = [[] for _ in names]

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
        for c in out:
            c.clear()
        return made

    for rows in source:
        for row, key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2)):
            terms = _TERM.findall((text.as_py() or "").encode().lower())  # bytes: only A to Z change
            if not terms:
                continue
            counts = Counter(terms)
            size = len(counts) + 1
            for column, values in zip(out, ([row] * size, [key] * size, [len(terms)] * size, [b"", *counts], [1, *counts.values()])):
                column += values
            if len(out[0]) >= ROWS_AT_ONCE:
                yield batch()
    if out[0]:
        yield batch()


def postings(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, n, term_id, tf): the query terms of each document, one row each; and (row, doc_id, n): the documents with terms.

    A row's number names its partition and place there, so a block of numbers never has more than ``BLOCK`` documents. Texts
    are read once and counted where they are read; nothing is dealt out. The table is written, which fixes the numbers.
    """
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    itself = docs.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(ITSELF).cast("bigint").alias("term_id"))
    asked = written(terms.select("term", "term_id").distinct().unionByName(itself))
    each = read.mapInArrow(_counted, "row bigint, doc_id bigint, n bigint, term string, tf bigint")
    table = written(each.join(asked, "term").select("row", "doc_id", "n", "term_id", "tf"))
    return table.filter(F.col("term_id") != ITSELF), table.filter(F.col("term_id") == ITSELF).select("row", "doc_id", "n")


def corpus_size(named: DataFrame) -> tuple[int, int]:
    """Documents with a term, and the terms of all documents."""
    found = named.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return int(found[0]), int(found[1])


def contributions(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(owner, block, doc, term_id, part), kept by owner: what one occurrence of the term in a query adds to the document's score."""
    df = found.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.log(F.lit(2.0 * n_docs + 2.0) / (F.col("df") * 2 + 1)) * 1000)
    # A row per query term, kept: Spark knows its size and need not deal out the postings by term, of which some are in all documents.
    weights = written(df.select("term_id", weight.cast("bigint").alias("w")).filter("w > 0"))
    part = F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 12 * (75 + ((25 * n * {n_docs}L) div {max(n_terms, 1)}L))))")
    owner = F.pmod(F.xxhash64("term_id"), F.lit(OWNERS)).cast("int").alias("owner")
    return written(found.join(weights, "term_id").select(owner, _block(), _doc(), "term_id", part.alias("part")), "owner")


def _block() -> Column:
    return F.shiftright("row", BLOCK_BITS).alias("block")


def _doc() -> Column:
    return F.col("row").bitwiseAND(F.lit(BLOCK - 1)).cast("smallint").alias("doc")


def bundles_at(blocks: DataFrame, asked: DataFrame, bundles: int) -> DataFrame:
    """(bundle, block, terms, slots, times): the terms of each bundle's items, for each block. The items are the stated queries."""
    lists = asked.groupBy("bundle").agg(F.collect_list(F.struct("term_id", "slot", "times")).alias("q"))  # at most BUNDLE items
    every = blocks.withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bundles - 1).cast("bigint"))))
    return every.join(lists, "bundle").select("bundle", "block", F.col("q.term_id").alias("terms"), F.col("q.slot").alias("slots"), F.col("q.times").alias("times"))


def directory(documents: DataFrame, bundles: int) -> DataFrame:
    """(bundle, block, named, names): the documents of each block with their ids, for each bundle."""
    of_block = documents.select(_block(), _doc(), "doc_id").groupBy("block").agg(F.collect_list(F.struct("doc", "doc_id")).alias("p"))  # at most BLOCK
    every = of_block.withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bundles - 1).cast("bigint"))))
    return every.select("bundle", "block", F.col("p.doc").alias("named"), F.col("p.doc_id").alias("names"))


def _lists(table: pa.Table, *columns: str):
    """The list columns of the rows that have them, as numpy arrays; nulls in them become 0."""
    for row in np.flatnonzero(table[columns[0]].is_valid().to_numpy()):
        yield [table[c][int(row)].values.fill_null(0).to_numpy(zero_copy_only=False) for c in columns]


def _added(bundle: pa.Table, postings: pa.Table) -> np.ndarray:
    """The sums of a bundle over a block, (slot, document), with the owner's contributions added."""
    sums = np.zeros((BUNDLE, BLOCK), np.int64)
    for row in np.flatnonzero(bundle["slot"].is_valid().to_numpy()):
        docs = np.frombuffer(bundle["docs"][int(row)].as_py(), np.uint16)
        sums[bundle["slot"][int(row)].as_py(), docs] = np.frombuffer(bundle["sums"][int(row)].as_py(), np.int64)
    if not postings.num_rows:
        return sums
    term, doc, part = (postings[c].to_numpy() for c in ("term_id", "doc", "part"))
    order = np.argsort(term, kind="stable")
    term, doc, part = term[order], doc[order], part[order]
    cuts = np.append(np.flatnonzero(np.append(True, np.diff(term) != 0)), len(term))
    for terms, slots, times in _lists(bundle, "terms", "slots", "times"):
        by = np.argsort(terms, kind="stable")
        terms, slots, times = terms[by], slots[by], times[by]
        first, last = np.searchsorted(terms, term[cuts[:-1]]), np.searchsorted(terms, term[cuts[:-1]], side="right")
        for a, b, x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), first.tolist(), last.tolist()):
            if x < y:
                sums[np.ix_(slots[x:y], doc[a:b])] += np.outer(times[x:y], part[a:b])
    return sums


def _add(bundle: pa.Table, postings: pa.Table) -> pa.Table:
    """One owner's stage: the accumulators of a bundle over a block, with its contributions."""
    sums = _added(bundle, postings)
    slots = np.flatnonzero(sums.any(axis=1))
    reached = [np.flatnonzero(sums[s]) for s in slots]
    name, block = ([(bundle if bundle.num_rows else postings)[c][0].as_py()] * len(slots) for c in ("bundle", "block"))
    return pa.table({
        "bundle": pa.array(name, pa.int64()), "block": pa.array(block, pa.int64()), "slot": pa.array(slots, pa.int16()),
        "docs": pa.array([r.astype(np.uint16).tobytes() for r in reached], pa.binary()),
        "sums": pa.array([sums[s, r].tobytes() for s, r in zip(slots, reached)], pa.binary())})


def _select(top: int):
    def best(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        """The last owner's stage, then the best documents of each item in the block."""
        sums = _added(bundle, postings)
        ids, unnamed = np.zeros(BLOCK, np.int64), np.ones(BLOCK, bool)
        for row in np.flatnonzero(bundle["named"].is_valid().to_numpy()):
            docs, names = bundle["named"][int(row)].values.to_numpy(), bundle["names"][int(row)].values
            ids[docs] = names.fill_null(0).to_numpy()
            unnamed[docs] = names.is_null().to_numpy(zero_copy_only=False)
        found = []
        for s in np.flatnonzero(sums.any(axis=1)):
            reached = np.flatnonzero(sums[s])
            order = np.lexsort((reached, ids[reached], unnamed[reached], -sums[s, reached]))[:top]
            found.append(np.stack([np.full(len(order), s), reached[order]]))
        slot, doc = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        name, block = (np.full(len(slot), (bundle if bundle.num_rows else postings)[c][0].as_py()) for c in ("bundle", "block"))
        return pa.table({
            "bundle": pa.array(name, pa.int64()), "block": pa.array(block, pa.int64()), "slot": pa.array(slot, pa.int16()),
            "doc": pa.array(doc, pa.int16()), "doc_id": pa.array(ids[doc], pa.int64(), mask=unnamed[doc]), "score": pa.array(sums[slot, doc], pa.int64())})

    return best


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    numbered, asked = item_terms(items, item_key, item_text)
    found, documents = postings(docs, asked, key, text)
    parts = contributions(found, *corpus_size(documents))
    blocks, bundles = documents.select(_block()).distinct(), int(numbered.agg(F.coalesce(F.max("bundle"), F.lit(0))).first()[0]) + 1
    at = ["bundle", "block"]
    carried = docs.sparkSession.createDataFrame([], CARRIED)
    wide = {"terms": "array<bigint>", "slots": "array<smallint>", "times": "array<bigint>", "named": "array<smallint>", "names": "array<bigint>"}
    for owner in range(OWNERS):
        here = F.col("owner") == owner
        visit = carried.unionByName(bundles_at(blocks, asked.filter(here), bundles), allowMissingColumns=True)
        if owner == OWNERS - 1:
            visit = visit.unionByName(directory(documents, bundles), allowMissingColumns=True)
        visit = visit.select(*carried.columns, *[(F.col(c) if c in visit.columns else F.lit(None)).cast(kind).alias(c) for c, kind in wide.items()])
        wanted = asked.filter(here).select("term_id", "bundle").distinct()
        owned = parts.filter(here).drop("owner").join(wanted, "term_id").select("bundle", "block", "doc", "term_id", "part")
        step = (_add, CARRIED) if owner < OWNERS - 1 else (_select(top), BEST)
        carried = visit.groupBy(*at).cogroup(owned.groupBy(*at)).applyInArrow(*step)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("block"), F.asc("doc")]
    rank = F.row_number().over(Window.partitionBy("bundle", "slot").orderBy(*order))
    return (cut_lineage(carried).withColumn("rank", rank).filter(F.col("rank") <= top).join(numbered, ["bundle", "slot"])
            .select(F.col("item_id").alias(item_key), "rank", F.col("doc_id").alias(key), "score"))


def op12_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


OP12_SQL = rf"""
WITH read AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents),
sizes AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM read WHERE len(terms) > 0),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM read) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * max(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM counts, sizes GROUP BY term),
parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))) AS part
  FROM counts JOIN weights USING (term), sizes),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY ALL),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM placed WHERE rank <= {TOP}
"""
