"""Stupid-backoff scores, computed relationally over tokens of a public vocabulary.

Texts are turned into token ids once (of two bytes: the vocabulary may have up to ``IDS`` entries), which a written
table keeps. Documents are dealt to blocks of about ``BLOCK_DOCS``. A task turns a block into its distinct bigrams with their counts;
the count table, partitioned by a hash of the bigram, is the sum over all blocks, and is joined back to the blocks'
bigrams. A block then meets its part of the count table once more, looks up each document's n-grams and sums their scores.

A document is scored by all others: its own counts are taken off (Brants et al., "Large Language Models in Machine
Translation", 2007, for the scores). A bigram seen elsewhere scores log c(vw) / c(v); otherwise the score backs off to
log 0.4 c(w) / N, and for a token seen nowhere else to log 0.16 / N. The table of single tokens is as long as the
vocabulary, whatever the corpus; it is the only table that is sent to all tasks.

Null and empty texts have no tokens: 0 tokens, sum 0 and a null mean. Repeated rows count as documents of their own.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written
from tallyloom.llm.packing import VOCABULARY, Encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_DOCS = 2048
BACKOFF = 0.4
IDS = 1 << 16
SINGLE = -1  # block number of the table of single tokens


def _bigrams(ids: np.ndarray) -> np.ndarray:
    return ids[:-1].astype(np.int64) * IDS + ids[1:]


def _two_bytes(ids: np.ndarray) -> bytes:
    if len(ids) and ids.max() >= IDS:
        raise ValueError(f"token id {ids.max()} needs more than two bytes; take a vocabulary of up to {IDS} entries")
    return ids.astype("<u2").tobytes()


def _coder(vocabulary: str):
    """Texts as token ids of two bytes."""
    def batches(source):
        encode = Encoder(vocabulary)
        for batch in source:
            ids = [_two_bytes(np.frombuffer(encode(x.as_py() or ""), dtype="<u4")) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["key", "block", "ids"])

    return batches


def _counter():
    """Distinct n-grams of each block of a partition sorted by block; single tokens under the keys below zero."""
    def batches(source):
        block, parts, alone = None, [], []
        single = np.zeros(IDS, dtype=np.int64)

        def table():
            single[:] += np.bincount(np.concatenate(alone), minlength=IDS)
            keys, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block, np.int64)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                                              names=["block", "gram", "n"])

        for batch in source:
            for here, coded in zip(batch.column(0).to_pylist(), batch.column(1)):
                if here != block:
                    if alone:
                        yield table()
                    block, parts, alone = here, [], []
                ids = np.frombuffer(coded.as_py(), dtype="<u2")
                alone.append(ids)
                if len(ids) > 1:
                    parts.append(_bigrams(ids))
        if alone:
            yield table()
        seen = np.flatnonzero(single)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), SINGLE, np.int64)), pa.array(-1 - seen), pa.array(single[seen])], names=["block", "gram", "n"])

    return batches


def document_score(ids: np.ndarray, grams: np.ndarray, totals: np.ndarray, single: np.ndarray, size: int) -> tuple[float, int]:
    """(sum of log scores, bigrams found elsewhere) of one document, its own counts taken off; ``size``: all tokens."""
    n = len(ids)
    if not n:
        return 0.0, 0
    tokens, place, own = np.unique(ids, return_inverse=True, return_counts=True)
    rest = (single[tokens] - own).astype(np.float64)
    others = max(float(size - n), 1.0)
    alone = np.where(rest > 0, np.log(np.maximum(rest, 1.0) / others), np.log(BACKOFF / others))
    score = float(alone[place[0]])
    if n == 1:
        return score, 0
    keys, first, counts = np.unique(_bigrams(ids), return_index=True, return_counts=True)
    left = totals[np.searchsorted(grams, keys)] - counts
    v, w = place[first], place[first + 1]
    seen = left > 0
    each = np.where(seen, np.log(np.maximum(left, 1) / np.maximum(rest[v], 1.0)), np.log(BACKOFF) + alone[w])
    return score + float((each * counts).sum()), int(counts[seen].sum())


def _scorer(single_counts: list[tuple[int, int]]):
    tokens, counts = np.array([t for t, _ in single_counts], np.int64), np.array([c for _, c in single_counts], np.int64)

    def score(docs: pa.Table, table: pa.Table) -> pa.Table:
        single = np.zeros(IDS, dtype=np.int64)
        single[tokens] = counts
        size = int(counts.sum())
        grams, totals = table.column("gram").to_numpy(), table.column("total").to_numpy()
        order = np.argsort(grams)
        grams, totals = grams[order], totals[order]
        rows = []
        for coded in docs.column("ids"):
            ids = np.frombuffer(coded.as_py(), dtype="<u2").astype(np.int64)
            rows.append((len(ids), *document_score(ids, grams, totals, single, size)))
        n, total, found = (list(x) for x in zip(*rows)) if rows else ([], [], [])
        return pa.table({"key": docs.column("key"), "n_tokens": pa.array(n, pa.int64()), "score_sum": pa.array(total, pa.float64()), "n_found": pa.array(found, pa.int64())})

    return score


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(key, n_tokens, score_sum, n_found): one row per document."""
    n = docs.count()
    blocks = max(1, -(-n // block_docs))
    # The row's hash deals it out, so a key that many rows hold is many blocks as long as their texts differ.
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn(
        "block", F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(blocks)))
    kind = docs.schema[key].dataType.simpleString()
    coded = written(rows.select("key", "block", "text").mapInArrow(_coder(vocabulary), f"key {kind}, block long, ids binary"))
    dealt = coded.repartition("block")
    counted = written(dealt.sortWithinPartitions("block").select("block", "ids").mapInArrow(_counter(), "block long, gram long, n long"))
    totals = counted.filter("gram >= 0").groupBy("gram").agg(F.sum("n").alias("total"))
    lookup = counted.filter("gram >= 0").select("block", "gram").join(totals, "gram")
    single = [(-1 - r["gram"], r["n"]) for r in counted.filter("gram < 0").groupBy("gram").agg(F.sum("n").alias("n")).collect()]  # one row per vocabulary entry at most
    schema = f"key {kind}, n_tokens long, score_sum double, n_found long"
    return dealt.groupBy("block").cogroup(lookup.groupBy("block")).applyInArrow(_scorer(single), schema)


def op5_backoff_scores(docs: DataFrame) -> DataFrame:
    """One row per document: tokens, sum and mean of the log scores, bigrams that other documents have."""
    return score(docs).select(F.col("key").alias("doc_id"), "n_tokens", "n_found", "score_sum",
                              F.when(F.col("n_tokens") > 0, F.col("score_sum") / F.col("n_tokens")).alias("score_mean"))
