"""Best-fit packing by exact complements.

A task turns each whole text into token ids and cuts longer documents into pieces of one sequence; only lengths and
checksums leave it. The plan is then made on the histogram of lengths, which has at most one entry per length: sums of
one, two and three lengths are indexed, combinations that fill the gap of a long piece exactly are consumed as far as
the counts go, and what stays is placed best-fit, longest first. So the plan's size depends on the sequence length alone.
Pieces are numbered within their length and meet their place in the plan by a range of numbers.

Null and empty texts have the end mark alone. Repeated rows are packed each. Other columns are not carried.
"""

from __future__ import annotations

import re
import sys
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import ranked
from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.tiktoken"  # the same vocabulary as byte_bpe_50k.json, as ranks
ADDED_IN = "byte_bpe_50k.json"  # its added tokens match in plain text, as in tokenizers with the file as loaded
CACHED_WORDS = 300_000
_APART = re.compile(r"\s \s")


class Encoder:
    """Ids of a text without added tokens as little-endian unsigned 32-bit bytes.

    The tokenizer splits before a blank that a visible character follows, so words are encoded one by one and remembered;
    a text in which a single blank stands among other white space is encoded whole.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def _fresh(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if _APART.search(text):
            return self._fresh(text)
        first, *rest = text.split(" ")
        known, out = self.known, [self._fresh(first)]
        if len(known) > CACHED_WORDS:  # forget all: memory stays bounded, results are the same
            known.clear()
        for word in rest:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = self._fresh(" " + word)
            out.append(ids)
        return b"".join(out)


class WholeEncoder(Encoder):
    """Ids of any text: it is cut at the added tokens, which have ids of their own, and the parts are encoded alone."""

    def __init__(self, vocabulary: str, added_in: str = ADDED_IN):
        import json

        import public_tokenizers

        super().__init__(vocabulary)
        with open(public_tokenizers.path(added_in), encoding="utf-8") as whole:
            added = json.load(whole).get("added_tokens", [])
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that depend on the text around them are not supported")
        self.added = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def __call__(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return super().__call__(text)
        encode = super().__call__
        return b"".join(self.added[part] if i % 2 else encode(part) for i, part in enumerate(self.cut.split(text)) if part)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(key, piece, start, length, ids_crc32): every document as pieces of at most ``capacity`` ids.

    Only the first piece of a document may be shorter than ``capacity``.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["key"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    stop = np.array([end], dtype="<u4").tobytes()

    def batches(source):
        encode = WholeEncoder(vocabulary)
        for batch in source:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + stop
                n = len(ids) // 4
                at, size = 0, n % capacity or capacity
                size, k = min(size, n), 0
                while at < n:
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(memoryview(ids)[4 * at:4 * (at + size)]))
                    at, size, k = at + size, capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["key", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(batches, schema)


class _Lengths:
    """Which lengths are left and how many of each, with an index of the sums of two of them."""

    def __init__(self, counts: dict[int, int], most: int):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.sorted = sorted(self.left)
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        for a in reversed(self.sorted):
            for b in self.sorted:
                if b > a or a + b > most:
                    break
                self.pairs.setdefault(a + b, []).append((a, b))

    def take(self, combination: list[int], times: int) -> None:
        for n in combination:
            self.left[n] -= times
        for n in set(combination):
            if not self.left[n]:
                del self.left[n]
                self.sorted.remove(n)

    def times(self, combination: list[int]) -> int:
        """How often the combination can be taken."""
        return min(self.left.get(n, 0) // combination.count(n) for n in set(combination))

    def fills(self, gap: int):
        """Combinations of one, two and three lengths that sum to ``gap``, those with a large part first."""
        yield [gap]
        for pair in self.pairs.get(gap, ()):
            yield [*pair]
        for a in [n for n in reversed(self.sorted) if n < gap]:
            for b, c in self.pairs.get(gap - a, ()):
                if b <= a:
                    yield [a, b, c]

    def best_fit(self) -> list[int]:
        """The longest piece, then again and again the longest that still fits."""
        whole, at, room = [], len(self.sorted) - 1, self.room
        while at >= 0:
            n = self.sorted[at]
            k = min(room // n, self.left[n])
            whole += [n] * k
            room -= k * n
            at = min(at, bisect_right(self.sorted, room)) - 1
        return whole

    room = 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, how many such sequences)]: all pieces, each sequence at most ``capacity`` long.

    First exact fills, by longest piece; then best-fit for what is left: bins of equal content are one entry with a count.
    """
    lengths, out = _Lengths(counts, capacity), []
    lengths.room = capacity

    def use(whole: list[int], times: int) -> None:
        out.append((whole, times))
        lengths.take(whole, times)

    if capacity in lengths.left:
        use([capacity], lengths.left[capacity])
    for longest in sorted(lengths.left, reverse=True):
        if longest not in lengths.left:
            continue
        for rest in lengths.fills(capacity - longest):
            if all(n in lengths.left for n in rest) and (times := lengths.times([longest, *rest])):
                use([longest, *rest], times)
                if longest not in lengths.left:
                    break
    while lengths.left:
        whole = lengths.best_fit()
        use(whole, lengths.times(whole))
    return out


def places(made: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, last number, first sequence, offset): numbers of pieces of a length, in order."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for whole, times in made:
        at = 0
        for n in whole:
            first = used.get(n, 0)
            out.append((n, first, first + times - 1, sequence, at))
            used[n] = first + times
            at += n
        sequence += times
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (key, piece, length, ...)."""
    spark = cut.sparkSession
    cut = cut_lineage(cut)
    numbered = ranked(cut, ["length", "key", "piece"], "__rank")
    sizes = cut.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in sizes.collect()}  # at most ``capacity`` rows
    before, total = {}, 0
    for n in sorted(counts):
        before[n] = total
        total += counts[n]
    schema = "length long, __first long, __last long, __sequence long, offset long"
    rows = [(n, before[n] + a, before[n] + b, s, o) for n, a, b, s, o in places(plan(counts, capacity))]
    table = spark.createDataFrame(rows, schema)  # as long as the plan: bounded by the capacity, not by the rows
    here = (numbered["length"] == table["length"]) & numbered["__rank"].between(table["__first"], table["__last"])
    return (numbered.join(F.broadcast(table), here).drop(table["length"])
            .withColumn("sequence_id", F.col("__sequence") + F.col("__rank") - F.col("__first"))
            .drop("__rank", "__first", "__last", "__sequence"))


def op9_packing(docs: DataFrame) -> DataFrame:
    """One row per piece: where it comes from, its checksum, and its place in a sequence."""
    packed = pack(pieces(docs))
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
