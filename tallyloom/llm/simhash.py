"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``radius`` bits of each other are within ``t_i`` bits in at least one part i, whatever the parts,
if the sum of the (t_i + 1) is radius + 1. Correlated bits are put into the same part, and the thresholds, which may
differ and may leave a part out, are chosen by dynamic programming on the expected number of probes and candidates. A
fingerprint is filed under its own bits of every part and probes the keys within t_i of them; candidates are verified.

A key with more than ``CROWD`` members is not paired: its members take the exact way for crowds instead. Each of them is
filed under all 2,081 words within two bits of it; two fingerprints share such a word if and only if they are within four
bits, so all members of a word are linked to the smallest of them, without pairs. Every link is found: it lies either
in a small key, or both ends are in a crowd.

Work is on distinct fingerprints, so any number of exact copies is one row. Null and empty texts, and those without
words, have fingerprint zero and are linked like others. Rows with a null id belong to a component but never name it.
"""

from __future__ import annotations

import math
import re
import sys
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.graph import components
from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
CROWD = 256
CHUNK = 1 << 15
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included."""
    import xxhash

    words = _WORDS.findall((text or "").encode().lower())  # bytes: only A to Z change
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): one row per document."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["key"], T.StructField("fp", T.LongType(), False)])

    def batches(source):
        for batch in source:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=["key", "fp"])

    return source.mapInArrow(batches, schema)


def bit_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64 counts of fingerprints that have both bits set; each task sends one table of fixed size."""
    def batches(source):
        both = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in source:
            words = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            for at in range(0, len(words), CHUNK):
                bits = np.unpackbits(words[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
        if both.any():
            i, j = np.nonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(both[i, j])], names=["i", "j", "n"])

    out = np.zeros((BITS, BITS))
    for row in fps.select("fp").mapInArrow(batches, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[row["i"], row["j"]] = row["n"]  # at most 64 x 64 rows
    return out


def grouped_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, the most correlated together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, -1.0)
    free, out = set(range(BITS)), []
    for i in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - i)
        rest = sorted(free)
        sub = strength[np.ix_(rest, rest)]
        group = [rest[int(np.unravel_index(np.argmax(sub), sub.shape)[0])]]
        while len(group) < size:
            others = [b for b in rest if b not in group]
            group.append(max(others, key=lambda b: (strength[b, group].sum(), -b)))
        out.append(sorted(group))
        free -= set(group)
    return out


def thresholds(groups: list[list[int]], p: np.ndarray, n: int, radius: int) -> tuple[float, list[int]]:
    """(expected rows, threshold per group, -1 for a group left out), the best whose (t + 1) sum to radius + 1."""
    def cost(group: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        near = np.zeros(t + 1)  # chance of 0 .. t differing bits, taken one bit after another
        near[0] = 1.0
        for bit in group:
            d = 2 * p[bit] * (1 - p[bit])
            near = near * (1 - d) + np.concatenate([[0.0], near[:-1]]) * d
        return n * (1 + sum(math.comb(len(group), k) for k in range(t + 1)) / 2) + n * n * near.sum() / 2

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t in range(-1, radius + 1 - used):
                if t < len(group):
                    total = so_far + cost(group, t)
                    if used + t + 1 not in nxt or total < nxt[used + t + 1][0]:
                        nxt[used + t + 1] = (total, [*chosen, t])
        best = nxt
    return best[radius + 1]


def allocation(both: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] with the fewest expected rows over all numbers of parts."""
    p = np.diag(both) / max(n, 1)
    tried = []
    for parts in range(2, radius + 2):
        groups = grouped_bits(both, n, parts)
        rows, chosen = thresholds(groups, p, n, radius)
        tried.append((rows, [(g, t) for g, t in zip(groups, chosen) if t >= 0]))
    return min(tried, key=lambda x: x[0])[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def members(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(at, fp): each fingerprint under its own key of every part and under those it probes.

    Of two fingerprints one probes the other: the one whose lowest differing bit in the part is 0. ``at`` is a hash of part
    and key; keys that share a hash only make more candidates, which are verified.
    """
    rows = []
    for i, (bits, t) in enumerate(parts):
        mask = sum(1 << b for b in bits)
        for k in range(t + 1):
            for flip in combinations(bits, k):
                rows.append((i, mask, sum(1 << b for b in flip), 1 << flip[0] if flip else 0))
    probes = F.expr("array(" + ",".join(f"struct({i} as part, {_signed(m)}L as mask, {_signed(f)}L as flip, {_signed(low)}L as low)"
                                        .replace("-9223372036854775808L", "(-9223372036854775807L - 1L)") for i, m, f, low in rows) + ")")
    one = fps.select("fp", F.explode(probes).alias("p")).filter(F.col("fp").bitwiseAND(F.col("p.low")) == 0)
    return one.select(F.xxhash64("p.part", F.col("fp").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip"))).alias("at"), "fp")


def _near_pairs(radius: int, crowd: int):
    """(a, b) within ``radius`` bits among the members of each key of a partition sorted by key; (fp, null) per crowd member.

    At most ``crowd`` members of a key that goes on in the next batch are held.
    """
    def found(key: np.ndarray, fp: np.ndarray, in_crowd: np.ndarray):
        a, b = [fp[in_crowd]], [np.zeros(int(in_crowd.sum()), dtype=np.int64)]
        key, fp = key[~in_crowd], fp[~in_crowd]
        for k in range(1, crowd):  # members k places apart
            same = np.flatnonzero(key[:-k] == key[k:])
            if not len(same):
                break
            x, y = fp[same], fp[same + k]
            near = (np.bitwise_count((x ^ y).view(np.uint64)) <= radius) & (x != y)
            a.append(np.maximum(x, y)[near])
            b.append(np.minimum(x, y)[near])
        first, second = np.concatenate(a), np.concatenate(b)
        alone = np.arange(len(first)) < len(a[0])
        return pa.RecordBatch.from_arrays([pa.array(first), pa.array(second, mask=alone)], names=["a", "b"])

    def batches(source):
        key, fp, crowded = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in source:
            key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(key):
                continue
            starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            sizes = np.diff(np.append(starts, len(key)))
            many = (sizes > crowd) | (key[starts] == crowded if crowded is not None else False)
            if many[-1]:  # a known crowd need not be held
                crowded, cut = key[-1], len(key)
            else:
                crowded, cut = None, starts[-1]
            yield found(key[:cut], fp[:cut], np.repeat(many, sizes)[:cut])
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield found(key, fp, np.zeros(len(key), dtype=bool))

    return batches


def crowd_links(fps: DataFrame) -> DataFrame:
    """Links that connect all fingerprints within four bits of each other, by the words halfway between them."""
    flips = [0, *(1 << b for b in range(BITS)), *((1 << a) | (1 << b) for a, b in combinations(range(BITS), 2))]
    flips = F.expr("split('" + ",".join(str(_signed(x)) for x in flips) + "', ',')").cast("array<bigint>")
    near = fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    first = near.groupBy("mid").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).filter("least < most").drop("most")
    return near.join(first, "mid").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all those within ``radius`` bits."""
    n = fps.count()
    filed = members(fps, allocation(bit_counts(fps), n, radius))
    found = cut_lineage(filed.repartition("at").sortWithinPartitions("at", "fp").mapInArrow(_near_pairs(radius, crowd), "a long, b long"))
    pairs, dense = found.filter("b is not null"), found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    if not dense.limit(1).count():
        return pairs
    if radius != 4:
        raise ValueError("the way for crowds is made for a radius of 4")
    return pairs.unionByName(crowd_links(cut_lineage(dense)))


def rooted_groups(marked: DataFrame, least: Column, radius: int = RADIUS) -> DataFrame:
    """(fp, least, root) per distinct fingerprint: the smallest value of its rows and the name of its component."""
    fps = cut_lineage(marked.groupBy("fp").agg(F.min(least).alias("least")))
    roots = components(links(fps.select("fp"), radius))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component) per distinct fingerprint of (key, fp): the smallest key that can be reached."""
    rooted = rooted_groups(marked, F.col("key"), radius)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(smallest, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fp, component): one row per document."""
    marked = cut_lineage(fingerprints(docs, key, text, shingle))
    return marked.join(classes(marked, radius), "fp", "left").select("key", "fp", "component")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Exactly one row of each component stays: that with the smallest id (nulls last), then text hash, then other columns.

    Rows with the same id and different texts are different documents, and so are rows without an id. Same columns; rows
    equal in all of them count once. The choice does not depend on the order or place of the rows.
    """
    name = "kept"
    while name in docs.columns:
        name += "_"
    body = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (key, text)], F.col(text).isNull().alias("no text"))))
    of_row = F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("none")), body, rest)
    source = docs.select(F.col(key).alias("key"), body.alias("body"), of_row.alias("name"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*[source.schema[c] for c in ("key", "body", "name")], T.StructField("fp", T.LongType(), False)])

    def batches(source):
        for batch in source:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(made, pa.int64())], names=["key", "body", "name", "fp"])

    rows = cut_lineage(source.mapInArrow(batches, schema))
    order = F.struct(F.col("key").isNull().alias("unnamed"), "key", "body", "name")
    first = rooted_groups(rows, order, radius).groupBy("root").agg(F.min("least").alias("first"))
    chosen = rows.join(first.select("first.name"), "name", "left_semi").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    chosen = cut_lineage(chosen.withColumnRenamed("name", name))
    named = docs.withColumn(name, of_row)
    # Only rows that are repeated in full have to be brought together.
    once = named.join(chosen.filter("n = 1").select(name), name, "left_semi")
    repeated = named.join(chosen.filter("n > 1").select(name), name, "left_semi").dropDuplicates([name])
    return once.unionByName(repeated).drop(name)


def op6_simhash(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint and its component."""
    return near_duplicates(docs).select(F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        F.col("component").alias("component_id"))
