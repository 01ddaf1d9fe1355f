"""Document fingerprints from closed syncmers.

Words are cut into pieces of up to ``PIECE`` characters. A k-mer of ``K`` pieces is an anchor if the smallest hash among
its ``K - S + 1`` inner s-mers is that of the first or of the last: whether it is depends on the k-mer alone, so equal
passages have equal anchors wherever they stand. The printed fingerprint of a text is the ``KEPT`` smallest distinct anchor
hashes.

Texts are compared by all their anchors and by position: an anchor, the next one and the distance between them are a link,
which does not change when the passage moves, and the likeness of two texts is the Jaccard similarity of their sets of links.
A passage that two texts share has links in both, however long the texts are; anchors that agree by chance at other
distances do not count. Links are kept as 31-bit hashes.

The piece list starts with ``K - 1`` blank pieces, so short texts have as many k-mers as pieces. Where no k-mer is an
anchor, all are. White space does not count. Null, empty and blank texts have an empty fingerprint and no links: two of them
are alike (1), one and a text are not (0). The next document has the next larger id, a null id being the smallest; of rows with
one id the text with the smallest hash stands for it. Texts are read whole. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import let
from tallyloom.llm.common import empty_array, text_of

PIECE, K, S, KEPT = 4, 5, 2, 64
HASH_DROP = 24  # 40 bits of a hash are kept: ten hexadecimal digits
#: Ids are searched for the next one in groups of ids that share all but so many low bits, level by level.
LEVELS = (11, 27, 43)
NO_ID = -(1 << 63)


def pieces(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(found) > 0, F.concat(F.array(*[F.lit("")] * (K - 1)), found)).otherwise(empty_array("string"))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _kmers(text: Column) -> Column:
    """(s0 .. s3): the hashes of the s-mers of every k-mer, in order."""
    def zipped(p: Column) -> Column:
        smers = F.transform(F.arrays_zip(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))).alias("a"), _shifted(p, 1).alias("b")),
                            lambda x: F.xxhash64(x["a"], x["b"]))
        width = K - S + 1

        def windows(h: Column) -> Column:
            n = F.greatest(F.size(h) - (width - 1), F.lit(0))
            return F.arrays_zip(*[F.slice(h, F.lit(i + 1), n).alias(f"s{i}") for i in range(width)])

        return let(smers, windows)

    return let(pieces(text), zipped)


def _edge(k: Column) -> Column:
    least = F.least(*[k[f"s{i}"] for i in range(K - S + 1)])
    return (least == k["s0"]) | (least == k[f"s{K - S}"])


def _hash(k: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[k[f"s{i}"] for i in range(K - S + 1)]), HASH_DROP)


def anchors(text: Column) -> Column:
    """Array of (position, hash): the closed syncmers of a text, positions counted in pieces; all k-mers where none is one."""
    def named(k: Column, i: Column) -> Column:
        return F.struct((i - (K - 1)).alias("position"), _hash(k).alias("hash"))

    def chosen(kmers: Column) -> Column:
        edge = F.array_compact(F.transform(kmers, lambda k, i: F.when(_edge(k), named(k, i))))
        return let(edge, lambda found: F.when(F.size(found) > 0, found).otherwise(F.transform(kmers, named)))

    return let(_kmers(text), chosen)


def sketch(found: Column) -> Column:
    """The ``KEPT`` smallest distinct hashes of anchors, in order."""
    return F.slice(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["hash"]))), 1, KEPT)


def links(found: Column) -> Column:
    """Distinct hashes of each anchor with the next one and the distance to it; the last anchor has a link of its own."""
    def link(a: Column, b: Column) -> Column:
        named = F.xxhash64(a["hash"], F.coalesce(b["hash"], F.lit(-1).cast("long")), F.coalesce(b["position"] - a["position"], F.lit(0)))
        return F.shiftrightunsigned(named, 33).cast("int")

    return F.array_distinct(F.zip_with(found, _shifted(found, 1), link))


def marks(text: Column) -> Column:
    """(sketch, links) of a text, its anchors found once."""
    return let(anchors(text), lambda found: F.struct(sketch(found).alias("sketch"), links(found).alias("links")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of links."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def as_text(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), (64 - HASH_DROP) // 4, "0")), "")


def next_ids(ids: DataFrame, key: str) -> DataFrame:
    """(key, next): the next larger key, and the smallest one after the largest.

    Keys that share all but their low bits are a group: at most 2^11 of them at the first level and 2^16 at the next.
    A group's last key is followed by the first key of the next group, which the level above finds in the same way; so
    no task sorts all keys. The last level has at most 2^21 groups, whatever the number of keys.
    """
    level = ids.select(key).distinct().select(F.col(key).alias("first"), F.col(key).alias("node"))
    tables = []
    for shift in (*LEVELS, None):
        parent = F.shiftright("first", shift) if shift is not None else F.lit(0).cast("long")
        level = level.withColumn("parent", parent)
        inside = Window.partitionBy("parent").orderBy("node")
        level = level.withColumn("next", F.lead("first").over(inside))
        if shift is None:  # after the last comes the first
            level = level.withColumn("next", F.coalesce("next", F.min("first").over(Window.partitionBy("parent"))))
        tables.append(level)
        level = level.groupBy(F.col("parent").alias("node")).agg(F.min("first").alias("first"))
    found = tables.pop()
    while tables:
        above = found.select(F.col("node").alias("parent"), F.col("next").alias("above"))
        found = tables.pop().join(above, "parent").withColumn("next", F.coalesce("next", "above")).drop("above")
    return found.select(F.col("node").alias(key), "next")


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, head, next_links): each row with the start of the next document and that one's links.

    ``head`` is as long as the longest text with the key asks for. Texts are dealt out once, by key; starts and links travel
    to the row before.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("key"), text_of(text).alias("text"))
    lengths = rows.groupBy("key").agg(F.max(F.length("text")).alias("n"))
    asked = next_ids(lengths, "key").join(lengths, "key").select(
        F.col("next").alias("key"), F.col("key").alias("before"), F.floor(F.col("n") / 4).cast("int").alias("need"))
    lent = rows.join(asked, "key").select("before", F.struct(
        F.xxhash64("text").alias("order"), F.substring("text", F.lit(1), F.col("need")).alias("head"), let(anchors(F.col("text")), links).alias("links")).alias("of"))
    lent = lent.groupBy("before").agg(F.min("of").alias("of"))  # one row unless an id is repeated
    return (rows.join(lent, rows["key"] == lent["before"])
            .select("key", "text", F.col("of.head").alias("head"), F.col("of.links").alias("next_links")))


def op1_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its text with the end replaced by the start of the next document."""
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("head", F.lit(1), cut))
    rows = edited_pairs(docs.select("doc_id", "text")).select("key", "text", "next_links", edited.alias("edited"))
    rows = rows.select("key", "next_links", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       marks(F.col("text")).alias("own"), marks(F.col("edited")).alias("other"))
    return rows.select(
        F.nullif("key", F.lit(NO_ID)).alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("own.sketch")).alias("fingerprint"),
        as_text(F.col("other.sketch")).alias("edited_fingerprint"),
        likeness(F.col("own.links"), F.col("other.links")).alias("near_edited"),
        likeness(F.col("own.links"), F.col("next_links")).alias("near_next"))
