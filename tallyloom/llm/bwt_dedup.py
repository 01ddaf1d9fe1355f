"""Repeated byte strings across documents, by column-wise construction of a Burrows-Wheeler order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.

1. Every string of ``LENGTH`` bytes chooses an anchor, the smallest-hashed ``GRAM`` bytes in it, so equal strings have
   equal anchors. Anchors (hash, document) are dealt out by hash, packed; those of a single document are dropped.
2. Each document meets its remaining anchors and cuts out segments: for a run of strings with one anchor, the bytes they
   cover. Segments are dealt out by anchor; equal ones are one, with the smallest document.
3. A task builds the order of all suffixes of its segments as Bauer, Cox and Rosone do for a collection: in every round
   each segment inserts one more symbol, from its last to its first, by one stable distribution of the suffixes before
   by that symbol. Neighbours in the order that share ``LENGTH`` bytes are a class, and the class has a smallest document.
   The rounds are as many as a segment is long, at most ``2 * LENGTH``; the inputs are sorted shuffle files read in
   sequence, ``BATCH`` bytes at a time and whole anchors together. Anchors with one segment need no order.
4. Runs of bytes to remove go back to the documents.

Long texts need no long rounds, since segments are short. An anchor occurs in a document at most once per segment kind,
so one hot passage is a small part of any document's anchors, spread over many hashes. Null and empty texts have no
bytes. Of rows with the same id neither counts as smaller than the other. Rows with a null id keep their bytes and make
others lose none.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1  # anchors that a string chooses from
PLACE_BITS = 17
CHUNK = (1 << PLACE_BITS) - 2 * LENGTH
HASH_BITS = 48
BATCH = 1 << 20
BUCKETS_PER_PARTITION = 8
DOCS_AT_ONCE = 2500
NO_ID = -(1 << 63)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _gram_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    n = len(data)
    words = np.empty(n - 7, dtype=np.uint64)
    for shift in range(8):
        count = (n - shift) // 8
        words[shift::8] = np.frombuffer(data, dtype="<u8", count=count, offset=shift)
    m = n - GRAM + 1
    h = words[:m] * _M1
    h ^= h >> np.uint64(29)
    h += words[8:8 + m]
    h *= _M2
    h ^= h >> np.uint64(32)
    h += words[GRAM - 8:GRAM - 8 + m]
    h *= _M3
    h ^= h >> np.uint64(31)
    return h


def anchor_runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): runs of starts of strings that choose the same anchor, in order."""
    hashes, firsts, lasts = [], [], []
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
        part = data[at:at + CHUNK + LENGTH - 1]
        h = _gram_hashes(part)
        key = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = SPAN - width
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        place = (key & mask).astype(np.int64)
        edge = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], edge])
        hashes.append(h[place[first]] >> np.uint64(64 - HASH_BITS))
        firsts.append(first + at)
        lasts.append(np.concatenate([edge, [len(place)]]) - 1 + at)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes: the width that the largest needs, each byte of them together, compressed."""
    import zstandard

    top = int(values.max())
    width = max(1, (top.bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def _anchor_rows(buckets: int):
    """(bucket, low, hashes, docs): the distinct anchors of a batch of documents, packed by bucket."""
    def batches(source):
        for batch in source:
            hashes, owners = [], []
            for i, (key, data) in enumerate(zip(batch.column(0), batch.column(1))):
                if key.as_py() != NO_ID:
                    h = np.unique(anchor_runs(data.as_py())[0])
                    hashes.append(h.astype(np.int64))
                    owners.append(np.full(len(h), key.as_py(), dtype=np.int64))
            if not sum(map(len, hashes)):
                continue
            h, d = np.concatenate(hashes), np.concatenate(owners)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            bucket = _bucket(h, buckets)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]])
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                low = int(d[a:b].min())
                rows.append((int(bucket[a]), int(h[a]), low, _pack(np.diff(h[a:b], prepend=h[a])), _pack(d[a:b] - low)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                             names=["bucket", "first", "low", "hashes", "docs"])

    return batches


def _shared_anchors(source):
    """(doc, hashes): of each bucket, the anchors that at least two documents have."""
    def shared(parts):
        h = np.concatenate([p[0] for p in parts])
        d = np.concatenate([p[1] for p in parts])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        start = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(start) - 1
        low, high = d[start], d[np.concatenate([np.flatnonzero(start)[1:] - 1, [len(d) - 1]])]
        kept = (low < high)[group]
        h, d = h[kept], d[kept]
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(d)) + 1])
        offsets = np.concatenate([cuts, [len(d)]]).astype(np.int32)
        if len(d):
            yield pa.RecordBatch.from_arrays([pa.array(d[cuts]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h))], names=["doc", "hashes"])

    bucket, parts = None, []
    for batch in source:
        for here, first, low, hashes, docs in zip(*[c.to_pylist() for c in batch.columns]):
            if here != bucket and parts:
                yield from shared(parts)
                parts = []
            bucket = here
            parts.append((np.cumsum(_unpack(hashes)) + first, _unpack(docs) + low))
    if parts:
        yield from shared(parts)


SEGMENTS = "bucket long, first long, low long, anchors binary, sizes binary, docs binary, places binary, segments binary"


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return h * buckets >> HASH_BITS if buckets < 1 << 15 else h >> HASH_BITS - 15


def _segment_rows(buckets: int):
    """The bytes that the strings of each shared anchor cover: (anchor, segment, doc, place) packed by bucket of the anchor."""
    def batches(source):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in (whole.slice(at, DOCS_AT_ONCE) for whole in source for at in range(0, whole.num_rows, DOCS_AT_ONCE)):
            anchors, segments, docs, places = [], [], [], []
            for key, data, mine in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = data.as_py()
                h, first, last = anchor_runs(data)
                shared = np.isin(h.astype(np.int64), mine.values.to_numpy(zero_copy_only=False))
                anchors.append(h[shared].astype(np.int64))
                docs.append(np.full(int(shared.sum()), key, dtype=np.int64))
                places.append(first[shared])
                segments += [data[a:b] for a, b in zip(first[shared].tolist(), (last[shared] + LENGTH).tolist())]
            if not segments:
                continue
            h, d, p = np.concatenate(anchors), np.concatenate(docs), np.concatenate(places)
            order = np.argsort(h, kind="stable")
            h, d, p = h[order], d[order], p[order]
            bucket = _bucket(h, buckets)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]])
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = [segments[i] for i in order[a:b]]
                low = int(d[a:b].min())
                rows.append((int(bucket[a]), int(h[a]), low, _pack(np.diff(h[a:b], prepend=h[a])), _pack(np.fromiter(map(len, part), np.int64, len(part))),
                             _pack(d[a:b] - low), _pack(p[a:b]), squeeze(b"".join(part))))
            kinds = [pa.int64()] * 3 + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return batches


def _segments_of(bucket: list[dict]):
    """[(anchor, segment, doc, place)] of one bucket, sorted."""
    import zstandard

    rows = []
    for part in bucket:
        data = zstandard.ZstdDecompressor().decompress(part["segments"])
        edges = np.concatenate([[0], np.cumsum(_unpack(part["sizes"]))]).tolist()
        segments = [data[a:b] for a, b in zip(edges, edges[1:])]
        rows += zip((np.cumsum(_unpack(part["anchors"])) + part["first"]).tolist(), segments, (_unpack(part["docs"]) + part["low"]).tolist(), _unpack(part["places"]).tolist())
    rows.sort()
    return rows


def suffix_order(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all suffixes of the segments text[start:end], in order, built one column a round from the ends.

    The suffixes with one symbol more are those before, with their preceding symbol, distributed stably by that symbol.
    """
    is_start = np.zeros(len(text) + 1, dtype=bool)
    is_start[starts] = True
    order = ends
    for _ in range(int((ends - starts).max())):
        before = order[~is_start[order]] - 1
        order = np.concatenate([ends, before[np.argsort(text[before], kind="stable")]])
    return order


def smallest_owner(segments: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For every segment, per string of ``LENGTH`` bytes in it, the smallest owner of a segment that holds the string.

    Places of different segments never overlap: each has one place more than symbols, for its empty suffix.
    """
    sizes = np.fromiter(map(len, segments), np.int32, len(segments))
    text = np.frombuffer(b"\0".join(segments) + b"\0", dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int32)
    ends = starts + sizes
    order = suffix_order(text, starts, ends)
    owner_of = np.repeat(np.arange(len(segments), dtype=np.int32), sizes + 1)
    whole = order[ends[owner_of[order]] - order >= LENGTH]
    windows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    same = np.zeros(len(whole), dtype=bool)
    for at in range(1, len(whole), 1 << 18):
        stop = min(at + (1 << 18), len(whole))
        same[at:stop] = (windows[whole[at:stop]] == windows[whole[at - 1:stop - 1]]).all(axis=1)
    classes = np.cumsum(~same) - 1
    lowest = np.minimum.reduceat(owners[owner_of[whole]], np.flatnonzero(~same)) if len(whole) else np.empty(0, np.int64)
    at_place = np.zeros(len(text), dtype=np.int64)
    at_place[whole] = lowest[classes] if len(whole) else 0
    return [at_place[a:b - LENGTH + 1] for a, b in zip(starts, ends)]


class _Runs:
    """Byte runs to remove, as three columns."""

    def __init__(self):
        self.doc: list[int] = []
        self.start: list[int] = []
        self.stop: list[int] = []

    def add(self, low: np.ndarray, owners: list[tuple[int, int]]) -> None:
        """``low``: the smallest owner of each string of a segment; ``owners``: (doc, place) of the segment, in order."""
        whole = low[0] if (low == low[0]).all() else None
        for doc, place in owners:
            if whole is not None:
                if whole < doc:
                    self.doc.append(doc)
                    self.start.append(place)
                    self.stop.append(place + len(low) - 1 + LENGTH)
                continue
            turn = np.flatnonzero(np.diff(np.concatenate([[0], (low < doc).view(np.int8), [0]])))
            for x, y in zip(turn[::2].tolist(), turn[1::2].tolist()):
                self.doc.append(doc)
                self.start.append(place + x)
                self.stop.append(place + y - 1 + LENGTH)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (self.doc, self.start, self.stop)], names=["doc", "from", "to"])


def _removed_runs(source):
    """(doc, from, to): bytes to remove, of packed segments sorted by bucket.

    Where all segments of an anchor are equal, their smallest document owns all their strings; the others need the order.
    """
    def runs_of(bucket: list[dict]):
        rows, out = _segments_of(bucket), _Runs()
        segments, owners, held, i = [], [], 0, 0
        while i < len(rows):
            anchor, groups = rows[i][0], []
            while i < len(rows) and rows[i][0] == anchor:
                segment, mine = rows[i][1], []
                while i < len(rows) and rows[i][1] == segment and rows[i][0] == anchor:
                    mine.append(rows[i][2:])
                    i += 1
                groups.append((segment, mine))
            if len(groups) == 1:
                out.add(np.full(len(groups[0][0]) - LENGTH + 1, groups[0][1][0][0]), groups[0][1])
                continue
            for segment, mine in groups:
                segments.append(segment)
                owners.append(mine)
                held += len(segment)
            if held > BATCH or i == len(rows):
                settle(segments, owners, out)
                segments, owners, held = [], [], 0
        settle(segments, owners, out)
        return out.batch()

    def settle(segments: list[bytes], owners: list[list[tuple[int, int]]], out: _Runs) -> None:
        if segments:
            for low, mine in zip(smallest_owner(segments, np.array([m[0][0] for m in owners], dtype=np.int64)), owners):
                out.add(low, mine)

    bucket, parts = None, []
    for batch in source:
        for row in batch.to_pylist():
            if row["bucket"] != bucket and parts:
                yield runs_of(parts)
                parts = []
            bucket = row["bucket"]
            parts.append(row)
    if parts:
        yield runs_of(parts)


def _kept(source):
    """Counts and digest of what stays of each document."""
    for batch in source:
        rows = []
        for data, runs in zip(batch.column(1), batch.column(2).to_pylist()):
            data = data.as_py()
            digest, at, gone, spans = hashlib.sha256(), 0, 0, 0
            start = stop = None
            for run in [*sorted((r["from"], r["to"]) for r in runs or ()), (len(data), len(data))]:
                if stop is not None and run[0] <= stop and run[1] > run[0]:
                    stop = max(stop, run[1])
                    continue
                if stop is not None:
                    digest.update(data[at:start])
                    at, gone, spans = stop, gone + stop - start, spans + 1
                start, stop = run
            digest.update(data[at:])
            rows.append((len(data), gone, spans, digest.hexdigest()))
        n, gone, spans, sha = (list(c) for c in zip(*rows)) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                                         names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _bytes_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.encode(text_of(text), "UTF-8").alias("data"))


def removed_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, from, to): byte runs to remove; runs may overlap."""
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _bytes_of(docs, key, text)
    packed = rows.mapInArrow(_anchor_rows(buckets), "bucket long, first long, low long, hashes binary, docs binary")
    shared = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared_anchors, "doc long, hashes array<long>")
    mine = shared.groupBy("doc").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))  # bounded by the document
    cut = rows.join(mine, "doc").select("doc", "data", "hashes").mapInArrow(_segment_rows(buckets), SEGMENTS)
    return cut.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_removed_runs, "doc long, from long, to long")


def op7_suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: its bytes, those removed, the runs they form, and a digest of the rest.

    Both joins deal the texts out by document, so Spark does it once.
    """
    runs = removed_runs(docs).groupBy("doc").agg(F.collect_list(F.struct("from", "to")).alias("runs"))  # bounded by the document
    rows = _bytes_of(docs, "doc_id", "text")
    return (rows.join(runs, "doc", "left").select("doc", "data", "runs")
            .mapInArrow(_kept, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
            .select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"))
