"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are sorted by (page id, digest) over the whole table; every ``RECORDS`` places of that order are a shard, and a
shard's file is rolled when its compressed size passes ``ROLL_BYTES``. Dates are a parameter and record ids follow from the
place, so the same pages give the same bytes, however Spark deals them out. Of records with equal payloads the one with
the smallest page id is a response and the others are revisits.

Tasks write under temporary names that no other attempt uses; when all are done, tasks move the files that the finished
attempts reported to their last names (a move that was already made counts as done), and the manifest is written last.
Readers open only what the manifest names. Files go through ``pyarrow.fs``, so the folder can be in any shared store.

A null html is an empty payload, a null url gives no target. Rows with a null page id refer to the smallest id of their
payload. Of repeated rows (same id and payload) the first is the response. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import sys
import uuid
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import ranked, text_of
from tallyloom.session import cut_lineage, ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORDS, ROLL_BYTES = 4096, 32 << 20
DATE = "2026-01-01T00:00:00Z"
READ = 1 << 16
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, name: str, date: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"), ("WARC-Date", date), *fields,
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def _line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _page_record(kind: str, place: str, date: str, page: int | None, url: str | None, digest: str, size: int, first: int | None, payload: bytes) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    fields = [("WARC-Target-URI", _line(url))] if url else []
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if kind == "revisit":
        fields.append(("WARC-Profile", _PROFILE))
        if first is not None:
            fields.append(("X-Refers-To-Page-Id", str(first)))
    return _record(kind, place, date, fields, http + (payload if kind == "response" else b""))


#: Names that Spark's file systems have and the writers' library spells otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and authority that Spark gives it: a bare path lies in the default file system, not on each
    machine's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store_address(folder: str) -> tuple[str, str]:
    """(scheme, address) for the writers' library; the address of a local folder is its path."""
    scheme, _, rest = folder.partition(":")
    if "/" in scheme or not rest:
        raise ValueError(f"{folder} names no file system")
    scheme = SCHEMES.get(scheme, scheme)
    return scheme, "/" + rest.lstrip("/") if scheme == "file" else f"{scheme}:{rest}"


def _store(folder: str):
    from pyarrow import fs

    scheme, address = store_address(folder)
    return (fs.LocalFileSystem(), address) if scheme == "file" else fs.FileSystem.from_uri(address)


MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"


def _writer(folder: str, date: str, roll: int):
    def batches(source):
        store, top = _store(folder)
        attempt = uuid.uuid4().hex
        store.create_dir(f"{top}/_temporary/{attempt}", recursive=True)
        out, size, digest, count, shard, part, place, last = None, 0, None, 0, None, 0, 0, None
        name, done = "", []

        def finish() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((name, f"_temporary/{attempt}/{name}", count, size, digest.hexdigest()))
                out = None

        def put(data: bytes) -> None:
            nonlocal size
            out.write(data)
            digest.update(data)
            size += len(data)

        for batch in source:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    finish()
                    shard, part, place, last = row["shard"], 0, 0, None
                if out is not None and size >= roll:
                    finish()
                    part += 1
                if out is None:
                    name, size, digest, count = f"pages-{shard:09d}-{part:04d}.warc.gz", 0, hashlib.sha256(), 0
                    out = store.open_output_stream(f"{top}/_temporary/{attempt}/{name}", compression=None)
                    put(_record("warcinfo", name, date, [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                payload = zlib.decompress(row["packed"])
                own = (row["page_id"], row["digest"])
                kind = "response" if row["page_id"] == row["first"] and own != last else "revisit"
                put(_page_record(kind, f"{shard}-{place}", date, row["page_id"], row["url"], base32_sha1(payload), len(payload), row["first"], payload))
                last, place, count = own, place + 1, count + 1
            if done:
                yield _manifest_rows(done)
                done.clear()
        finish()
        if done:
            yield _manifest_rows(done)

    return batches


def _manifest_rows(rows: list[tuple]) -> pa.RecordBatch:
    name, temporary, records, size, sha = (list(x) for x in zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(temporary), pa.array(records, pa.int64()), pa.array(size, pa.int64()), pa.array(sha)],
                                      names=["name", "temporary", "records", "bytes", "sha256"])


def _mover(folder: str):
    def batches(source):
        from pyarrow import fs

        store, top = _store(folder)
        for batch in source:
            for row in batch.to_pylist():
                if store.get_file_info(f"{top}/{row['temporary']}").type != fs.FileType.NotFound:
                    store.move(f"{top}/{row['temporary']}", f"{top}/{row['name']}")
                elif store.get_file_info(f"{top}/{row['name']}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(row["name"])
            yield batch

    return batches


def _packer(source):
    for batch in source:
        packed = pa.array([zlib.compress((x.as_py() or "").encode(), 6) for x in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, batch.column(3)], names=["page_id", "url", "packed", "digest"])


def _one_task_each(files: DataFrame) -> DataFrame:
    """About one task per file: names are short, so without a count Spark would merge thousands of them into one task."""
    return files.repartition(max(1, files.count()), "name")


def write_archives(pages: DataFrame, folder: str, date: str = DATE, records: int = RECORDS, roll: int = ROLL_BYTES) -> str:
    """Write (page_id, url, html) as archives below ``folder``; gives the folder with its file system."""
    folder = qualified(pages.sparkSession, folder)
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha1(text_of("html")).alias("digest"))
    keys = rows.select("page_id", "digest").distinct()
    placed = ranked(keys, ["page_id", "digest"], "place").withColumn("shard", F.floor(F.col("place") / records)).drop("place")
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first"))
    placed = placed.join(firsts, "digest")
    packed = rows.mapInArrow(_packer, "page_id long, url string, packed binary, digest string")
    known = [packed["page_id"].eqNullSafe(placed["page_id"]), packed["digest"] == placed["digest"]]
    full = packed.join(placed, known).select(packed["page_id"], "url", "packed", packed["digest"], "shard", "first")
    dealt = full.repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "url")
    written = cut_lineage(dealt.mapInArrow(_writer(folder, date, roll), MANIFEST))
    moved = cut_lineage(_one_task_each(written).mapInArrow(_mover(folder), MANIFEST))
    moved.select("name", "records", "bytes", "sha256").write.mode("overwrite").json(f"{folder}/manifest")
    return folder


def _records(stream):
    """(fields, block) of each record of a gzip file, read piece by piece; a record is in memory at a time."""
    engine, data, ready = zlib.decompressobj(31), b"", []
    while True:
        if not data:
            data = stream.read(READ)
            if not data:
                return
        ready.append(engine.decompress(data))
        data = engine.unused_data
        if engine.eof:
            head, _, rest = b"".join(ready).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            if version != "WARC/1.1":
                raise ValueError(f"no WARC record: {version[:40]}")
            fields = dict(line.split(": ", 1) for line in lines)
            yield fields, rest[:int(fields["Content-Length"])]
            engine, ready = zlib.decompressobj(31), []
        else:
            data = b""


READ_BACK = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string, file string"


def _reader(folder: str):
    def batches(source):
        store, top = _store(folder)
        for batch in source:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for fields, block in _records(stream):
                        if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                            raise ValueError(f"digest of a record in {name}")
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
                        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                        if payload is not None and (base32_sha1(payload), len(payload)) != (digest, size):
                            raise ValueError(f"payload of a record in {name}")
                        number = [int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                        rows.append((number[0], fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], number[1],
                                     None if payload is None else payload.decode(), name))
                        held += len(block)
                        if held > 8 << 20:
                            yield _read_rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _read_rows(rows)

    return batches


def _read_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in READ_BACK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page record of the archives that the manifest names, digests checked; html is null for revisits."""
    folder = qualified(spark, folder)
    manifest = spark.read.schema("name string, records long, bytes long, sha256 string").json(f"{folder}/manifest")
    return _one_task_each(manifest.select("name")).mapInArrow(_reader(folder), READ_BACK)


def op8_warc(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: one row per page."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(spark, write_archives(pages, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file")
