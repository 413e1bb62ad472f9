"""WARC archives with a two-level capture index.

Records are written in the order of their keys, the URL with its host reversed. Beside each
archive stands its index: the entries in compressed blocks of BLOCK_ENTRIES, and a directory
with the first key and the byte range of each block. A lookup finds the archives by their key
range, searches the directory by bisection, reads one block, searches that by bisection, and
reads the record's byte range.

Every task writes files of its own name, and only files that the written manifest names are
read: a task that is run again leaves nothing but an unused file.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.shared import new_path, partitions, written

MIN_REVISIT_BYTES = 1000
BLOCK_ENTRIES = 256
GZIP_LEVEL = 6
READ_AHEAD = 4 << 20
MAX_ARCHIVES = 100_000  # rows of the manifest that a task may hold; about 20 MB
_DATE = "1970-01-01T00:00:00Z"  # the pages have none
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> F.Column:
    """SQL: the host reversed, then path and query, without scheme, port, user and fragment."""
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    rest = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(host == "", u).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


@dataclass(frozen=True)
class Archives:
    """manifest: path (without ending), first_key, last_key, n_records of each archive."""

    spark: SparkSession
    manifest: DataFrame


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _record(page: str, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if original is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if original is not None:
        head += [f"WARC-Refers-To: <urn:page:{original}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> Archives:
    """One record for each row of pages; a null html is an empty payload.

    Of records with equal payloads of MIN_REVISIT_BYTES or more, the one with the largest
    page_id has the payload, the others refer to it; so do repeated rows of a page that is not
    the largest. Rows without page_id keep their payload. Other columns are ignored whatever
    their names. An empty table gives no archive.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        url_key(url).alias("key"),
        F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b"")).alias("payload"))
    sized = rows.withColumn("digest", F.sha1("payload"))
    equal = (sized.select("page_id", "digest", F.octet_length("payload").alias("n"))
             .where(f"n >= {MIN_REVISIT_BYTES} AND page_id IS NOT NULL").groupBy("digest")
             .agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1"))
    equal = written(equal.select("digest", "original"), "equal")
    typed = sized.join(equal, "digest", "left").select(
        "key", "page_id", "url", "payload", "digest",
        F.when(F.col("page_id") != F.col("original"), F.col("original")).alias("refers_to"))
    folder = new_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if len(b))
        batch = next(batches, None)
        if batch is None:
            return
        path = f"{folder}/{uuid.uuid4().hex}"
        fs, local = _filesystem(path)
        fs.create_dir(local.rpartition("/")[0], recursive=True)
        directory, block, offset, index_offset, n = [], [], 0, 0, 0
        first = last = None
        with fs.open_output_stream(local + ".warc.gz", compression=None) as archive, \
                fs.open_output_stream(local + ".cdx.gz", compression=None) as index:
            def flush() -> None:
                nonlocal index_offset, block
                if block:
                    packed = _gzip("\n".join(map(json.dumps, block)).encode())
                    index.write(packed)
                    directory.append([block[0][0], index_offset, len(packed)])
                    index_offset, block = index_offset + len(packed), []

            while batch is not None:
                for i in range(len(batch)):
                    key, page, target, payload, digest, original = (c[i].as_py() for c in batch.columns)
                    packed = _gzip(_record("none" if page is None else str(page), target, payload,
                                           digest, original))
                    archive.write(packed)
                    block.append([key, offset, len(packed)])
                    offset, n = offset + len(packed), n + 1
                    first, last = key if first is None else first, key
                    if len(block) == BLOCK_ENTRIES:
                        flush()
                batch = next(batches, None)
            flush()
        with fs.open_output_stream(local + ".dir", compression=None) as out:
            out.write(json.dumps(directory).encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([first]), pa.array([last]), pa.array([n], pa.int64())],
            ["path", "first_key", "last_key", "n_records"])

    ordered = typed.repartitionByRange(partitions(spark), "key", "page_id").sortWithinPartitions("key", "page_id")
    manifest = ordered.mapInArrow(run, "path string, first_key string, last_key string, n_records long")
    return Archives(spark, written(manifest, "manifest"))


def _parsed(data: bytes) -> dict[str, object]:
    """One record; a payload that does not fit its digest is an error."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(http.rpartition(b"Content-Length: ")[2])
    if fields["WARC-Type"] == "response" and (
            hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = fields.get("WARC-Refers-To")
    return {"page_id": None if page == "none" else int(page), "url": fields.get("WARC-Target-URI"),
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None,
            "payload": payload if fields["WARC-Type"] == "response" else None}


class _Reader:
    """The index of one archive, and its records."""

    def __init__(self, path: str) -> None:
        self.fs, self.local = _filesystem(path)
        with self.fs.open_input_file(self.local + ".dir") as f:
            self.directory = json.loads(f.read())
        self.first = [row[0] for row in self.directory]
        self.index = self.fs.open_input_file(self.local + ".cdx.gz")
        self.archive = self.fs.open_input_file(self.local + ".warc.gz")
        self.block_at, self.block, self.keys = None, [], []
        self.ahead_at, self.ahead = 0, b""

    def close(self) -> None:
        self.index.close()
        self.archive.close()

    def _load(self, i: int) -> None:
        if self.block_at != i:
            _, offset, length = self.directory[i]
            lines = zlib.decompress(self.index.read_at(length, offset), 31).decode().split("\n")
            self.block_at, self.block = i, [json.loads(x) for x in lines]
            self.keys = [row[0] for row in self.block]

    def records(self, key: str) -> Iterator[dict[str, object]]:
        """All captures of a key: it may begin at the end of the block before the first that
        starts with it, and go on over several blocks."""
        i = max(bisect.bisect_left(self.first, key) - 1, 0)
        while i < len(self.first) and self.first[i] <= key:
            self._load(i)
            for _, offset, length in self.block[bisect.bisect_left(self.keys, key):
                                                bisect.bisect_right(self.keys, key)]:
                yield _parsed(self._read(offset, length))
            i += 1

    def _read(self, offset: int, length: int) -> bytes:
        start = offset - self.ahead_at
        if start < 0 or start + length > len(self.ahead):
            self.ahead_at, start = offset, 0
            self.ahead = self.archive.read_at(max(length, READ_AHEAD), offset)
        return self.ahead[start:start + length]


COLUMNS = ("key", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def captures(archives: Archives, keys: DataFrame, payloads: bool = False) -> DataFrame:
    """COLUMNS (and payload, which revisits lack) of all captures of the keys in column key.

    A repeated or null key counts once or not at all; a key without capture gives no row.
    """
    files = sorted((r["first_key"], r["last_key"], r["path"]) for r in
                   archives.manifest.select("path", "first_key", "last_key").limit(MAX_ARCHIVES + 1).collect())
    if len(files) > MAX_ARCHIVES:
        raise ValueError("too many archives for one manifest; write fewer, larger ones")
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]
    n_out = max(partitions(archives.spark), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, where = [], []
            for key in batch.column(0).to_pylist():
                # Archives are in key order: the first that ends at the key or later, and on.
                for i in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)):
                    found.append(key)
                    where.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(where, pa.int32())],
                                             ["key", "archive"])

    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()),
                        *[("payload", pa.binary())] * payloads])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, rows, held = None, None, [], 0
        for batch in batches:
            for key, archive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if archive != at:
                    if reader:
                        reader.close()
                    at, reader = archive, _Reader(files[archive][2])
                for row in reader.records(key):
                    rows.append(row | {"key": key})
                    held += row["payload_bytes"] if payloads else 200
                    if held > READ_AHEAD:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
        if reader:
            reader.close()

    placed = keys.where("key IS NOT NULL").select("key").distinct().mapInArrow(
        place, "key string, archive int")
    out = ("key string, page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long" + ", payload binary" * payloads)
    return (placed.repartition(n_out, "archive").sortWithinPartitions("archive", "key")
            .mapInArrow(read, out))
