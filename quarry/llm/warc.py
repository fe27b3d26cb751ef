"""WARC archives with a two-level capture index (operator 1).

Writing: each task appends its pages' records, one gzip member each, to an
archive file and reports a capture line per record. Of captures with equal
payloads of at least ``MIN_REVISIT`` bytes the smallest page id is a *response*
and the others are *revisits* that refer to it; smaller payloads are always
responses.

Index: capture lines are range-partitioned and sorted by (reversed-host URL
key, page id). Each task packs its lines into compressed blocks of
``BLOCK_LINES`` and ends its file with a sparse directory: one entry (first key,
offset, length) per block. The first level is the committed table of index
files (first key of each), the second the directories.

Lookup: sorted queries are dealt out by the same order; a task finds the index
file, then the block by binary search in the directory, reads just that
block's range, and searches in it. Records are then read from the archives by
file and offset; neighbouring ranges are read at once.

Defined cases: a null html is an empty payload; a null url has the empty key
and stands in no ``WARC-Target-URI`` header; pages without id are responses
and are never referred to; equal (page id, payload) rows are alike (all
response or all revisits); an empty table gives no file and no rows; other
columns aren't looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import written
from .shared_files import new_name, open_folder
from .texts import small_batches

MIN_REVISIT = 100
BLOCK_LINES = 3000
#: Salts over which equal payloads are joined, so that one payload isn't one task.
SALTS = 32
#: Uncompressed bytes after which a task begins another archive file.
ARCHIVE_BYTES = 1 << 30
#: Bytes read at once where records lie side by side.
READ_BYTES = 4 << 20
#: Compressed bytes of records that one task reads.
TASK_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
CAPTURES = "key string, page_id bigint, path string, offset bigint, length bigint"
_NONE = -(1 << 63)  # stands for a missing page id in the index, and sorts first


def url_key(url: str | None) -> str:
    """Sort key of a URL: host reversed (``com,example)/path?query``), lower-cased
    host, no scheme, user, default port or fragment."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        host = port = None
    if not host:
        return re.sub(r"[\x00-\x1f]", "", url.strip())
    default = {"http": 80, "https": 443}.get(parts.scheme)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "") + ")" + (parts.path or "/")
    return re.sub(r"[\x00-\x1f]", "", key + (f"?{parts.query}" if parts.query else ""))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16])}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    length = b"" if refers_to is not None else b"Content-Length: %d\r\n" % len(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + length + b"\r\n" + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m.group()):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one gzip member; a response's digest is verified."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and "sha256:" + hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"]:
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return fields, payload


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def find_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the revisits. Equal payloads meet as
    (digest, salt) groups, joined to their counted minimum."""
    p = _payload(F.col("html"))
    large = pages.where(F.octet_length(p) >= min_bytes).select("page_id", F.sha2(p, 256).alias("digest")).where("page_id IS NOT NULL")
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    first = first.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = large.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return salted.join(first, ["digest", "salt"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT, level: int = 4) -> DataFrame:
    """Write a record per page under ``folder``; the committed capture lines."""
    small_batches(pages.sparkSession)
    p = _payload(F.col("html"))
    digested = pages.select("page_id", "url", p.alias("payload"), F.sha2(p, 256).alias("digest"))
    marked = digested.join(find_revisits(pages, min_bytes), ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sink, at, path = TaskContext.get().partitionId(), None, 0, ""
        fs, root = open_folder(folder)
        for batch in batches:
            lines = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    fs.create_dir(root, recursive=True)
                    name, at = new_name("pages", part, ".warc.gz"), 0
                    path, sink = folder.rstrip("/") + "/" + name, fs.open_output_stream(f"{root}/{name}", compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(make_record(page_id, url, payload, digest, refers_to)) + packer.flush()
                sink.write(member)
                lines.append((url_key(url), page_id, path, at, len(member)))
                at += len(member)
                if at > ARCHIVE_BYTES:
                    sink.close()
                    sink = None
            cols = list(zip(*lines)) or [()] * 5
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "page_id", "path", "offset", "length"],
            )
        if sink is not None:
            sink.close()

    return written(marked.mapInArrow(write, CAPTURES), "captures")


# -- index ------------------------------------------------------------------------


@dataclass(frozen=True)
class IndexFile:
    """First level: one index file with its first entry and where its directory lies."""

    first: tuple[bytes, int]
    path: str
    at: int
    length: int


def _line(key: str, page_id: int | None, *rest) -> bytes:
    return "\t".join([key.replace("\t", " "), "" if page_id is None else str(page_id), *map(str, rest)]).encode()


def _entry(line: bytes) -> tuple[bytes, int]:
    key, page_id, _ = line.split(b"\t", 2)
    return key, int(page_id) if page_id else _NONE


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[IndexFile]:
    """Index files of all capture lines; the first level (an entry for each file, in order)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, block, directory, at = None, [], [], 0

        def flush():
            nonlocal at
            data = zlib.compress(b"\n".join(block), 6)
            directory.append(b"\t".join([*_line(block[0].split(b"\t")[0].decode(), None).split(b"\t")[:1], block[0].split(b"\t")[1], b"%d" % at, b"%d" % len(data)]))
            sink.write(data)
            at += len(data)
            block.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    fs, root = open_folder(folder)
                    fs.create_dir(root, recursive=True)
                    name = new_name("index", TaskContext.get().partitionId(), ".blocks")
                    path, sink = folder.rstrip("/") + "/" + name, fs.open_output_stream(f"{root}/{name}", compression=None)
                block.append(_line(*row))
                if len(block) == block_lines:
                    flush()
        if sink is not None:
            if block:
                flush()
            data = zlib.compress(b"\n".join(directory), 6)
            sink.write(data)
            sink.close()
            key, page_id = _entry(directory[0])
            yield pa.record_batch([pa.array([x]) for x in (key.decode(), page_id, path, at, len(data))], names=["key", "page_id", "path", "at", "length"])

    order = [F.col("key"), F.col("page_id").asc_nulls_first()]
    files = captures.select("key", "page_id", "path", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order, "path", "offset")
    rows = written(files.mapInArrow(write, "key string, page_id bigint, path string, at bigint, length bigint"), "index").collect()
    return sorted((IndexFile((r.key.encode(), r.page_id), r.path, r.at, r.length) for r in rows), key=lambda f: f.first)


class IndexReader:
    """Binary search in the two levels; keeps the last directory and block."""

    def __init__(self, files: list[IndexFile]):
        self.files, self.firsts = files, [f.first for f in files]
        self.directory: tuple[int, list, list] = (-1, [], [])
        self.block: tuple[int, int, list, list] = (-1, -1, [], [])

    def _read(self, path: str, at: int, length: int) -> list[bytes]:
        fs, p = open_folder(path)
        with fs.open_input_file(p) as f:
            return zlib.decompress(f.read_at(length, at)).split(b"\n")

    def _open_file(self, i: int) -> None:
        if self.directory[0] != i:
            f = self.files[i]
            lines = self._read(f.path, f.at, f.length)
            self.directory = (i, [_entry(x) for x in lines], [tuple(map(int, x.split(b"\t")[2:4])) for x in lines])

    def _open_block(self, i: int, b: int) -> None:
        if self.block[:2] != (i, b):
            lines = self._read(self.files[i].path, *self.directory[2][b])
            self.block = (i, b, [_entry(x) for x in lines], lines)

    def find(self, key: bytes, page_id: int | None = None) -> Iterator[tuple[int | None, str, int, int]]:
        """Captures of a key, or of one page under it: page id, archive, offset, length."""
        low = (key, _NONE if page_id is None else page_id)
        i = max(0, bisect_left(self.firsts, low) - 1)  # equal entries may begin in the file before
        while i < len(self.files) and self.firsts[i][0] <= key:
            self._open_file(i)
            b = max(0, bisect_left(self.directory[1], low) - 1)
            while b < len(self.directory[1]) and self.directory[1][b][0] <= key:
                self._open_block(i, b)
                entries = self.block[2]
                k = bisect_left(entries, low)
                while k < len(entries) and entries[k][0] == key and (page_id is None or entries[k][1] == page_id):
                    fields = self.block[3][k].decode().split("\t")
                    yield (int(fields[1]) if fields[1] else None), fields[2], int(fields[3]), int(fields[4])
                    k += 1
                if k < len(entries):
                    return
                b += 1
            if b < len(self.directory[1]):
                return
            i += 1


def look_up(queries: DataFrame, index: list[IndexFile]) -> DataFrame:
    """Captures of ``queries(key, page_id)``: with a page id that page's alone,
    with ``_NONE`` pages without id, with null all of the key's. Queries are sorted, so a task reads
    neighbouring blocks once."""
    held = queries.sparkSession.sparkContext.broadcast(index)  # an entry for each index file

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(held.value)
        for batch in batches:
            found = [x for key, page_id in zip(*(c.to_pylist() for c in batch.columns)) for x in reader.find(key.replace("\t", " ").encode(), page_id)]
            cols = list(zip(*found)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["page_id", "path", "offset", "length"])

    order = [F.col("key"), F.col("page_id").asc_nulls_first()]
    return queries.select("key", "page_id").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(find, "page_id bigint, path string, offset bigint, length bigint")


def read_records(captures: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records at ``(path, offset, length)``: page id, record type, payload
    digest and length, referred page, payload. Tasks are counted by the bytes
    they read, not by the size of the capture rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, held, lo = None, None, b"", 0
        for batch in batches:
            rows = []
            for p, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if p != path:
                    if file is not None:
                        file.close()
                    fs, at = open_folder(p)
                    path, file, held, lo = p, fs.open_input_file(at), b"", 0
                if not lo <= offset <= offset + length <= lo + len(held):
                    # a record right behind the last one: read ahead, its neighbours follow
                    ahead = READ_BYTES if offset == lo + len(held) or lo <= offset < lo + len(held) else 0
                    held, lo = file.read_at(max(length, ahead), offset), offset
                fields, payload = parse_record(held[offset - lo : offset - lo + length])
                number = lambda name: int(fields[name]) if name in fields else None
                rows.append((number("x-page-id"), fields["warc-type"], fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-length"]), number("x-refers-to-page"), payload))
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])

    captures = written(captures.select("path", "offset", "length"), "found")
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-(captures.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    placed = captures.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    return placed.mapInArrow(read, "page_id bigint, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary")


def key_column(url: Column) -> Column:
    @F.arrow_udf("string")
    def keys(urls: pa.Array) -> pa.Array:
        return pa.array([url_key(u) for u in urls.to_pylist()])

    return keys(url)


def warc_digest(pages: DataFrame) -> DataFrame:
    """Archives and index written, then every page's capture looked up and its record read back."""
    spark: SparkSession = pages.sparkSession
    folder = scratch_path(spark, "warc")
    index = write_index(write_archives(pages, folder + "/archive"), folder + "/index")
    wanted = pages.select(key_column(F.col("url")).alias("key"), F.coalesce("page_id", F.lit(_NONE)).alias("page_id")).distinct()
    records = read_records(look_up(wanted, index))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
