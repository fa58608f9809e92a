"""WARC archives as seekable Zstandard bundles.

A bundle holds WARC records in independent Zstandard frames of about FRAME bytes of content, followed by a
seek table in a skippable frame (the public seekable format): compressed and decompressed size and a
checksum per frame. An index maps every record to its bundle, frame and offset within the frame, so one
record is read by fetching one frame. Records that repeat a payload are written as revisits.

Records follow WARC/1.1: a date, an id of their own each, and, for responses, an HTTP message around the
payload, whose header is made here and is not part of payload, digest or length. Page ids stand in own fields.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.llm import files
from sedimark.llm.tables import stored
from sedimark.session import fresh_path

FRAME, BUNDLE = 1 << 20, 256 << 20
LEVEL = 3
SHORTEST_REVISITED = 100

# Fixed values of the seekable format.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id bigint, bundle string, frame int, frame_start bigint, frame_size bigint, record_start bigint, record_size bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _address(url: str | None) -> str:
    return " ".join((url or "").split()) or "urn:none"


@dataclass(frozen=True)
class Entry:
    """What a record says. Without refers_to it is a response; null ids and addresses are allowed."""

    page_id: int | None
    url: str | None
    payload: bytes
    digest: str
    refers_to: int | None = None
    refers_to_url: str | None = None


def record(entry: Entry, record_id: str, date: str) -> bytes:
    """One WARC record. A revisit has no payload, but its digest and length. A null id has no field."""
    revisit = entry.refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_address(entry.url)}",
        f"WARC-Payload-Digest: sha256:{entry.digest}",
        f"Payload-Length: {len(entry.payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if entry.page_id is not None:
        lines.append(f"Page-ID: {entry.page_id}")
    if revisit:
        lines += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To-Target-URI: {_address(entry.refers_to_url)}",
            f"WARC-Refers-To-Date: {date}",
            f"Refers-To-Page-ID: {entry.refers_to}",
        ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(entry.payload)}\r\n\r\n"
    block = b"" if revisit else head.encode() + entry.payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and end of the record at `start`."""
    split = data.index(b"\r\n\r\n", start)
    version, *lines = data[start:split].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines)
    end = split + 4 + int(headers["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return headers, data[split + 4 : end], end + 4


def _page(value: str | None) -> int | None:
    return None if value is None else int(value)


def fields(headers: dict[str, str], block: bytes) -> tuple:
    """A RECORDS row; the payload's length and digest are measured where the record holds one."""
    revisit = headers["WARC-Type"] == "revisit"
    payload = None if revisit else block[block.index(b"\r\n\r\n") + 4 :]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(headers["Payload-Length"])):
        raise ValueError("payload and digest differ")
    return (
        _page(headers.get("Page-ID")), int(headers["Payload-Length"]), digest, headers["WARC-Type"],
        _page(headers.get("Refers-To-Page-ID")), payload,
    )


class Bundle:
    """Writes one bundle; frames are closed when they hold enough."""

    def __init__(self, folder: str, date: str) -> None:
        self.name, self.date = files.fresh_name("bundle", ".warc.zst"), date
        self.records = 0
        self.out = files.create(folder, self.name)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.held: list[bytes] = []
        self.size = self.written = 0
        self.open_rows: list[tuple] = []
        self.frames: list[tuple[int, int, int]] = []

    def add(self, entry: Entry) -> list[tuple]:
        """Takes a record, whose id comes from its place; returns the index rows of frames that it closed."""
        data = record(entry, str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.name}/{self.records}")), self.date)
        self.records += 1
        self.open_rows.append((entry.page_id, self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        return self.flush() if self.size >= FRAME else []

    def flush(self) -> list[tuple]:
        if not self.held:
            return []
        content = b"".join(self.held)
        packed = self.packer.compress(content)
        self.out.write(packed)
        rows = [(p, self.name, len(self.frames), self.written, len(packed), at, n) for p, at, n in self.open_rows]
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.written += len(packed)
        self.held, self.open_rows, self.size = [], [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), _CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()
        return rows


def seek_table(folder: str, name: str) -> list[tuple[int, int, int, int]]:
    """(start, compressed size, decompressed size, checksum) per frame, from the end of the bundle."""
    frames, flags, magic = struct.unpack("<IBI", files.read(folder, name, -9, 9))
    if magic != _SEEKABLE or flags != _CHECKSUMS:
        raise ValueError(f"{name} does not end in a seek table")
    table = files.read(folder, name, -9 - 12 * frames, 12 * frames)
    out, start = [], 0
    for packed, plain, check in struct.iter_unpack("<III", table):
        out.append((start, packed, plain, check))
        start += packed
    return out


def frame_content(folder: str, name: str, start: int, packed: int, check: int | None = None) -> bytes:
    content = zstandard.ZstdDecompressor().decompress(files.read(folder, name, start, packed))
    if check is not None and xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
        raise ValueError(f"a frame of {name} is damaged")
    return content


@dataclass(frozen=True)
class Archive:
    """A folder of bundles and the index of the records in them."""

    folder: str
    index: DataFrame


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def with_revisits(pages: DataFrame, page_id: Column, url: Column, payload: Column) -> DataFrame:
    """`pages` with digest, refers_to, the smallest page_id of an equal payload, null for that one itself, and its url.

    Only digests that occur more than once are joined back. Their table is read from files of known size, so
    Spark broadcasts it when it is small and otherwise joins with skew handling; a payload that many pages
    share is one row of it.
    """
    marked = pages.withColumns({"digest": F.sha2(payload, 256), "bytes": F.length(payload).cast("bigint")})
    long = marked.where(F.col("bytes") >= SHORTEST_REVISITED)
    # A struct is null where the id is, and then no minimum.
    least = F.min(F.when(page_id.isNotNull(), F.struct(page_id.alias("id"), url.alias("url"))))
    groups = long.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), least.alias("first"))
    groups = groups.where("n > 1 and first is not null").select("digest", "first.id", F.col("first.url").alias("refers_to_url"))
    joined = marked.join(stored(groups.withColumnRenamed("id", "first"), "warc-repeated"), "digest", "left")
    return joined.withColumn("refers_to", F.when((F.col("bytes") >= SHORTEST_REVISITED) & ~page_id.eqNullSafe(F.col("first")), F.col("first")))


def write(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: datetime | None = None
) -> Archive:
    """Archives a record per row, all of the given date (by default the call's). Runs jobs.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads of at least
    SHORTEST_REVISITED bytes the one with the smallest id is a response, rows repeated with that id too; the
    others revisit it. Rows without an id revisit a record that has one. An empty table gives an empty index.
    Every record has an id of its own, also where page ids repeat or are null; an address of null is urn:none.
    """
    plain = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = with_revisits(plain, F.col("page_id"), F.col("url"), F.col("payload"))
    rows = rows.select("page_id", "url", "payload", "digest", "refers_to", "refers_to_url")
    folder = fresh_path(pages.sparkSession, "warc")
    written = (date or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    schema = pa.schema([
        ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()),
        ("frame_size", pa.int64()), ("record_start", pa.int64()), ("record_size", pa.int64()),
    ])

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            done: list[tuple] = []
            for row in zip(*batch.columns, strict=True):
                bundle = bundle or Bundle(folder, written)
                done += bundle.add(Entry(*(value.as_py() for value in row)))
                if bundle.written >= BUNDLE:
                    done += bundle.close()
                    bundle = None
            yield _batch(done, schema)
        if bundle:
            yield _batch(bundle.close(), schema)

    # A task that runs twice leaves a bundle that no index row names.
    return Archive(folder, stored(rows.mapInArrow(bundled, INDEX), "warc-index"))


def read(archive: Archive) -> DataFrame:
    """Every record of the index: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Frames are read one by one, in as many tasks as the shuffle has, by the seek tables of their bundles, whose
    checksums are verified; records are cut from them by the offsets of the index. A frame that holds more or
    less than its index rows is an error.
    """
    folder = archive.folder
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, list] = {}
        for batch in batches:
            for name, frame, ends in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if name not in tables:
                    tables[name] = seek_table(folder, name)
                start, packed, plain, check = tables[name][frame]
                content, at, rows = frame_content(folder, name, start, packed, check), 0, []
                for end in ends:
                    headers, block, parsed = parse(content, at)
                    if parsed != end:
                        raise ValueError(f"a record of {name} does not end where the index says")
                    rows.append(fields(headers, block))
                    at = end
                if at != plain:
                    raise ValueError(f"a frame of {name} holds records that the index does not name")
                yield _batch(rows, schema)

    # The rows are small but stand for a frame each, so their number, not their size, sets the tasks. A frame is
    # closed at FRAME bytes, so its list of record ends is bounded by that.
    tasks = int(archive.index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = F.sort_array(F.collect_list(F.col("record_start") + F.col("record_size"))).alias("ends")
    frames = archive.index.groupBy("bundle", "frame").agg(ends).repartition(tasks)
    return frames.mapInArrow(opened, RECORDS)


def fetch(archive: Archive, page_ids: DataFrame) -> DataFrame:
    """The records of the given page ids, each read by its index row from one frame."""
    folder = archive.folder
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                content = frame_content(folder, row["bundle"], row["frame_start"], row["frame_size"])
                headers, body, _ = parse(content[row["record_start"] : row["record_start"] + row["record_size"]])
                rows.append(fields(headers, body))
            yield _batch(rows, schema)

    wanted = archive.index.join(page_ids.select("page_id").distinct(), "page_id")
    return wanted.select(*archive.index.columns).mapInArrow(picked, RECORDS)


def digests(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per row, read back from the archives."""
    return read(write(pages)).drop("payload")


ORACLE = """
WITH raw AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sized AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM raw),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
  CASE WHEN f.first IS NOT NULL AND s.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN s.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM sized s LEFT JOIN firsts f USING (payload_digest)
"""
