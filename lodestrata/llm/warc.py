"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

The reader decompresses a member piece by piece, frames the record by its Content-Length, and checks
the block and payload digests and that the member ends where the record does. Equal payloads from a
given size on are stored once, and the others refer to that record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

from .files import PartFile, filesystem

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_READ = 1 << 16
MOST_TASKS = 20_000
_ROLL = 256 << 20
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


class BrokenArchive(ValueError):
    """A record that cannot be framed or whose digest does not match."""


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in [*headers, ("WARC-Block-Digest", _digest(block)), ("Content-Length", str(len(block)))])]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class _Member:
    """The bytes of one gzip member, decompressed as they are asked for."""

    def __init__(self, stream: BinaryIO, waiting: bytes):
        self.stream, self.unpacker, self.waiting, self.ready = stream, zlib.decompressobj(31), waiting, bytearray()

    def _more(self) -> bool:
        if self.unpacker.eof:
            return False
        data = self.waiting or self.stream.read(_READ)
        if not data:
            raise BrokenArchive("the archive ends inside a record")
        try:
            self.ready += self.unpacker.decompress(data, _READ)
        except zlib.error as e:
            raise BrokenArchive(str(e)) from e
        self.waiting = self.unpacker.unconsumed_tail
        return True

    def until(self, end: bytes) -> bytes:
        at = 0
        while (found := self.ready.find(end, at)) < 0:
            at = max(0, len(self.ready) - len(end) + 1)
            if not self._more():
                raise BrokenArchive("a record's header does not end")
        return self.take(found + len(end))[:-len(end)]

    def take(self, size: int) -> bytes:
        while len(self.ready) < size:
            if not self._more():
                raise BrokenArchive("a record is shorter than its Content-Length")
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out

    def rest(self) -> bytes:
        """What follows this member in the archive; the member must be used up."""
        while not self.ready and self._more():
            pass
        if self.ready:
            raise BrokenArchive("a gzip member holds more than its record")
        return self.unpacker.unused_data


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, in order; digests are verified."""
    waiting = stream.read(_READ)
    while waiting:
        member = _Member(stream, waiting)
        version, *lines = member.until(b"\r\n\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/1."):
            raise BrokenArchive(f"not a record: {version[:20]!r}")
        headers = {}
        for line in lines:
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = member.take(int(headers["content-length"]))
        if member.take(4) != b"\r\n\r\n":
            raise BrokenArchive("a record does not end with two line ends")
        if headers.get("warc-block-digest", _digest(block)) != _digest(block):
            raise BrokenArchive(f"block digest of {headers.get('warc-record-id')}")
        waiting = member.rest() or stream.read(_READ)
        yield headers, block


def _page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    name = lambda i: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{i} {digest}')}>"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    headers += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("X-Payload-Length", str(len(payload)))]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    return record(headers, http + (payload if kind == "response" else b""))


def _page(headers: dict[str, str], block: bytes) -> tuple:
    number = lambda k: int(headers[k]) if k in headers else None
    expected = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    payload = None
    if headers["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != expected or len(payload) != number("x-payload-length"):
            raise BrokenArchive(f"payload digest of {headers.get('warc-record-id')}")
    return number("x-page-id"), number("x-payload-length"), expected, headers["warc-type"], number("x-refers-to-page-id"), headers.get("warc-target-uri"), payload


def _write(folder: str, date: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = None, []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                part = part or PartFile(folder, ".warc.gz")
                part.write(_page_record(*row, date))
                if part.size >= _ROLL:
                    part.close()
                    done.append(part)
                    part = None
        if part:
            part.close()
            done.append(part)
        yield pa.RecordBatch.from_arrays([pa.array([p.uri for p in done], pa.string()), pa.array([p.size for p in done], pa.int64())], names=["archive", "size"])

    return step


def _read(with_payload: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in _RECORDS.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for uri in batch["archive"].to_pylist():
                system, path = filesystem(uri)
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for headers, block in read_records(stream):
                        row = _page(headers, block)
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(block)
                        if held >= 8 << 20 or len(rows) >= 4096:
                            yield made(rows)
                            rows, held = [], 0
                yield made(rows)

    return step


def write_pages(
    spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = 1000, date: str = "2026-01-01T00:00:00Z", folder: str | None = None
) -> DataFrame:
    """Write a record per page and return (archive, size), one row per file.

    Of pages with equal bodies of ``least`` bytes or more, the one with the largest key is stored,
    and the others (null keys among them) become revisits of it; rows that share that key are all
    stored. Null bodies are empty, null urls and keys are left out of the record, and an empty
    table writes no file. The rows returned are committed by Spark; files that a lost attempt left
    behind are in none of them.
    """
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    long = rows.where(F.octet_length("payload") >= least)
    groups = long.groupBy("digest").agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "stored")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("stored")), F.col("stored")).alias("refers_to")
    ready = rows.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", refers)
    listing = f"{folder}/listing"
    ready.mapInArrow(_write(f"{folder}/archives", date), "archive string, size long").write.parquet(listing)
    return spark.read.parquet(listing)


def read_pages(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the listed archives; a revisit's payload is null, its length and digest are those of the full payload.

    The list is small and its files are not, so it is dealt out to as many tasks as it has files, up to ``MOST_TASKS``.
    """
    files = archives.select("archive")
    files = files.repartitionByRange(max(1, min(files.count(), MOST_TASKS)), "archive")
    out = files.mapInArrow(_read(with_payload), _RECORDS)
    return out if with_payload else out.drop("payload")
