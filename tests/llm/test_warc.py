import gzip
import hashlib
import io
import zlib

import pytest

from lodestrata.llm import warc

PAGES = [
    (1, "http://a.test/1", "x" * 1000),
    (2, "http://a.test/2", "x" * 1000),
    (9, None, "x" * 1000),
    (3, "http://a.test/3", "y" * 999),
    (4, "http://a.test/4", "y" * 999),
    (5, "http://a.test/ü\r\nBad: header", "é" * 500 + "\r\n\r\nWARC/1.1\r\n"),
    (6, "http://a.test/6", None),
    (7, "http://a.test/7", ""),
    (None, "http://a.test/8", "x" * 1000),
    (9, "http://a.test/9", "x" * 1000),
    (10, "http://a.test/10", "long " * 100_000),
    (11, "http://a.test/11", "long " * 100_000),
]


def expected(pages):
    bodies = [(p or "").encode() for _, _, p in pages]
    out = []
    for (key, _, _), body in zip(pages, bodies):
        same = [k for (k, _, _), b in zip(pages, bodies) if b == body and k is not None]
        stored = max(same, default=None)
        refers = stored if len(body) >= 1000 and stored is not None and key != stored else None
        out.append((key, len(body), hashlib.sha1(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_write_and_read(spark, tmp_path):
    rows = spark.createDataFrame([(*p, "d") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_pages(spark, rows, folder=f"file://{tmp_path}")
    got = warc.read_pages(archives).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(PAGES)
    for r in got:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    for uri in [r["archive"] for r in archives.collect()]:
        data = open(uri.removeprefix("file://"), "rb").read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") >= 1


def test_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_pages(spark, rows, folder=str(tmp_path))
    assert archives.count() == 0 and warc.read_pages(archives).count() == 0


def some_records():
    return [warc.record([("WARC-Type", "response"), ("X-Number", str(i))], bytes([i]) * (i * 70_000)) for i in range(4)]


class Slow(io.RawIOBase):
    """A stream that gives a few bytes at a time."""

    def __init__(self, data):
        self.data, self.at = data, 0

    def read(self, size=-1):
        self.at, start = self.at + min(7, size), self.at
        return self.data[start : self.at]


@pytest.mark.parametrize("stream", [io.BytesIO, Slow])
def test_members_in_order(stream):
    found = list(warc.read_records(stream(b"".join(some_records()))))
    assert [(h["x-number"], len(b)) for h, b in found] == [(str(i), i * 70_000) for i in range(4)]


def test_broken_archives_fail():
    whole = b"".join(some_records())
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_records(io.BytesIO(whole[:-5])))
    plain = zlib.decompress(some_records()[1], 31)
    for change in (plain.replace(b"\x01" * 10, b"\x02" * 10, 1), plain.replace(b"Content-Length: 70000", b"Content-Length: 70001"), plain + b"more", b"HTTP" + plain):
        with pytest.raises(warc.BrokenArchive):
            list(warc.read_records(io.BytesIO(gzip.compress(change))))


def test_archives_are_read_by_several_tasks(spark):
    from pyspark.sql import functions as F

    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit("http://a.test/").alias("url"), F.col("id").cast("string").alias("html")).repartition(12)
    archives = warc.write_pages(spark, pages)
    found = warc.read_pages(archives, with_payload=False)
    assert archives.count() > 4 and found.count() == 60
    assert found.select(F.spark_partition_id()).distinct().count() > 2
