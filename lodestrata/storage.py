"""Files beside Spark's own readers and writers: names taken once, and files that tasks read piece by piece."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of a file that are in memory at once
PIECE = 8 << 20
MOST_TASKS = 20_000


class ConflictError(RuntimeError):
    """Another writer has committed since this one read the table."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """A file with the text, complete as soon as it is there; ``ConflictError`` if the name is taken.

    The file is written under another name and renamed without overwriting. On HDFS that is atomic;
    on other stores it is as good as their rename.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    half = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = system.create(half, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not move_if_absent(spark, half.toString(), path):
        system.delete(half, False)
        raise ConflictError(f"{path} was committed by another writer")


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file or folder its final name, unless that is taken."""
    hadoop, settings = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    system = hadoop.Path(target).getFileSystem(settings)
    if system.exists(hadoop.Path(target)):
        return False
    files = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri(), settings)
    kept = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(system.makeQualified(hadoop.Path(source)), system.makeQualified(hadoop.Path(target)), kept)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it; ``s3a`` is a name for ``s3``."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def dealt(files: DataFrame, column: str = "path") -> DataFrame:
    """A list of files in as many tasks as it has files; Spark itself would put so short a list in one."""
    return files.repartitionByRange(max(1, min(files.count(), MOST_TASKS)), column)


def _checked(piece: int):
    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                system, path = filesystem(uri)
                digest, size = hashlib.md5(usedforsecurity=False), 0
                with system.open_input_file(path) as f:
                    while data := f.read(piece):
                        digest.update(data)
                        size += len(data)
                    f.seek(0)
                    rows = pq.read_metadata(f).num_rows
                yield pa.record_batch([pa.array([uri]), pa.array([digest.hexdigest()]), pa.array([size]), pa.array([rows])], names=["path", "md5", "size", "rows"])

    return step


def file_digests(files: DataFrame, piece: int = PIECE) -> DataFrame:
    """(path, md5, size, rows) of Parquet files, read piece by piece; rows are those of the footer."""
    return dealt(files.select("path")).mapInArrow(_checked(piece), "path string, md5 string, size long, rows long")


def _footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch["path"].to_pylist():
            system, path = filesystem(uri)
            with system.open_input_file(path) as f:
                found = pq.read_metadata(f)
            size = sum(found.row_group(g).column(c).total_compressed_size for g in range(found.num_row_groups) for c in range(found.num_columns))
            yield pa.record_batch([pa.array([uri]), pa.array([found.num_rows]), pa.array([size])], names=["path", "rows", "size"])


def footer_counts(files: DataFrame) -> DataFrame:
    """(path, rows, size) of Parquet files from their footers: rows, and compressed bytes of their columns."""
    return dealt(files.select("path")).mapInArrow(_footers, "path string, rows long, size long")


def decoded(column: str) -> Column:
    """A URL-encoded path as it is on storage."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))
