"""Token counts of documents in flat token files that have no index.

A token file is a run of fixed-width ids; an identifier that no text can produce ends each document.
Files are scanned in blocks, each on its own, for that identifier. A document that crosses blocks
is stitched with a prefix scan: each block learns how many separators come before it and where the
last one is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

from .files import PartFile, filesystem
from .memory import release
from .tables import written

MOST_TASKS = 100_000
_ROLL = 256 << 20


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def _write(folder: str, ranks: bytes, pattern: str, separator: int, dtype: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, part, place = _encoding(ranks, pattern), None, 0
        for batch in batches:
            where = []
            for text in batch["text"].to_pylist():
                if part is None or part.size >= _ROLL:
                    if part:
                        part.close()
                    part, place = PartFile(folder, ".tokens"), 0
                ids = encoding.encode_ordinary(text)
                ids.append(separator)
                part.write(np.array(ids, dtype).tobytes())
                where.append((part.uri, place))
                place += 1
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array([w[0] for w in where], pa.string()), pa.array([w[1] for w in where], pa.int64())], names=["key", "file", "place"])
        if part:
            part.close()
        release()

    return step


def write_token_files(
    spark: SparkSession, docs: DataFrame, ranks: bytes, pattern: str, separator: int, key: str = "doc_id", text: str = "text", dtype: str = "<u2", folder: str | None = None
) -> DataFrame:
    """Write all texts as ids with a separator after each, and return the order: (key, file, place).

    Null texts are empty: only their separator is written. The order is committed by Spark, so files
    of lost attempts are in no row of it; it holds no lengths. An empty table writes no file.
    """
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"key {dict(rows.dtypes)['key']}, file string, place long"
    rows.mapInArrow(_write(f"{folder}/files", ranks, pattern, separator, dtype), schema).write.parquet(f"{folder}/order")
    return spark.read.parquet(f"{folder}/order")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for uri in batch["file"].to_pylist():
            system, path = filesystem(uri)
            sizes.append(system.get_file_info(path).size)
        yield pa.RecordBatch.from_arrays([batch["file"], pa.array(sizes, pa.int64())], names=["file", "size"])


def _scan(separator: int, dtype: str):
    width = np.dtype(dtype).itemsize

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, size in zip(*(batch[c].to_pylist() for c in ("file", "start", "size"))):
                system, path = filesystem(uri)
                with system.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(size * width, start * width), dtype)
                ends = np.flatnonzero(ids == separator) + start
                last = int(ends[-1]) if ends.size else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), *(pa.array([n], pa.int64()) for n in (start, start + ids.size, ends.size, last)), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "start", "stop", "n_ends", "last", "ends"],
                )

    return step


def count_tokens(files: DataFrame, separator: int, dtype: str = "<u2", block_tokens: int = 1 << 21) -> DataFrame:
    """(file, place, n_tokens, closed) for each document of the token files in column ``file``.

    ``place`` counts the documents of a file from 0. Ids after a file's last separator are a document
    that is not closed; empty files have none. Files whose size is no whole number of ids fail.
    """
    width = np.dtype(dtype).itemsize
    sized = files.select("file").distinct().mapInArrow(_sizes, "file string, size long")
    whole = F.when(F.col("size") % width == 0, (F.col("size") / width).cast("long")).otherwise(F.raise_error(F.concat(F.lit("broken token file "), "file")).cast("long"))
    spark = files.sparkSession
    blocks = (
        sized.select("file", whole.alias("n"))
        .where("n > 0")
        .select("file", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block_tokens).cast("long"))).alias("start"))
        .select("file", "start", F.least(F.lit(block_tokens), F.col("n") - F.col("start")).alias("size"))
    )
    blocks = written(spark, blocks, "token-blocks")
    # The list of blocks is small and what they name is not: without a number Spark would read all of them in one task.
    dealt = blocks.repartitionByRange(max(1, min(blocks.count(), MOST_TASKS)), "file", "start")
    found = written(spark, dealt.mapInArrow(_scan(separator, dtype), "file string, start long, stop long, n_ends long, last long, ends array<long>"), "token-ends")
    # Only counts and last separators pass through the window; the places themselves are joined to its result.
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    light = found.select(
        "file",
        "start",
        "stop",
        "n_ends",
        "last",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("prior"),
        F.lead("stop").over(order).alias("after"),
    )
    stitched = found.select("file", "start", "ends").join(light.select("file", "start", "first", "prior"), ["file", "start"])
    closed = stitched.select("file", "first", "prior", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file",
        (F.col("first") + F.col("i")).alias("place"),
        (F.col("end") - F.when(F.col("i") > 0, F.get("ends", F.col("i") - 1)).otherwise(F.col("prior")) - 1).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    final = F.coalesce("last", "prior")
    tail = light.where("after is null").select("file", (F.col("first") + F.col("n_ends")).alias("place"), (F.col("stop") - 1 - final).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.union(tail.where("n_tokens > 0"))


def count_documents(spark: SparkSession, docs: DataFrame, ranks: bytes, pattern: str, separator: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, n_tokens) for every row: its text goes through token files and is counted there."""
    order = write_token_files(spark, docs, ranks, pattern, separator, key, text)
    counted = count_tokens(order, separator)
    # The order compresses well, so its size on disk would mislead Spark into broadcasting it.
    return order.hint("merge").join(counted, ["file", "place"]).select(F.col("key").alias(key), "n_tokens")
