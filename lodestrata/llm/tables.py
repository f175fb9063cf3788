"""Tables that operators of several rounds pass on: numbered rows, and a filter of fixed size over integer keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators.joins import FILTER_BITS, may_match  # noqa: F401
from lodestrata.session import scratch_path

from .wordhash import mix

_SECOND = np.uint64(0x9E3779B97F4A7C15)


def written(spark: SparkSession, rows: DataFrame, label: str, per_file: int = 0) -> DataFrame:
    """The rows as a table in the shared folder, read back; ``per_file`` bounds the rows of a file."""
    path = scratch_path(spark, label)
    rows.write.option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def numbered(spark: SparkSession, rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows with ``id`` from 1 in the given order, which must leave no ties.

    A distributed sort numbers the rows of each partition; only the partitions' counts meet in one task.
    """
    at = F.monotonically_increasing_id()
    kept = written(spark, rows.orderBy(*order).withColumn("_at", at), label)
    part = F.shiftright("_at", 33)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_part", F.expr("sum(n) OVER (ORDER BY _part) - n").alias("_before"))
    found = kept.join(F.broadcast(before), part == F.col("_part"))  # one row for each partition
    return found.select(*rows.columns, (F.col("_before") + F.col("_at") - F.shiftleft("_part", 33) + 1).alias("id"))


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed = mix(keys.astype(np.uint64))
    return hashed >> np.uint64(64 - FILTER_BITS), mix(hashed ^ _SECOND) >> np.uint64(64 - FILTER_BITS)


def key_filter(rows: DataFrame, key: str) -> np.ndarray:
    """A Bloom filter of ``2 ** FILTER_BITS`` bits over a long column, as 64-bit words; its size never depends on the rows."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False))))
            if not bits.size:
                continue
            words, starts = np.unique(bits >> np.uint64(6), return_index=True)
            masks = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), starts)
            yield pa.record_batch({"word": words.astype(np.int64), "mask": masks.view(np.int64)})

    merged = rows.select(key).mapInArrow(places, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[merged["word"].to_numpy()] = merged["mask"].to_numpy()
    return out.view(np.uint64)


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key can be in the filter; False is certain."""
    hit = lambda at: (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    first, second = _places(keys)
    return hit(first) & hit(second)
