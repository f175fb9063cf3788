"""Sharding by longest-processing-time scheduling.

Groups that must stay together go, largest first, to the least-loaded shard through a heap. Groups
above a share of the whole are few (a bound that follows from the share) and are placed first, in
one heap. The others are dealt in blocks, each with a heap of its own that starts from the large
groups' loads scaled to the block, so that every block evens out what is uneven.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

#: a group is large if it holds more than 1 / (shards x this) of all bytes
SHARE = 64
_BLOCK_GROUPS = 2000
_BLOCK_ROWS = 4000


def place(sizes: list[int], loads: list[float], turn: int = 0) -> list[int]:
    """A shard for each size, in the given order: the least loaded, of ties the next in turn."""
    shards = len(loads)
    heap = [(load, (i - turn) % shards, i) for i, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for size in sizes:
        load, order, shard = heap[0]
        heapq.heapreplace(heap, (load + size, order, shard))
        out.append(shard)
    return out


def _deal(loads: list[int], rest: int):
    def step(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("_key", "ascending")])
        sizes = table["bytes"].to_pylist()
        part = sum(sizes) / rest
        shards = place(sizes, [load * part for load in loads], table["block"][0].as_py())
        return pa.table({"_key": table["_key"], "shard": pa.array(shards, pa.int32())})

    return step


def assign_shards(spark: SparkSession, rows: DataFrame, group: Column, size: Column, shards: int) -> DataFrame:
    """``rows`` with ``shard``; rows with an equal binary ``group`` share one.

    Sizes must not be negative; ties of size go by the group's value. Null groups are one group. An
    empty table gives no rows. Rows must be readable twice with the same values.
    """
    keyed = rows.withColumn("_group", F.coalesce(group, F.lit(b"")))
    path = scratch_path(spark, "groups")
    keyed.groupBy(F.col("_group").alias("_key")).agg(F.sum(size).cast("long").alias("bytes")).write.parquet(path)
    groups = spark.read.parquet(path)
    totals = groups.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    limit = totals["bytes"] // (shards * SHARE)
    large = groups.where(F.col("bytes") > limit).orderBy(F.desc("bytes"), "_key").collect()  # fewer than shards * SHARE rows
    chosen = place([r["bytes"] for r in large], [0] * shards)
    loads = [0] * shards
    for r, shard in zip(large, chosen):
        loads[shard] += r["bytes"]
    blocks = max(1, -(-totals["n"] // _BLOCK_GROUPS))
    small = groups.where(F.col("bytes") <= limit).withColumn("block", F.pmod(F.xxhash64("_key"), F.lit(blocks)))
    dealt = small.groupBy("block").applyInArrow(_deal(loads, max(1, totals["bytes"] - sum(loads))), "_key binary, shard int")
    first = spark.createDataFrame([(bytes(r["_key"]), s) for r, s in zip(large, chosen)], "_key binary, shard int")
    return keyed.join(dealt.union(first), F.col("_group") == F.col("_key")).drop("_group", "_key")


def number_slots(rows: DataFrame, shards: int, order: list[str], total: int) -> DataFrame:
    """``rows`` with ``slot``, counted from 0 in each shard without gaps.

    Rows are numbered in buckets of a shard, and each bucket starts where the one before it ended.
    """
    buckets = max(1, -(-total // (shards * _BLOCK_ROWS)))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("n")).select("shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "_bucket").orderBy(*order)
    numbered = placed.withColumn("_place", F.row_number().over(within))
    return numbered.join(starts, ["shard", "_bucket"]).withColumn("slot", F.col("start") + F.col("_place") - 1).drop("_bucket", "_place", "start")


def shard_texts(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40, overhead: int = 16) -> DataFrame:
    """A shard and a slot for every row: (``key``, size, text_crc32, law, shard, slot, grown_shard).

    The law is ``bytes``: shards come out near equal in size, which is the text's UTF-8 bytes plus
    ``overhead``. Equal texts stay together; a null text has no bytes and goes with empty ones. A
    group larger than a shard's share fills its shard alone. Repeated rows and null keys are rows
    like others; an empty table gives no rows; other columns are left out.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    path = scratch_path(spark, "sized")
    docs.select(
        F.col(key).alias("key"), (F.octet_length(body).cast("long") + overhead).alias("size"), F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest")
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    placed = assign_shards(spark, rows.select("key", "size", "text_crc32", "digest"), F.col("digest"), F.col("size"), shards).drop("digest")
    numbered = number_slots(placed, shards, ["key", "text_crc32", "size"], rows.count())
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
