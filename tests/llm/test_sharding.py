import random
import zlib
from collections import defaultdict

from lodestrata.llm import sharding


def check(rows, got, shards):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == sorted(
        ((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in rows), key=str
    )
    slots, loads, groups = defaultdict(list), [0] * shards, defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        groups[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())
    return loads


def test_even_loads(spark):
    r = random.Random(1)
    rows = [(i, "".join(r.choice("abcé") for _ in range(int(r.paretovariate(1.2) * 20) % 5000))) for i in range(6000)]
    rows += [(i, "copy" * 30) for i in range(300)] + [(None, None), (None, ""), (7, None), (8, "x" * 20_000)]
    docs = spark.createDataFrame([(*x, 3) for x in rows], "doc_id long, text string, shard int").repartition(4)
    loads = check(rows, sharding.shard_texts(spark, docs, shards=8).collect(), 8)
    assert max(loads) - min(loads) < 0.002 * sum(loads) / 8


def test_a_group_larger_than_a_share(spark):
    rows = [(i, "same text of some length" * 9) for i in range(500)] + [(1000 + i, "a" * (i % 90)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    loads = sorted(check(rows, sharding.shard_texts(spark, docs, shards=5).collect(), 5))
    assert loads[4] >= 500 * (24 * 9 + 16) and loads[3] - loads[0] < 300


def test_empty_table(spark):
    assert sharding.shard_texts(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_heap_is_longest_processing_time():
    sizes = sorted([7, 7, 6, 6, 5, 4, 4, 4, 3, 1], reverse=True)
    loads = [0, 0, 0]
    for size, shard in zip(sizes, sharding.place(sizes, [0, 0, 0])):
        assert loads[shard] == min(loads)
        loads[shard] += size
