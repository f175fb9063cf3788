"""Near-duplicate classes: BagMinHash signatures, banding, and an exact check of multiset overlap.

A text is a bag of five-word shingles, each with its count as weight. The weight line is cut at the
powers of two, and each piece (0, 1], (1, 2], (2, 4], ... of a shingle carries a Poisson process of
its own, seeded by the shingle and the piece. A point has a time, a register and a level; it counts
for a text if the level is within the shingle's count. A register keeps its earliest time, so two
texts agree in a register with probability equal to their weighted Jaccard similarity. Points are
made in order of time up to a horizon at which most registers are filled; texts with a register left
open go on to a further one. The work per text is its shingles plus about ``m ln m`` points,
whatever the weights.

Texts that agree in a band meet in a bucket. In each bucket all are compared with the least one,
exactly, which joins groups of copies with as many comparisons as rows. A bucket that still holds
more than one component is cut into blocks, and each pair of blocks is a task's work: texts of
different components are compared exactly, unless the share of equal registers is more than five
standard deviations below the threshold. No pairs leave the task but the links that join components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

from .components import components
from .memory import release
from .wordhash import mix, shingle_hashes, slices, weighted_jaccard

BANDS, ROWS = 32, 6
#: bits of the filter that finds the texts of nodes; what is broadcast are its 64-bit words, 2 ** 20 at most
_FILTER_BITS = 26
_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-53
#: rows and bytes of text in a block of a bucket, about
_BLOCK_ROWS, _BLOCK_BYTES = 512, 2 << 20
#: texts of about equal size go together, by their number of shingles
_CLASSES = (1, 8, 32, 128, 512, 2048, 1 << 62)


def _draw(state: np.ndarray) -> np.ndarray:
    return (mix(state) >> np.uint64(11)).astype(np.float64) * _UNIT


def _pieces(shingles: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each piece of a shingle's weight: seed, text, first level below it, width, and the weight."""
    if not shingles.size:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    head = np.r_[True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(head)
    weight = np.diff(np.r_[at, shingles.size])
    pieces = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    which = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.where(which == 0, 0, 1 << np.maximum(which - 1, 0))
    seed = mix(np.repeat(shingles[at], pieces) + _GAMMA * which.astype(np.uint64))
    return seed, np.repeat(owner[at], pieces), low, np.maximum(low, 1), np.repeat(weight, pieces)


def _fill(out: np.ndarray, seed: np.ndarray, owner: np.ndarray, low: np.ndarray, width: np.ndarray, weight: np.ndarray, horizon: np.ndarray, at_once: int) -> None:
    """Lower the registers by the points of all pieces, ``at_once`` points at a time, until none is open."""
    registers = out.shape[1]
    flat = out.reshape(-1)
    steps = _GAMMA * np.arange(1, at_once + 1, dtype=np.uint64)
    state, text, base, span, most, time = seed, owner, low, width, weight, np.zeros(seed.size)
    done = np.zeros(horizon.size)
    waiting: list[tuple] = []
    while state.size or waiting:
        while state.size:
            states = state[:, None] + steps
            waits = -np.log1p(-_draw(states)) / span[:, None]
            waits[:, 0] += time
            times = np.cumsum(waits, axis=1)
            hit = (times <= horizon[text][:, None]) & (times > done[text][:, None])
            row = np.nonzero(hit)[0]
            choice = mix(states[hit] ^ np.uint64(0xA0761D6478BD642F))
            register = ((choice >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            level = base[row] + 1 + ((choice & np.uint64(0xFFFFFFFF)) * span[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            counts = level <= most[row]
            np.minimum.at(flat, (text[row] * registers + register)[counts], times[hit][counts])
            on = times[:, -1] <= horizon[text]
            waiting.append(tuple(x[~on] for x in (state, text, base, span, most, time)))
            state, time = states[on, -1], times[on, -1]
            text, base, span, most = text[on], base[on], span[on], most[on]
        open_texts = np.isinf(out).any(axis=1)
        done, horizon = horizon, np.where(open_texts, horizon * 1.3, horizon)
        state, text, base, span, most, time = (np.concatenate(x) for x in zip(*waiting))
        take = open_texts[text]
        state, text, base, span, most, time = (x[take] for x in (state, text, base, span, most, time))
        waiting = []


def bag_minhash(shingles: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """A row of register values for each text; infinite where the text has no shingle."""
    sizes = np.diff(bounds)
    out = np.full((sizes.size, registers), np.inf)
    expected = registers * np.log(registers)
    for low, high in zip(_CLASSES, _CLASSES[1:]):
        texts = np.flatnonzero((sizes >= low) & (sizes < high))
        if texts.size:
            own = np.concatenate([shingles[bounds[i] : bounds[i + 1]] for i in texts])
            part = np.full((texts.size, registers), np.inf)
            pieces = _pieces(own, np.repeat(np.arange(texts.size), sizes[texts]))
            _fill(part, *pieces, horizon=1.1 * expected / sizes[texts], at_once=int(np.clip(0.3 * expected / low, 1, 64)))
            out[texts] = part
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            shingles, bounds = shingle_hashes(part["text"])
            values = bag_minhash(shingles, bounds, BANDS * ROWS)
            names = mix(np.ascontiguousarray(values).view(np.uint64))
            bands = np.zeros((part.num_rows, BANDS), np.uint64)
            for k in range(ROWS):
                bands = mix(bands * _GAMMA + names.reshape(-1, BANDS, ROWS)[:, :, k])
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
            full = np.flatnonzero(np.diff(bounds) > 0)
            short = (names[full] & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    part["node"].take(pa.array(full)),
                    pa.array(list(bands[full].view(np.int64)), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                    pc.binary_length(part["text"].take(pa.array(full))).cast(pa.int64()),
                ],
                names=["node", "bands", "signature", "size"],
            )
    release()


def _similar(threshold: float):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_u", "text_v"):
                left, a = shingle_hashes(part["text_u"])
                right, b = shingle_hashes(part["text_v"])
                keep = [
                    min(a[i + 1] - a[i], b[i + 1] - b[i]) >= threshold * max(a[i + 1] - a[i], b[i + 1] - b[i])
                    and weighted_jaccard(left[a[i] : a[i + 1]], right[b[i] : b[i + 1]]) >= threshold
                    for i in range(part.num_rows)
                ]
                yield pa.RecordBatch.from_arrays([part["u"].filter(pa.array(keep)), part["v"].filter(pa.array(keep))], names=["u", "v"])
        release()

    return step


class _Bags:
    """The shingle bags of a block, for the similarity of one to many."""

    def __init__(self, shingles: np.ndarray, bounds: np.ndarray):
        owner = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
        head = np.r_[True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])] if shingles.size else np.empty(0, bool)
        at = np.flatnonzero(head)
        self.ids = np.unique(shingles[at], return_inverse=True)[1]
        self.counts = np.diff(np.r_[at, shingles.size])
        self.starts = np.searchsorted(at, bounds)
        self.weights = np.zeros(self.ids.max(initial=-1) + 1, np.int64)
        self.sizes = np.diff(bounds)

    def similarities(self, one: int, many: np.ndarray) -> np.ndarray:
        a, b = self.starts[one], self.starts[one + 1]
        self.weights[self.ids[a:b]] = self.counts[a:b]
        lengths = self.starts[many + 1] - self.starts[many]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[many] - (ends - lengths), lengths)
        shared = np.add.reduceat(np.minimum(self.counts[at], self.weights[self.ids[at]]), ends - lengths)
        self.weights[self.ids[a:b]] = 0
        return shared / (self.sizes[one] + self.sizes[many] - shared)


def _joined(threshold: float):
    """Links that join different components within a block.

    A text is compared with all texts of other components whose signatures do not rule it out, the
    components as they stand after the links found before. So a block gives fewer links than rows.
    """
    least = threshold - 5 * (threshold * (1 - threshold) / (BANDS * ROWS)) ** 0.5

    def block(roots: np.ndarray, marks: np.ndarray, bags: _Bags, pairs: np.ndarray) -> Iterator[tuple[int, int]]:
        labels = np.unique(roots, return_inverse=True)[1]
        for i in range(roots.size):
            far = np.flatnonzero(pairs[i] & (labels != labels[i]) & (np.minimum(bags.sizes, bags.sizes[i]) >= threshold * np.maximum(bags.sizes, bags.sizes[i])))
            far = far[(marks[far] == marks[i]).mean(axis=1) >= least] if far.size else far
            if far.size:
                for j in far[bags.similarities(i, far) >= threshold]:
                    if labels[j] != labels[i]:
                        labels[labels == labels[j]] = labels[i]
                        yield i, j

    def step(table: pa.Table) -> pa.Table:
        table = table.sort_by([("band", "ascending"), ("c1", "ascending"), ("c2", "ascending")])
        band, c1, c2, chunk, nodes, roots = (table[c].to_numpy() for c in ("band", "c1", "c2", "chunk", "node", "root"))
        edges = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]), True])
        found = set()
        for a, b in zip(edges[:-1], edges[1:]):
            own, part = chunk[a:b], table.slice(a, b - a)
            pairs = np.triu(np.ones((b - a, b - a), bool), 1) if c1[a] == c2[a] else own[:, None] < own[None, :]
            marks = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint16).reshape(b - a, -1)
            links = block(roots[a:b], marks, _Bags(*shingle_hashes(part["text"])), pairs)
            found.update((max(p), min(p)) for p in ((int(nodes[a + i]), int(nodes[a + j])) for i, j in links))
        release()
        return pa.table({"u": pa.array([p[0] for p in found], pa.int64()), "v": pa.array([p[1] for p in found], pa.int64())})

    return step


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _one_of_each(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each text of the given nodes, once.

    A filter of fixed size, made from the upper bits of the nodes, is broadcast and tested in the scan. What passes,
    some other texts among it, is combined by node in every task, shuffled, and held against the
    nodes themselves. The plan is the same for any number of nodes.
    """
    nodes = _stored(nodes.distinct(), "nodes")
    word = F.shiftrightunsigned("node", 64 - _FILTER_BITS + 6)
    bit = f"cast(shiftrightunsigned(node, {64 - _FILTER_BITS}) & 63 AS int)"
    marks = nodes.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("mask"))
    maybe = texts.withColumn("word", word).join(F.broadcast(marks), "word").where(F.expr(f"shiftright(mask, {bit}) & 1 = 1"))
    return maybe.groupBy("node").agg(F.first("text").alias("text")).join(nodes.hint("shuffle_hash"), "node", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) of similar texts."""
    bodies = _one_of_each(texts, pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))))
    first = bodies.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    second = bodies.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(first, "u").join(second, "v").select("u", "v", "text_u", "text_v").mapInArrow(_similar(threshold), "u long, v long")


def linked_texts(spark: SparkSession, docs: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(node, root) for every text that is similar to another one; a node is the text's 64-bit hash.

    Texts that agree in a band and are similar end up with one root, whichever of them were compared.
    """

    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("node"), body.alias("text"))
    signed = _stored(texts.mapInArrow(_signatures, "node long, bands array<long>, signature binary, size long").dropDuplicates(["node"]), "signatures")
    entries = signed.select("node", F.explode("bands").alias("band"))
    buckets = _stored(entries.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("band", "least"), "buckets")
    met = _stored(entries.join(buckets, "band"), "met")
    stars = _stored(met.where("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v")).distinct(), "stars")
    links = _stored(_verified(stars, texts, threshold), "links")
    joined = components(spark, links)

    sizes = signed.select("node", "size")
    placed = met.select("node", "band").join(joined, "node", "left").select("node", "band", F.coalesce("root", "node").alias("root")).join(sizes, "node")
    open_buckets = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).where("low < high")
    chunks = F.ceil(F.greatest(F.col("n") / _BLOCK_ROWS, F.col("bytes") / _BLOCK_BYTES)).cast("int")
    left = placed.join(open_buckets, "band").select("band", "node", "root", "size", chunks.alias("chunks"), F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"))
    cells = left.select("band", "node", "root", "size", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with")).select(
        "band", "node", "root", "size", "chunk", F.least("chunk", "with").alias("c1"), F.greatest("chunk", "with").alias("c2")
    )
    cells = _stored(cells, "cells")
    total = cells.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // _BLOCK_BYTES))
    bodies = _one_of_each(texts, cells.select("node")).join(signed.select("node", "signature"), "node")
    dealt = cells.join(bodies, "node").withColumn("task", F.pmod(F.xxhash64("band", "c1", "c2"), F.lit(tasks)))
    more = _stored(dealt.groupBy("task").applyInArrow(_joined(threshold), "u long, v long").distinct(), "links")
    joined = components(spark, links.union(more))

    return joined.select("node", "root")


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(``key``, class_id, class_rows, node, class_node) for every row of ``docs``.

    Two texts belong together if they are equal or a chain of texts with a weighted Jaccard
    similarity of ``threshold`` or more links them. ``class_id`` is the least key of the class,
    ``class_rows`` its rows, ``node`` a hash of the text and ``class_node`` one of the class. Null
    texts are empty; texts without words are like equal texts only, and those of one to four words
    have one shingle. Keys may be null or repeated: null is never the least unless the class has no
    other. An empty table gives no rows.
    """
    linked = linked_texts(spark, docs, text, threshold)
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("node"))
    placed = rows.join(linked, "node", "left").select("key", "node", F.coalesce("root", "node").alias("class_node"))
    classes = placed.groupBy("class_node").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    return placed.join(classes, "class_node").select(F.col("key").alias(key), "class_id", "class_rows", "node", "class_node")


def survivors(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row of each class with all its columns: the least key, of ties the least hash of the text."""
    placed = near_duplicates(spark, docs, key, text, threshold)
    least = F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("key"), F.col("node").alias("node")))
    kept = placed.groupBy("class_node").agg(least.alias("k")).select(F.col("k.key").alias("_key"), F.col("k.node").alias("_node"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("node"))
    chosen = rows.join(kept, (F.col("node") == F.col("_node")) & F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    return chosen.dropDuplicates(["node", "key"]).select("row.*")
