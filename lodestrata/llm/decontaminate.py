"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A window takes part if at least as many of its five-word shingles occur in items of its size, in
whatever order, as the similarity needs, and among them an anchor: one of the rarest shingles of an item, so many that
a window without any of them cannot reach the similarity. No other window can be alike. Its 64-bit SimHash, weighted
by shingle counts, is cut into ``radius + 1`` blocks: two fingerprints within the radius agree in at least one block.
At a similarity of 0.8 a sixth of the bits differ, and blocks short enough for the guarantee are shared by nearly all
fingerprints; so windows and items first meet at a common anchor, and the blocks are compared there, as masks of the
bits that differ, instead of a row for each. The weighted Jaccard similarity of the shingle bags then decides. All steps are column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import let
from .tables import may_match, written

SHINGLE = 5
#: A lane of 16 bits counts so many hashes without a carry into the next.
_LANE_MOST = (1 << 16) - 1


def plain_words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A hash for every five consecutive words; none for shorter texts."""
    hashes = let(words, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])))
    return F.when(F.size(words) >= SHINGLE, hashes).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """The 64 bits in which most of the hashes agree.

    Sums count several bits each: bit j + w l is lane l, of w bits, of sum j. Lanes have 16 bits, and
    32 where more hashes than ``_LANE_MOST`` could carry from one into the next.
    """

    def bits_by(width: int) -> Column:
        lanes = 64 // width
        mask = sum(1 << width * lane for lane in range(lanes))
        bits = F.lit(0).cast("long")
        for j in range(width):
            counted = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(mask)))
            for lane in range(lanes):
                count = F.shiftrightunsigned(counted, width * lane).bitwiseAND(F.lit((1 << width) - 1))
                bits = bits.bitwiseOR(F.shiftleft(F.when(2 * count > F.size(hashes), F.lit(1)).otherwise(F.lit(0)).cast("long"), j + width * lane))
        return bits

    return F.when(F.size(hashes) <= _LANE_MOST, bits_by(16)).otherwise(bits_by(32))


def share_block(one: Column, other: Column, radius: int) -> Column:
    """Whether two fingerprints have one of their ``radius + 1`` blocks in common, as any two within the radius have."""
    differ, any_block = one.bitwiseXOR(other), F.lit(False)
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    for a, b in zip(edges, edges[1:]):
        mask = ((1 << b) - (1 << a)) - (1 << 64 if b == 64 else 0)
        any_block = any_block | (differ.bitwiseAND(F.lit(mask)) == 0)
    return any_block


def _bag(df: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    return df.select(*keys, F.explode(hashes).alias("h")).groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("n"))


def _anchors(item_bag: DataFrame, similarity: float) -> DataFrame:
    """(item_row, h): each item's shingles that are rarest among all items, ties by their hash, with ``m - ceil(similarity * m) + 1`` of its ``m`` shingles.

    A window as similar has ``similarity * m`` of them at least, so not all of its shingles are others.
    """
    often = item_bag.groupBy("h").agg(F.sum("n").alias("items"))
    own = Window.partitionBy("item_row")  # as large as an item
    order = own.orderBy("items", "h").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(own)
    ranked = item_bag.join(often, "h").withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).withColumn("enough", total - F.ceil(similarity * total - 1e-9) + 1)
    return ranked.where(F.col("before") < F.col("enough")).select("item_row", "h")


def _places(hits: DataFrame, similarity: float) -> DataFrame:
    """(k, size, n_words, start, anchors) of all windows that hold enough of the hits (k, length, size, at, h, anchor), and the anchors among them.

    Window and item have ``n`` and ``m`` shingles, so the similarity needs ``s (n + m) / (1 + s)``
    common ones. Each start belongs to the first hit its window holds; so many hits on, there must be
    one within the window.
    """
    n_words = F.least("size", "length")
    anchored = F.collect_set(F.when(F.col("anchor"), F.struct("at", "h")))
    grouped = hits.groupBy("k", "size", "length").agg(F.sort_array(F.collect_set("at")).alias("ats"), anchored.alias("anchored"))
    shingles = F.col("n_words") - (SHINGLE - 1)
    needed = F.ceil(similarity * (shingles + F.col("size") - (SHINGLE - 1)) / (1 + similarity) - 1e-9).cast("int")
    enough = grouped.withColumn("n_words", n_words).withColumn("needed", F.greatest(needed, F.lit(1))).where((F.size("ats") >= F.col("needed")) & (F.size("anchored") > 0))

    def starts(i: Column) -> Column:
        low = F.greatest(F.get("ats", i + F.col("needed") - 1) - shingles + 1, F.coalesce(F.get("ats", i - 1) + 1, F.lit(0)), F.lit(0))
        high = F.least(F.get("ats", i), F.col("length") - F.col("n_words"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.sequence(F.lit(0), F.size("ats") - F.col("needed"))
    places = enough.select("k", "size", "n_words", "anchored", F.explode(F.flatten(F.transform(firsts, starts))).alias("start"))
    inside = F.filter("anchored", lambda a: (a["at"] >= F.col("start")) & (a["at"] < F.col("start") + shingles))
    return places.withColumn("anchors", F.array_distinct(F.transform(inside, lambda a: a["h"]))).drop("anchored").where(F.size("anchors") > 0)


def meeting(windows: DataFrame, items: DataFrame, anchors: DataFrame, radius: int) -> DataFrame:
    """Windows (k, start, size, n_words, print, anchors) beside the items of their size, once for each common anchor, where a block agrees."""
    left = windows.select("k", "start", "size", "n_words", "print", F.explode("anchors").alias("anchor"))
    right = items.select("item_row", "size", simhash(F.col("hashes")).alias("item_print")).join(anchors.withColumnRenamed("h", "anchor"), "item_row")
    return left.join(right, ["size", "anchor"]).where(share_block(F.col("print"), F.col("item_print"), radius))


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = 0.8, radius: int = 23) -> DataFrame:
    """(``key``, ``item``, similarity, start, n_words) for each row that holds a window like an item.

    ``start`` is the first word of the best window (the earliest of ties), counted in runs of
    letters and digits, and ``n_words`` its length: the item's, or the document's if that is
    shorter. Items and texts under five words, null or empty, match nothing. Equal items are each
    reported, repeated rows are reported once for each, and empty tables give no rows. Null keys are
    kept. At 0.8 the expected Hamming distance is about 10 of 64 bits; radius 23 is more than four
    standard deviations above.
    """
    spark = docs.sparkSession
    items = (
        benchmark.select(F.col(item).alias("item"), plain_words(F.col(item_text)).alias("w"))
        .select("item", F.size("w").alias("size"), shingle_hashes(F.col("w")).alias("hashes"))
        .where(F.size("hashes") > 0)
        .select(F.xxhash64("item", "hashes").alias("item_row"), "item", "size", "hashes")
    )
    # What several steps use is written once: as one plan, each use would bring all steps before it along, and the driver would hold them all.
    items = written(spark, items, "items")
    item_bag = _bag(items, ["item_row"], "hashes")
    anchors = written(spark, _anchors(item_bag, similarity), "anchors")
    named = items.select("item_row", "size").join(anchors, "item_row").select("size", "h").distinct().withColumn("anchor", F.lit(True))
    known = items.select("size", F.explode("hashes").alias("h")).distinct().join(named, ["size", "h"], "left").select("size", "h", F.coalesce("anchor", F.lit(False)).alias("anchor"))
    known = written(spark, known, "shingles")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    found = docs.select(digest.alias("k"), let(plain_words(F.col(text)), lambda w: F.struct(F.size(w).alias("length"), shingle_hashes(w).alias("hashes"))).alias("d"))
    hits = found.select("k", "d.length", F.posexplode("d.hashes").alias("at", "h"))
    hits = may_match(hits, known.select("h"), "h").join(known, "h")  # few shingles of the corpus get to the shuffle of this join
    places = written(spark, _places(hits, similarity), "places")

    spread = F.xxhash64("k").alias("_spread")
    bodies = docs.select(digest.alias("k"), F.col(text).alias("body")).select("k", "body", spread)
    # Few texts hold a place, and only they and a few that the filter lets by are shuffled; the join to the places drops the latter.
    # A semi join here would be pushed below the filter. Grouped by another key as well, copies are combined before the shuffle
    # instead of meeting in one task.
    inside = may_match(bodies, places.select(spread), "_spread").groupBy("k", "_spread").agg(F.first("body").alias("body"))
    inside = written(spark, inside, "inside")
    windows = (
        inside.select("k", shingle_hashes(plain_words(F.col("body"))).alias("all"))
        .join(places, "k")
        .select("k", "start", "size", "n_words", "anchors", F.slice("all", F.col("start") + 1, F.col("n_words") - (SHINGLE - 1)).alias("hashes"))
    )
    marked = windows.withColumn("print", simhash(F.col("hashes")))
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    pairs = meeting(marked, items, anchors, radius).where(near).select("k", "start", "size", "n_words", "item_row").distinct()
    pairs = written(spark, pairs, "pairs")

    window_bag = _bag(windows, ["k", "start", "size"], "hashes")
    shared = (
        pairs.join(window_bag, ["k", "start", "size"])
        .join(item_bag.withColumnRenamed("n", "m"), ["item_row", "h"])
        .groupBy("k", "start", "size", "n_words", "item_row")
        .agg(F.sum(F.least("n", "m")).alias("shared"))
    )
    sums = F.col("n_words") + F.col("size") - 2 * (SHINGLE - 1)
    alike = shared.withColumn("similarity", F.col("shared") / (sums - F.col("shared"))).where(F.col("similarity") >= similarity)
    best = alike.groupBy("k", "item_row").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("b"))
    named = best.join(items.select("item_row", "item"), "item_row").select("k", "item", F.col("b.similarity").alias("similarity"), (-F.col("b.before")).alias("start"), F.col("b.n_words").alias("n_words"))
    return docs.select(F.col(key).alias("doc"), digest.alias("k")).join(named, "k").select(F.col("doc").alias(key), F.col("item").alias(item), "similarity", "start", "n_words")
