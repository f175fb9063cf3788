"""Phrase collocation mining by direct-address tiling.

Words that are frequent in their language get ids by frequency. Adjacent ids are pairs; the plane of
pairs is cut into square tiles. A tile with many pairs is counted by a dense bincount over its cells,
the others together as sorted coordinates with counts. Frequent pairs get ids by frequency in turn,
and two that overlap in all but their end words are a pair of the next round, so phrases of k words
are pairs of phrases of k - 1 words. Each round reads arrays of ids, from which everything that cannot
be part of a longer frequent phrase is gone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory
from .tables import key_filter, may_hold, numbered, written
from .wordhash import mix, slices

LONGEST = 5
LEAST = 100
BEST = 2000

#: side of a tile, a power of two, and the share of its cells from which a tile is counted densely
TILE_BITS = 10
DENSE = 1 / 8
#: tiles that may be dense have both numbers below this
_NEAR = 16
#: bytes of text that share a dictionary, ids in a row of arrays, and counted pairs a task holds before it merges them
GROUP_BYTES = 16 << 20
_ROW_IDS = 1 << 20
_HELD = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 for a byte of a word, 1 for a blank, 2 for the end of a piece
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2


def words_of(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """The distinct words of the texts, and an array of their places in it from 1 on; 0 stands between pieces."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[data]
    edge = np.diff(np.r_[0, (kind == 0).view(np.int8), 0].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not starts.size:
        return pa.array([], pa.string()), np.empty(0, np.int32)
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.StringArray.from_buffers(starts.size, pa.py_buffer(offsets), pa.py_buffer(data[kind == 0])).dictionary_encode()
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
    cuts = np.r_[0, np.cumsum(np.diff(pieces) != 0)]
    codes = np.zeros(starts.size + int(cuts[-1]), np.int32)
    codes[np.arange(starts.size) + cuts] = words.indices.to_numpy() + 1
    return words.dictionary, codes


def _as_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _rows_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The array in parts of about ``_ROW_IDS`` ids, cut between pieces only."""
    ends = np.flatnonzero(codes == 0)
    at = 0
    while at < codes.size:
        cut = np.searchsorted(ends, at + _ROW_IDS)
        end = int(ends[cut]) + 1 if cut < ends.size else codes.size
        yield codes[at:end]
        at = end


def _encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    group = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal group
        words, codes = words_of(held.pop(lang))
        sizes.pop(lang)
        if not len(words):
            return
        counts = np.bincount(codes, minlength=len(words) + 1)[1:]
        for i, part in enumerate(_rows_of(codes)):
            whole = [_as_list(x) if i == 0 else pa.nulls(1, pa.list_(x.type)) for x in (words, pa.array(counts))]
            yield pa.record_batch([pa.array([group]), pa.array([lang]), *whole, pa.array([part.tobytes()])], names=["group", "lang", "items", "counts", "codes"])
        group += 1

    for batch in batches:
        for part in slices(batch, "text"):
            for lang, text in zip(part["lang"].to_pylist(), part["text"].cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                if sizes[lang] >= GROUP_BYTES or sum(sizes.values()) >= 2 * GROUP_BYTES:
                    yield from flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield from flush(lang)
    memory.release()


def count_pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of neighbouring ids, the first in the upper 32 bits, in order, and their counts."""
    left, right = codes[:-1], codes[1:]
    both = (left > 0) & (right > 0)
    left, right = left[both].astype(np.int64), right[both].astype(np.int64)
    near = (left < _NEAR << TILE_BITS) & (right < _NEAR << TILE_BITS)
    tile = np.where(near, (left >> TILE_BITS) * _NEAR + (right >> TILE_BITS), 0).astype(np.uint16)
    dense = np.flatnonzero(np.bincount(tile[near], minlength=_NEAR * _NEAR) >= DENSE * (1 << 2 * TILE_BITS))
    chosen = near & np.isin(tile, dense) if dense.size else np.zeros(left.size, bool)
    found, counts = np.unique((left[~chosen] << 32) | right[~chosen], return_counts=True)
    keys, sums = [found], [counts]
    if dense.size:
        tile, left, right, side = tile[chosen], left[chosen], right[chosen], (1 << TILE_BITS) - 1
        order = np.argsort(tile, kind="stable")
        cells = (((left & side) << TILE_BITS) | (right & side))[order]
        ends = np.r_[0, np.cumsum(np.bincount(tile, minlength=_NEAR * _NEAR)[dense])]
        for t, a, b in zip(dense, ends[:-1], ends[1:]):
            table = np.bincount(cells[a:b], minlength=1 << 2 * TILE_BITS)
            cell = np.flatnonzero(table)
            keys.append((((t // _NEAR << TILE_BITS) + (cell >> TILE_BITS)) << 32) | ((t % _NEAR << TILE_BITS) + (cell & side)))
            sums.append(table[cell])
    return merge_counts(keys, sums) if dense.size else (found, counts)


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted array of distinct keys with the sums of their counts."""
    key, count = np.concatenate([np.empty(0, np.int64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if key.size else np.empty(0, np.int64)
    return key[first], (np.add.reduceat(count, first) if first.size else count[:0])


class _Counts:
    """Counted pairs of a task, merged whenever they have doubled."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size, self.limit = [], [], 0, _HELD

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += keys.size
        if self.size > self.limit:
            self.merge()
            self.limit = max(_HELD, 2 * self.size)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        key, count = merge_counts(self.keys, self.counts)
        self.keys, self.counts, self.size = [key], [count], key.size
        return key, count


def _pair_counts(arrays: DataFrame, least: int, buckets: int) -> DataFrame:
    """(left, right, a) of every pair of neighbouring ids that occurs ``least`` times or more.

    Each task counts what it has; counted pairs go by a hash to a bucket as packed arrays, so that a
    frequent pair is one entry for each task and no bucket is larger than others.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Counts()

        def packed() -> Iterator[pa.RecordBatch]:
            key, sums = total.merge()
            bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            ends = np.r_[0, np.cumsum(np.bincount(bucket, minlength=buckets))]
            for b in np.flatnonzero(np.diff(ends)):
                at = order[ends[b] : ends[b + 1]]
                steps, few = np.diff(key[at], prepend=0), sums[at]
                kind = "<i8" if few.max() >= 1 << 16 else "<u2" if few.max() >= 256 else "u1"
                planes = np.ascontiguousarray(steps.astype("<i8").view(np.uint8).reshape(-1, 8).T)  # like bytes together pack well
                yield pa.record_batch([pa.array([int(b)], pa.int32()), pa.array([planes.tobytes()]), pa.array([kind]), pa.array([few.astype(kind).tobytes()])], names=["bucket", "steps", "kind", "counts"])
            total.__init__()

        for batch in batches:
            for codes in batch["codes"]:
                total.add(*count_pairs(np.frombuffer(codes.as_buffer(), np.int32)))
                if total.size > 4 * _HELD:
                    yield from packed()
        yield from packed()
        memory.release()

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Counts()
        for batch in batches:
            for steps, kind, counts in zip(batch["steps"], batch["kind"].to_pylist(), batch["counts"]):
                planes = np.frombuffer(steps.as_buffer(), np.uint8).reshape(8, -1)
                keys = np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())
                total.add(keys, np.frombuffer(counts.as_buffer(), kind).astype(np.int64))
        key, sums = total.merge()
        key, sums = key[sums >= least], sums[sums >= least]
        yield pa.record_batch({"key": key, "left": key >> 32, "right": key & 0xFFFFFFFF, "a": sums})
        memory.release()

    partial = arrays.select("codes").mapInArrow(count, "bucket int, steps binary, kind string, counts binary")
    return partial.repartition("bucket").mapInArrow(add_up, "key long, left long, right long, a long")


def _possible(words: object, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of pairs in place of arrays of ids: each row's possible keys, and places in them from 1 on."""
    for batch in batches:
        for group, lang, codes in zip(batch["group"].to_pylist(), batch["lang"].to_pylist(), batch["codes"]):
            ids = np.frombuffer(codes.as_buffer(), np.int32).astype(np.int64)
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            key = (ids[:-1] << 32) | ids[1:]
            at = np.flatnonzero(both)
            at = at[may_hold(words.value, key[at])]
            if at.size:
                keys, places = np.unique(key[at], return_inverse=True)
                found = np.zeros(key.size, np.int32)
                found[at] = places + 1
                yield pa.record_batch([pa.array([group]), pa.array([lang]), _as_list(pa.array(keys)), pa.array([_squeezed(found).tobytes()])], names=["group", "lang", "items", "codes"])
    memory.release()


def _squeezed(codes: np.ndarray) -> np.ndarray:
    """The array without zeros after a zero."""
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]] if codes.size else codes


def _renumber(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, (group, lang) in enumerate(zip(batch["group"].to_pylist(), batch["lang"].to_pylist())):
            codes = np.frombuffer(batch["codes"][i].as_buffer(), np.int32)
            known = batch["known"][i].values
            table = np.zeros(int(codes.max(initial=0)) + 1, np.int32)
            place, number = (known.field(c).flatten().to_numpy() for c in ("places", "ids"))
            inside = place < table.size
            table[place[inside]] = number[inside]
            new = _squeezed(table[codes])
            if new.size > 1:
                yield pa.record_batch([pa.array([group]), pa.array([lang]), pa.array([new.tobytes()])], names=["group", "lang", "codes"])
    memory.release()


def item_hashes(items: pa.Array) -> np.ndarray:
    """A hash for each text or integer, the same in every task."""
    if pa.types.is_integer(items.type):
        return mix(items.to_numpy().view(np.uint64))
    items = items.cast(pa.large_string())
    offsets = np.frombuffer(items.buffers()[1], np.int64, len(items) + 1, items.offset * 8)
    data = np.frombuffer(items.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(size.max(initial=0)), 0x100000001B3, np.uint64)], dtype=np.uint64)
    place = np.arange(data.size) - np.repeat(offsets[:-1], size)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)]
    return mix(sums[offsets[1:]] - sums[offsets[:-1]])


def _dealt(rows: DataFrame, buckets: int, kind: str, numbers: str) -> DataFrame:
    """Lists of items and numbers of (group, lang, items, ``numbers``), cut by the items' hashes into one list for each bucket.

    Without numbers, these are the places in the list, from 1 on.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (group, lang) in enumerate(zip(batch["group"].to_pylist(), batch["lang"].to_pylist())):
                items = batch["items"][i].values
                number = batch["numbers"][i].values if numbers else pa.array(np.arange(1, len(items) + 1))
                bucket = (item_hashes(items) % np.uint64(buckets)).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")
                ends = np.r_[0, np.cumsum(np.bincount(bucket, minlength=buckets))]
                here = np.flatnonzero(np.diff(ends))
                bounds = pa.array(np.r_[ends[here], ends[-1]].astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, x.take(pa.array(order))) for x in (items, number)]
                yield pa.record_batch([pa.array(here.astype(np.int32)), pa.array([group] * here.size, pa.int64()), pa.array([lang] * here.size, pa.string()), *lists], names=["bucket", "group", "lang", "items", "numbers"])

    chosen = rows.select("group", "lang", "items", *([F.col(numbers).alias("numbers")] if numbers else []))
    return chosen.mapInArrow(cut, f"bucket int, group long, lang string, items array<{kind}>, numbers array<long>")


def _word_counts(groups: DataFrame, least: int, buckets: int) -> DataFrame:
    """(lang, phrase, a) of the words that occur ``least`` times or more; each bucket adds up its share of all dictionaries."""

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, _HELD

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("a", "sum")]).rename_columns(["lang", "phrase", "a"])

        for batch in batches:
            lengths = pc.list_value_length(batch["items"]).to_numpy()
            lang = batch["lang"].take(pa.array(np.repeat(np.arange(batch.num_rows), lengths)))
            held.append(pa.table({"lang": lang, "phrase": batch["items"].flatten(), "a": batch["numbers"].flatten()}))
            size += held[-1].num_rows
            if size > limit:
                held = [merged()]
                size = held[0].num_rows
                limit = max(_HELD, 2 * size)
        if held:
            table = merged()
            yield from table.filter(pc.greater_equal(table["a"], least)).to_batches()
        memory.release()

    return _dealt(groups, buckets, "string", "counts").repartition("bucket").mapInArrow(add_up, "lang string, phrase string, a long")


def _listed(known: DataFrame, kind: str) -> DataFrame:
    """Rows of (lang, item, id) as lists for ``_dealt``; they have no group."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch["lang"]):
                part = batch.filter(pc.equal(batch["lang"], lang))
                yield pa.record_batch([pa.nulls(1, pa.int64()), pa.array([lang.as_py()]), _as_list(part["item"]), _as_list(part["id"])], names=["group", "lang", "items", "ids"])

    return known.mapInArrow(pack, f"group long, lang string, items array<{kind}>, ids array<long>")


def _by_number(arrays: DataFrame, known: DataFrame, kind: str, buckets: int) -> DataFrame:
    """Arrays of ids: the places in each group's dictionary give way to the ids of (lang, item, id).

    Dictionaries and known items meet in buckets, packed; a group gets back a list from each bucket.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, of_lang = None, {}
        for batch in batches:
            for i, (at, group, lang) in enumerate(zip(*(batch[c].to_pylist() for c in ("bucket", "group", "lang")))):
                if at != bucket:
                    bucket, of_lang = at, {}
                items, numbers = batch["items"][i].values, batch["numbers"][i].values
                if group is None:
                    of_lang.setdefault(lang, []).append((items, numbers))
                elif lang in of_lang:
                    if isinstance(of_lang[lang], list):
                        of_lang[lang] = tuple(pa.concat_arrays(x) for x in zip(*of_lang[lang]))
                    values, ids = of_lang[lang]
                    hit = pc.index_in(items, value_set=values)
                    there = pc.is_valid(hit)
                    columns = [_as_list(numbers.filter(there).cast(pa.int32())), _as_list(ids.take(hit.filter(there)).cast(pa.int32()))]
                    yield pa.record_batch([pa.array([group]), *columns], names=["group", "places", "ids"])
        memory.release()

    both = _dealt(arrays.where(F.col("items").isNotNull()), buckets, kind, "").unionByName(_dealt(_listed(known, kind), buckets, kind, "ids"))
    met = both.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("group"))
    found = met.mapInArrow(find, "group long, places array<int>, ids array<int>")
    of_group = found.groupBy("group").agg(F.collect_list(F.struct("places", "ids")).alias("known"))  # a list for each bucket
    joined = arrays.select("group", "lang", "codes").join(of_group.hint("shuffle_hash"), "group")  # one plan at every size
    return joined.mapInArrow(_renumber, "group long, lang string, codes binary")


def frequent_phrases(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and for each length a table (id, lang, a, ...) of all phrases that occur ``least`` times or more.

    Words have ``phrase``; longer phrases have ``left`` and ``right``, the ids of the phrases without
    their last and their first word.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    buckets = min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 15)
    groups = written(spark, texts.mapInArrow(_encode, "group long, lang string, items array<string>, counts array<long>, codes binary"), "phrase-words", per_file=16)
    dictionary = groups.where(F.col("items").isNotNull())
    totals = dictionary.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c)).alias("n"))
    counted = numbered(spark, _word_counts(dictionary, least, buckets), [F.desc("a"), F.asc("lang"), F.asc("phrase")], "phrase-order-1")
    levels = [written(spark, counted, "phrase-1")]
    arrays = written(spark, _by_number(groups, levels[0].select("lang", F.col("phrase").alias("item"), "id"), "string", buckets), "phrase-ids-1", per_file=16)
    while len(levels) < longest:
        found = numbered(spark, _pair_counts(arrays, least, buckets), [F.desc("a"), F.asc("key")], f"phrase-order-{len(levels) + 1}")
        found = written(spark, found, f"phrase-{len(levels) + 1}")
        levels.append(found)
        if len(levels) < longest:
            words = spark.sparkContext.broadcast(key_filter(found, "key"))
            possible = arrays.mapInArrow(lambda batches, words=words: _possible(words, batches), "group long, lang string, items array<long>, codes binary")
            possible = written(spark, possible.withColumn("group", F.monotonically_increasing_id()).withColumn("lang", F.lit("")), f"phrase-possible-{len(levels)}", per_file=64)
            arrays = written(spark, _by_number(possible, found.select(F.lit("").alias("lang"), F.col("key").alias("item"), "id"), "long", buckets), f"phrase-ids-{len(levels)}", per_file=64)
    return totals, levels


def _least_cut(a: Column, n: Column, fronts: Column, backs: Column) -> Column:
    """The cut of the lowest score, of equal ones that after the fewest words: struct(score, k, l, r)."""
    wide = "decimal(38,0)"

    def cut(left: Column, k: Column) -> Column:
        right = F.element_at(backs, F.size(backs) - k)
        score = F.call_function("div", (a.cast("decimal(19,0)") * n.cast("decimal(19,0)")).cast(wide) * F.lit(1000).cast("decimal(4,0)"), left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))
        return F.struct(score.cast("long").alias("score"), (k + 1).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(fronts, cut))


def collocations(
    spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, share: int = 100, best: int = BEST
) -> DataFrame:
    """(lang, rank, phrase, words, a, l, r, n, score): each language's first ``best`` phrases.

    A to Z count as a to z; texts end, and pieces of a text end, at ``.,;:!?`` and line breaks; words are runs
    of anything but blanks and tabs. A phrase of two words or more that occurs a >= ``least`` times is a
    candidate; it goes if a longer phrase that holds its words in a row occurs in ``share`` per cent of
    its places or more. Its score is the lowest over its cuts of floor(1000 * a * n / (l * r)), n being the
    language's words and l and r the occurrences of both parts. Order: score, a, both falling, then phrase.

    A null text is empty, a null language ``und``; repeated rows count each, in no table there are no
    phrases, and other columns are not read. Products are exact up to 38 digits.
    """
    totals, levels = frequent_phrases(spark, docs, text, lang, least, longest)
    known = levels[0].select("id", "lang", "phrase", F.col("phrase").alias("last"), F.array("a").alias("fronts"), F.array("a").alias("backs"), "a")
    parts = []
    for level in levels[1:]:
        front = known.select(F.col("id").alias("left"), "lang", "phrase", "fronts")
        back = known.select(F.col("id").alias("right"), "last", "backs")
        longer = level.select("id", "left", "right", "a").join(front, "left").join(back, "right")
        found = written(spark, longer.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", F.array_append("fronts", F.col("a")).alias("fronts"), F.array_append("backs", F.col("a")).alias("backs"), "a"), "phrase-known")
        if parts:
            parts[-1] = parts[-1].join(_most(level), "id", "left")
        parts.append(found)
        known = found
    parts[-1] = parts[-1].withColumn("longer", F.lit(None).cast("long"))
    rows = None
    for words, part in enumerate(parts, 2):
        left = part.where(F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("a") * share).select("lang", "phrase", F.lit(words).alias("words"), "a", F.slice("fronts", 1, words - 1).alias("fronts"), F.slice("backs", 1, words - 1).alias("backs"))
        rows = left if rows is None else rows.unionByName(left)
    scored = rows.join(totals, "lang").withColumn("cut", _least_cut(F.col("a"), F.col("n"), F.col("fronts"), F.col("backs")))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase ASC)")
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def _most(level: DataFrame) -> DataFrame:
    """(id, longer): how often the most frequent phrase of one word more occurs that begins or ends with the phrase."""
    ends = level.select(F.col("left").alias("id"), "a").unionAll(level.select(F.col("right").alias("id"), "a"))
    return ends.groupBy("id").agg(F.max("a").alias("longer"))
