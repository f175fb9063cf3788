"""JSON files of any layout whose objects cross the borders of their splits.

Files are cut at every ``}``, whether they have lines or not. Whether a ``}`` ends a record depends on
the quotes and brackets before it in its file. What a split adds to them is known but for whether it
begins within a string, so one pass makes both sums by split, windows add them up by file, and the
next pass reads every split knowing what precedes it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lines import _SPLIT, _segments

_TOTALS = "file string, start long, size long, array boolean, odd long, outside long, inside long, bytes long"


def _depth(text: Column) -> Column:
    """Brackets opened less brackets closed."""
    return (F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))).cast("long")


def _pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every piece up to a ``}``, with its odd quotes and its depth if it begins outside or inside a string.

    An escape is never cut, since ``}`` is not escaped in JSON. What follows the last ``}`` of a file gets one as well.
    """
    meta = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_block_start", "start"), ("file_size", "size"))]
    read = spark.read.option("lineSep", "}").text(path).select(F.concat("value", F.lit("}")).alias("value"), *meta)
    plain = read.withColumn("plain", F.regexp_replace("value", r"(?s)\\.", ""))
    strings = r'"[^"]*(?:"|\z)'
    return plain.select(
        "file",
        "start",
        "size",
        "value",
        F.col("value").rlike(r"^[\s\x{FEFF}]*\[").alias("array"),
        ((F.length("plain") - F.length(F.translate("plain", '"', ""))) % 2).cast("long").alias("odd"),
        _depth(F.regexp_replace("plain", strings, "")).alias("outside"),
        _depth(F.regexp_replace(F.concat(F.lit('"'), "plain"), strings, "")).alias("inside"),
        F.octet_length("value").cast("long").alias("bytes"),
    )


def _added(part: pa.RecordBatch, parity: int) -> tuple[np.ndarray, np.ndarray]:
    """After each piece: whether a string is open, and which of its two depths holds for it (0 outside, 1 inside)."""
    after = (parity + np.cumsum(part["odd"].to_numpy())) % 2
    return after, np.r_[parity, after[:-1]]


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split adds, if it begins outside and if it begins inside a string."""
    split, row, parity = None, [], 0

    def total() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4)
        names = [c.split()[0] for c in _TOTALS.split(", ")]
        return pa.record_batch([pa.array([v], t) for v, t in zip((*split, *row[:2], parity, *row[2:]), types)], names=names)

    for batch in batches:
        for key, part in _segments(batch):
            if key != split:
                if split:
                    yield total()
                split, parity = key, 0
                row = [part["size"][0].as_py(), part["array"][0].as_py(), 0, 0, 0]
            after, before = _added(part, parity)
            outside, inside = part["outside"].to_numpy(), part["inside"].to_numpy()
            row[2] += int(np.where(before == 0, outside, inside).sum())
            row[3] += int(np.where(before == 0, inside, outside).sum())
            row[4] += int(part["bytes"].to_numpy().sum())
            parity = int(after[-1])
    if split:
        yield total()


def _assembled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces joined to records; ``part`` is 0 for a whole record, 1 where a split's first is the end of one, 2 where its last goes on, 3 for a middle."""
    split, held, first, parity, depth, base = None, [], False, 0, 0, 0

    def out(values: pa.Array, part: int) -> pa.RecordBatch:
        n = len(values)
        return pa.record_batch([pa.array([split[0]] * n), pa.array(np.full(n, split[1])), values, pa.array(np.full(n, part, np.int32))], names=["file", "start", "value", "part"])

    for batch in batches:
        for key, part in _segments(batch):
            if key != split:
                if held:
                    yield out(pa.array(["".join(held)]), 3 if first else 2)
                split, held = key, []
                parity, depth, base = part["open"][0].as_py(), part["depth"][0].as_py(), int(part["listed"][0].as_py())
                first = key[1] > 0 and (parity == 1 or depth != base)
            after, before = _added(part, parity)
            level = depth + np.cumsum(np.where(before == 0, part["outside"].to_numpy(), part["inside"].to_numpy()))
            parity, depth = int(after[-1]), int(level[-1])
            ends, values, begin = np.flatnonzero((after == 0) & (level == base)) + 1, part["value"], 0
            if ends.size and (held or first):
                begin = int(ends[0])
                yield out(pa.array(["".join([*held, *values.slice(0, begin).to_pylist()])]), int(first))
                held, first, ends = [], False, ends[1:]
            if ends.size:
                yield out(pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[begin, ends].astype(np.int32)), values), ""), 0)
                begin = int(ends[-1])
            held += values.slice(begin).to_pylist()
    if held:
        yield out(pa.array(["".join(held)]), 3 if first else 2)


def json_objects(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value): the objects of JSON files as text; a file is read by as many tasks as its size asks for.

    A file holds one array of objects, or objects one after another; line breaks may be anywhere or
    nowhere. Empty files and arrays give no rows. A file that is cut off, has other elements than
    objects, or has text after its array fails. Files are not compressed. What is broadcast has one row
    for each split; the driver lists the same splits to plan the scan.
    """
    pieces = _pieces(spark, path)
    file = Window.partitionBy("file")
    before = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.mapInArrow(_totals, _TOTALS).withColumn("open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    sums = sums.withColumn("added", F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside")))
    listed = F.max(F.when(F.col("start") == 0, F.col("array"))).over(file)
    # Text after the last "}" got one of its own, so whole arrays end at -1, and objects at 0 if nothing follows them.
    final, odd, read = F.sum("added").over(file), F.sum("odd").over(file), F.sum("bytes").over(file)
    whole = (odd % 2 == 0) & ((final == -1) | (~listed & (final == 0) & (read != F.col("size") + 1)))
    message = F.concat(F.lit("brackets or quotes do not match in "), "file")
    depth = F.when(whole, F.coalesce(F.sum("added").over(before), F.lit(0))).otherwise(F.raise_error(message).cast("long"))
    known = sums.select(*_SPLIT, "open", depth.alias("depth"), listed.alias("listed"))
    kept = pieces.join(F.broadcast(known), list(_SPLIT)).mapInArrow(_assembled, "file string, start long, value string, part int")

    # Parts of a record in the order of its file: one that goes on, middles, and one that ends it.
    place = Window.partitionBy("file").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = kept.where("part > 0").withColumn("last", F.col("part") == 2).withColumn("record", F.sum(F.col("last").cast("int")).over(place))
    ordered = F.array_sort(F.collect_list(F.struct("start", "last", "value")))
    joined = parts.groupBy("file", "record").agg(ordered.alias("p"), F.bool_or(F.col("part") == 1).alias("ended"))
    text = F.array_join("p.value", "")
    rest = ~F.col("ended") & text.rlike(r"\A[\s\x{FEFF}]*(\[\s*)?\]?\s*\}?\z")
    # What is no record is null and never an error, since Spark may test a caller's filters before those here.
    found = kept.select("file", F.when(F.col("part") == 0, F.col("value")).alias("value")).union(joined.select("file", F.when(~rest, text).alias("value")))
    record = F.regexp_replace("value", r"\A[\s\x{FEFF}]*[\[,]?\s*", "")
    other = F.raise_error(F.concat(F.lit("not only objects in "), "file")).cast("string")
    checked = F.when(F.startswith(record, F.lit("{")), record).when(F.col("value").isNotNull(), other)
    return found.select(checked.alias("value")).where(F.col("value").isNotNull())
