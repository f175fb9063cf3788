"""Text files whose records or first lines cross the borders of their splits.

What a line means depends on the lines before it in its file: whether a quote is open, or how many lines
went before. Each is a sum over splits, so one pass counts by split, a window adds the counts up
by file, and the next pass reads every split knowing what precedes it.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ("file", "start")


def _lines(spark: SparkSession, path: str | Sequence[str], line_end: str | None = None) -> DataFrame:
    """(value, file, start): every line with the split it begins in, in the order of the file within the split."""
    reader = spark.read if line_end is None else spark.read.option("lineSep", line_end)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def after_first_lines(spark: SparkSession, path: str | Sequence[str], lines: int) -> DataFrame:
    """(value, file): all lines but the first ``lines`` of each file, wherever the splits lie.

    Lines never leave the JVM. What is broadcast has one row for each file, and one more for each split its
    first lines go on into; the driver lists the same files and splits to plan the scan.
    """
    numbered = _lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    return numbered.join(F.broadcast(_first_lines(numbered, lines)), list(_SPLIT), "left").where(F.col("until").isNull() | (F.col("at") >= F.col("until"))).select("value", "file")


def _first_lines(numbered: DataFrame, lines: int) -> DataFrame:
    """(file, start, until): of each split with some of the first lines of its file, the number of the line after them."""
    counts = numbered.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("before", before).where(F.col("before") < lines).select(*_SPLIT, (F.col("first") + F.least("n", F.lit(lines) - F.col("before"))).alias("until"), "before")


def headers(spark: SparkSession, path: str | Sequence[str], line: int, sep: str) -> list[str]:
    """The fields of line ``line`` (from 0) of the files, which must be the same in all of them."""
    numbered = _lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    ends = _first_lines(numbered, line + 1).groupBy("file").agg(F.max(F.struct("start", "until")).alias("e")).select("file", "e.start", "e.until")
    # Files with fewer lines have no such line; of the others their last counted line is it.
    enough = numbered.groupBy("file").agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > line).select("file")
    found = numbered.join(F.broadcast(ends), list(_SPLIT)).where(F.col("at") == F.col("until") - 1).join(enough, "file", "left_semi")
    some = found.groupBy("value").agg(F.min("file").alias("file")).orderBy("file").limit(20).collect()
    named = [([n.strip() for n in next(csv.reader([r["value"]], delimiter=sep))], r["file"]) for r in some]
    for names, file in named[1:]:
        if names != named[0][0]:
            raise ValueError(f"{file} has the header {names}, another file {named[0][0]}")
    if not named:
        raise ValueError(f"no file of {path} has a header in line {line + 1}")
    return named[0][0]


# --- quoted records ---------------------------------------------------------------------------


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where another split begins."""
    files, starts = batch["file"].dictionary_encode().indices.to_numpy(), batch["start"].to_numpy()
    edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        if a < b:
            yield (batch["file"][int(a)].as_py(), int(starts[a])), batch.slice(int(a), int(b - a))


def _quotes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (file, start), part in _segments(batch):
            odd = pc.sum(pc.count_substring(part["value"], '"')).as_py() % 2
            yield pa.record_batch([pa.array([file]), pa.array([start]), pa.array([odd], pa.int64())], names=["file", "start", "odd"])


def _assembled(batches: Iterable[pa.RecordBatch], opened: set[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Lines joined to records; ``part`` is 0 for a whole record, 1 where a split's first and 2 where its last record goes on beyond it."""
    split, held, parity, first, top = None, [], 0, False, False

    def row(text: str, part: int, top: bool) -> pa.RecordBatch:
        return pa.record_batch([pa.array([split[0]]), pa.array([split[1]], pa.int64()), pa.array([text]), pa.array([part], pa.int32()), pa.array([top])], names=["file", "start", "value", "part", "top"])

    def ended() -> Iterator[pa.RecordBatch]:
        if held:
            # A split that begins and ends within one record has only a middle, which goes on as well.
            yield row("\n".join(held), 3 if first else 2, top)

    for batch in batches:
        for key, part in _segments(batch):
            if key != split:
                yield from ended()
                split, held = key, []
                first = key in opened
                parity, top = int(first), key[1] == 0
            values = part["value"]
            ends = (parity + np.cumsum(pc.count_substring(values, '"').to_numpy())) % 2
            parity = int(ends[-1])
            done = np.flatnonzero(ends == 0)
            if not done.size:
                held += values.to_pylist()
                continue
            begin = 0
            while done.size and (held or first or top):  # the record under way, or the first one of a file
                text = "\n".join([*held, *values.slice(begin, int(done[0]) + 1 - begin).to_pylist()])
                if not top or first or text.strip():
                    yield row(text, 1 if first else 0, top)
                    top = False
                held, first, begin, done = [], False, int(done[0]) + 1, done[1:]
            if done.size:
                offsets = pa.array(np.r_[begin, done + 1].astype(np.int32))
                records = pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")
                n = len(records)
                yield pa.record_batch([pa.array([key[0]] * n), pa.array(np.full(n, key[1])), records, pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, bool))], names=["file", "start", "value", "part", "top"])
                begin = int(done[-1]) + 1
            held = values.slice(begin).to_pylist()
    yield from ended()


def quoted_records(spark: SparkSession, path: str | Sequence[str], header: bool = True) -> DataFrame:
    """(value): the records of delimited files, whose quoted fields may hold line breaks, as text; a file is read by as many tasks as its size asks for.

    Whether a split begins within quotes follows from the number of quotes before it. So quotes stand only
    around fields, and doubled within them; a file with an odd number of them fails. Lines end with ``\\n``
    or ``\\r\\n``; in a record with the latter, breaks within quotes become ``\\n``, as Spark's reader of whole files has it. Empty lines between records are passed over. With ``header`` the first record of each file is left out.
    Known to each task are the splits that begin within quotes, some bytes for each.
    """
    lines = _lines(spark, path, "\n")
    counts = lines.mapInArrow(_quotes, "file string, start long, odd long").groupBy(*_SPLIT).agg(F.sum("odd").alias("odd"))
    upto = Window.partitionBy("file").orderBy("start")
    total = F.sum("odd").over(Window.partitionBy("file")) % 2
    message = F.concat(F.lit("quotes do not match in "), "file")
    checked = F.when(total == 1, F.raise_error(message).cast("long")).otherwise(F.coalesce(F.sum("odd").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    opened = {(r["file"], r["start"]) for r in counts.select(*_SPLIT, checked.alias("before")).where(F.col("before") % 2 == 1).collect()}
    shared = spark.sparkContext.broadcast(opened)
    kept = lines.mapInArrow(lambda batches: _assembled(batches, shared.value), "file string, start long, value string, part int, top boolean")
    whole = kept.where("part = 0")
    if opened:
        # Pieces of a record in the order of its file: one that goes on, middles, and one that ends it.
        place = Window.partitionBy("file").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        pieces = kept.where("part > 0").withColumn("last", F.col("part") == 2)
        ordered = pieces.withColumn("record", F.sum(F.col("last").cast("int")).over(place))
        joined = ordered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "last", "value"))).alias("p"), F.max("top").alias("top"))
        whole = whole.select("value", "top").unionByName(joined.select(F.array_join(F.col("p.value"), "\n").alias("value"), "top"))
    text = F.when(F.endswith("value", F.lit("\r")), F.replace(F.regexp_replace("value", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
    found = whole.where(~F.col("top")) if header else whole
    return found.select(text.alias("value")).where(F.trim("value") != "")

