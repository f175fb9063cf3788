"""Row functions that built-in expressions cannot state, run on Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: bytes of a slice of a batch, as Arrow has them, that is in Python objects at a time
SLICE_BYTES = 4 << 20


def release() -> None:
    """Give freed memory back to the system at the end of a task, so that idle workers stay small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a system with the GNU C library
        pass


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in halves of halves until one has at most so many bytes or one row."""
    if batch.num_rows > 1 and batch.nbytes > most:
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), most)
        yield from slices(batch.slice(half), most)
    else:
        yield batch


def add_column_in_batches(df: DataFrame, name: str, kind: T.DataType, compute: Callable[[pd.DataFrame], pd.Series], needs: Sequence[str] | None = None) -> DataFrame:
    """Add a column computed from whole rows, a slice of a batch at a time. Prefer ``withColumn`` where it can.

    ``compute`` gets the columns it ``needs``, all if none are named, as pyarrow makes them (timestamps keep their zone); what it
    gets stays as it is in the result. Slices have at most
    ``SLICE_BYTES``, or one row, so a worker's memory does not grow with the length of texts times the rows of a batch.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    wanted = list(needs if needs is not None else df.columns)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = compute(part.select(wanted).to_pandas())
                made = pa.Array.from_pandas(found, type=to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])
        release()

    return df.mapInArrow(apply, schema)
