"""Nested records to linked relational tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class _Leaf:
    """A column of a flat table; ``element`` is set when it links to a child table."""

    name: str
    value: Column
    element: T.DataType | None = None


def _leaves(name: str, value: Column, kind: T.DataType) -> Iterator[_Leaf]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from _leaves(f"{name}.{field.name}", value.getField(field.name), field.dataType)
    elif isinstance(kind, T.ArrayType):
        yield _Leaf(name, value, kind.elementType)
    else:
        yield _Leaf(name, value)


def link_text(keys: Sequence[str]) -> Column:
    """One text per key combination, distinct for distinct combinations."""
    columns = [F.col(k) for k in keys]
    if len(columns) == 1:
        return columns[0].cast("string")
    return F.to_json(F.struct(*[c.cast("string").alias(str(i)) for i, c in enumerate(columns)]))


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def relationalize(
    df: DataFrame,
    root: str = "root",
    keys: Sequence[str] = (),
    staging_path: str | None = None,
    carry: Sequence[str] = (),
    underscores: bool = True,
) -> dict[str, DataFrame]:
    """Flatten structs to columns, and every array to a child table ``<root>_<path>``.

    A child has ``id`` (the link held by its parent in the array's column), ``index`` and the
    element's fields under ``<path>.val``. Arrays inside arrays make children of children. A
    null or empty array makes no child rows. ``carry`` names root columns repeated in every
    child, such as a load stamp. Dots in names become underscores unless ``underscores`` is off.

    Links come from ``keys``, which identify a root record, so that every table computes the
    same ones however often a task is rerun. Without keys the records are numbered and written
    once to ``staging_path``, in a folder all executors share; with both, parsing is done once.

    The walk is over the schema. Each table is one scan with explodes and no shuffle, and reads
    only its own branch of a columnar source.
    """
    if keys:
        numbered = df.withColumn("_link", link_text(keys))
    elif staging_path:
        numbered = df.withColumn("_link", F.monotonically_increasing_id().cast("string"))
    else:
        raise ValueError("give keys that identify a record, or a staging path")
    if staging_path:
        numbered = _stage(numbered, staging_path)
    tables: dict[str, DataFrame] = {}
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(f.name, F.col(f"`{f.name}`"), f.dataType)]
    _emit(tables, root, root, numbered, F.col("_link"), leaves, [], carry, underscores)
    return tables


def _emit(
    tables: dict[str, DataFrame],
    root: str,
    name: str,
    frame: DataFrame,
    link: Column,
    leaves: Sequence[_Leaf],
    own: Sequence[str],
    carry: Sequence[str],
    underscores: bool,
) -> None:
    def tidy(text: str) -> str:
        return text.replace(".", "_") if underscores else text

    columns = [F.col(f"`{c}`") for c in own]
    columns += [
        (leaf.value if leaf.element is None else F.when(leaf.value.isNotNull(), link)).alias(tidy(leaf.name))
        for leaf in leaves
    ]
    table = frame.select(*columns)
    repeated = {c for c in table.columns if table.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"flattening {name} gives columns {sorted(repeated)} more than once")
    tables[tidy(name)] = table
    for leaf in leaves:
        if leaf.element is None:
            continue
        child = frame.select(link.alias("id"), *carry, F.posexplode(leaf.value).alias("index", "_val"))
        path = f"{leaf.name}.val"
        below = list(_leaves(path, F.col("_val"), leaf.element))
        child_link = F.concat_ws(".", "id", "index")
        _emit(tables, root, f"{root}_{leaf.name}", child, child_link, below, ["id", "index", *carry], carry, underscores)


def find_table(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A flattened table by name, whatever its case."""
    wanted = name.lower()
    for key, frame in tables.items():
        if key.lower() == wanted:
            return frame
    raise KeyError(f"no flattened table {name}; there are {sorted(tables)}")
