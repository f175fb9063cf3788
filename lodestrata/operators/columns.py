"""Projections: load stamps, audit columns, renames and re-typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import name_type_pairs

# Fixed values.
LOAD_COLUMN = "partition_load_dt_tmstmp"
AUDIT_COLUMNS = (
    "audit_created_tmstmp",
    "audit_updated_tmstmp",
    "audit_created_by",
    "audit_updated_by",
    "audit_data_source",
)
FIRST_CHECKPOINT = "20000101_000000"


def stamp_load(df: DataFrame, run_stamp: str, column: str = LOAD_COLUMN) -> DataFrame:
    """One ``yyyyMMdd_HHmmss`` value for the whole run, so that text order is time order."""
    return df.withColumn(column, F.lit(run_stamp))


def add_audit(df: DataFrame, at: Column, by: str, source: str) -> DataFrame:
    values = (at, at, F.lit(by), F.lit(by), F.lit(source))
    return df.withColumns(dict(zip(AUDIT_COLUMNS, values)))


def drop_stamps(df: DataFrame, load_column: str = LOAD_COLUMN) -> DataFrame:
    return df.drop(load_column, *AUDIT_COLUMNS)


def dots_to_underscores(df: DataFrame) -> DataFrame:
    return rename_by_position(df, [c.replace(".", "_") for c in df.columns])


def rename_by_substring(df: DataFrame, replacements: Mapping[str, str]) -> DataFrame:
    """Replace parts of column names, case-sensitively and in the order given."""
    names = []
    for name in df.columns:
        for part, new in replacements.items():
            name = name.replace(part, new)
        names.append(name)
    return rename_by_position(df, names)


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def retype_by_position(df: DataFrame, spec: str) -> DataFrame:
    """Rename and cast every column from a ``name:type, name:type`` list of the same length."""
    pairs = name_type_pairs(spec)
    if len(pairs) != len(df.columns):
        raise ValueError(f"{len(pairs)} types for {len(df.columns)} columns")
    positional = df.toDF(*[f"_{i}" for i in range(len(pairs))])
    return positional.select(*[F.col(f"_{i}").cast(t).alias(n) for i, (n, t) in enumerate(pairs)])


def drop_prefixed(df: DataFrame, prefix: str = "STD") -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.upper().startswith(prefix.upper())])


def constant(value: object, type_name: str) -> Column:
    """A typed literal; ``None`` gives a typed null."""
    return F.lit(value).cast(type_name)


def between_checkpoints(df: DataFrame, column: str, before: str, after: str) -> DataFrame:
    """Rows loaded after one checkpoint, up to and including the next."""
    return df.filter((F.col(column) > before) & (F.col(column) <= after))
