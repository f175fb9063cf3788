"""Rows to columns and columns to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute_columns(name: Column, value: Column, wanted: Mapping[str, Sequence[object]]) -> list[Column]:
    """One aggregate per output column: the greatest value among rows with one of its names."""
    return [F.max(F.when(name.isin(*names), value)).alias(out) for out, names in wanted.items()]


def attributes_to_columns(
    df: DataFrame, keys: Sequence[str], name: str, value: str, wanted: Mapping[str, Sequence[object]]
) -> DataFrame:
    """Collapse name/value rows into one row per key, combined in each task before the shuffle."""
    return df.groupBy(*keys).agg(*attribute_columns(F.col(name), F.col(value), wanted))


def conditional_sums(group: Column, amount: Column, kinds: Mapping[str, str], precision: int = 10, scale: int = 2) -> list[Column]:
    """A sum per kind, matched without regard to case; null where the kind does not occur."""
    return [
        F.sum(F.when(F.upper(group) == label.upper(), amount)).cast(f"decimal({precision},{scale})").alias(out)
        for out, label in kinds.items()
    ]


def null_safe_total(*parts: Column) -> Column:
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total


def sums_by_value(on: Column, values: Mapping[str, str], amount: Column, prefix: str = "") -> list[Column]:
    """One conditional sum per listed value; null where the value does not occur."""
    return [F.sum(F.when(on == value, amount)).alias(f"{prefix}{out}") for value, out in values.items()]


def pivot_sum(df: DataFrame, keys: Sequence[str], on: str, values: Mapping[str, str], amount: str) -> DataFrame:
    """Sum of an amount per listed value, one column each.

    The list is fixed, so conditional sums give the pivot in one shuffle; ``pivot`` would
    aggregate by key and value first and shuffle twice.
    """
    return df.groupBy(*keys).agg(*sums_by_value(F.col(on), values, F.col(amount)))


def stack_pairs(df: DataFrame, keep: Sequence[str], pairs: Sequence[tuple[str, str]], label: str, value: str) -> DataFrame:
    """One row per (label, column) pair; null values keep their rows."""
    rows = F.stack(
        F.lit(len(pairs)), *[part for text, column in pairs for part in (F.lit(text), F.col(column))]
    ).alias(label, value)
    return df.select(*keep, rows)


def unpivot_with_nulls(df: DataFrame, keep: Sequence[str], columns: Sequence[str], label: str, value: str) -> DataFrame:
    return df.unpivot(list(keep), list(columns), label, value)
