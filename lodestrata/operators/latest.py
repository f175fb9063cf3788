"""Latest row per key, and the next qualifying row in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Column, tie_break: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``by`` for each key; nulls come last, ties go by ``tie_break``.

    Spark keeps one row per key in every task before the shuffle (``WindowGroupLimit``), so a
    key that holds a large share of the rows costs one row per task, not one huge partition.
    """
    order = [by.desc_nulls_last(), *[t.desc_nulls_last() for t in tie_break]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_value_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column equals its maximum over the whole table."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def next_qualifying(value: Column, qualifies: Column, order: Column) -> Column:
    """The nearest later value whose row qualifies.

    The window has no partition key: use it only on tables bounded by construction, such as a
    calendar with one row per day.
    """
    following = Window.orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return F.min(F.when(qualifies, value)).over(following)
