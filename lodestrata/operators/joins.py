"""Joins whose many-row side is on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(keys: Sequence[str]) -> Column:
    """A hash of the key, to group by beside the key on the right side of a join.

    It changes no group, but stops Spark from joining in the stage that ends the aggregation.
    The join then reads plain exchanges on both sides, which is what AQE needs to split a
    partition that one key of the left side fills.
    """
    return F.xxhash64(*keys).alias("_spread")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once, combined in every task before the shuffle, as the right side of a join."""
    return df.select(*keys, spread(keys)).distinct().select(*keys)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once; rows are shuffled before they are compared.

    ``distinct`` alone also compares the rows of every task before the shuffle. Where few of them are equal, as after a
    join on a key that all copies share with many other rows, that keeps all rows the task makes in memory and drops next to none.
    """
    return df.repartition(*df.columns).distinct()


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A left outer join that stays splittable when one key holds much of the right side.

    Spark cannot split the right side of an outer join. The inner part can be split on both
    sides; left rows without a match come from an anti join against the distinct keys.

    Both parts join on a struct of the keys. A struct is never null, so Spark adds no null filter
    to one part only, and the left side is computed and shuffled once for both. Right rows with
    a null key are left out first, so that no such struct matches. The distinct keys are taken
    before they become a struct, so that Spark still drops outer joins that only add to the right side's values.
    """
    keys = list(keys)
    key = F.struct(*[F.col(k).cast(left.schema[k].dataType) for k in keys]).alias("_key")
    values = [f for f in right.schema.fields if f.name not in keys]
    known = right.dropna(subset=keys)
    many = known.select(key, *[F.col(f.name) for f in values])
    keyed = left.select("*", key)
    matched = keyed.join(many, "_key", "inner")
    alone = keyed.join(distinct_keys(known, keys).select(key), "_key", "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in values]
    both = matched.unionByName(alone.select("*", *missing))
    others = [c for c in left.columns if c not in keys]
    return both.select(*keys, *others, *[f.name for f in values])


def lookup(df: DataFrame, table: DataFrame, on: Sequence[tuple[Column, str]], take: dict[str, str]) -> DataFrame:
    """Left join to a lookup table on computed keys, taking renamed columns.

    The lookup's keys are cast to the types of the expressions, so differing key types compare
    alike and ``df`` keeps its layout; a key that does not fit matches nothing. Spark broadcasts
    the lookup only when its size is below the session's threshold.
    """
    kinds = [f.dataType for f in df.select(*[e.alias(f"_k{i}") for i, (e, _) in enumerate(on)]).schema.fields]
    side = table.select(
        *[F.col(column).try_cast(kinds[i]).alias(f"_k{i}") for i, (_, column) in enumerate(on)],
        *[F.col(column).alias(out) for column, out in take.items()],
    )
    condition = F.lit(True)
    for i, (expression, _) in enumerate(on):
        condition = condition & (expression == side[f"_k{i}"])
    return df.join(side, condition, "left").drop(*[f"_k{i}" for i in range(len(on))])


#: bits of the filter of :func:`may_match`; what is broadcast is at most 2 ** 20 rows at every size of input
FILTER_BITS = 26


def key_marks(known: DataFrame, column: str) -> DataFrame:
    """The upper ``FILTER_BITS`` bits of known hashes, longs, as 64-bit words: at most ``2 ** (FILTER_BITS - 6)`` rows however many are known."""
    word, bit = F.shiftrightunsigned(column, 64 - FILTER_BITS + 6), f"cast(shiftrightunsigned({column}, {64 - FILTER_BITS}) & 63 AS int)"
    return known.groupBy(word.alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_mask"))


def among_marks(rows: DataFrame, marks: DataFrame, column: str) -> DataFrame:
    """Rows whose hash can be one of those marked; the marks are broadcast."""
    word, bit = F.shiftrightunsigned(column, 64 - FILTER_BITS + 6), f"cast(shiftrightunsigned({column}, {64 - FILTER_BITS}) & 63 AS int)"
    found = rows.withColumn("_word", word).join(F.broadcast(marks), "_word").where(F.expr(f"shiftright(_mask, {bit}) & 1 = 1"))
    return found.drop("_word", "_mask")


def may_match(rows: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Rows whose hash, a long, can be one of the known ones: all that are, and few others. For column expressions only."""
    return among_marks(rows, key_marks(known, column), column)
