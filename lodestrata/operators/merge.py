"""Merge, upsert and history keeping by composite key.

All functions are DataFrame to DataFrame. Store the result as a new table version
(``sinks.versions``), never over the files it was read from.

Skew: the side that may hold many rows of one key is always the left side of a left or anti
join, the side AQE can split; the other side holds each key once (``joins.distinct_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import add_audit, drop_stamps, stamp_load
from .joins import distinct_keys, spread


def delete_matching(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key does not occur in the stage. A null key matches nothing."""
    return target.join(distinct_keys(stage, keys), list(keys), "left_anti").select(*target.columns)


def delete_insert(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage rows replace all target rows that share a key; stage duplicates are kept."""
    return delete_matching(target, stage, keys).unionByName(stage)


def merge_replace(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    run_stamp: str,
    audit_at: Column,
    audit_by: str,
    audit_source: str,
) -> DataFrame:
    """As :func:`delete_insert`, with load stamp and audit columns dropped before and made anew.

    A target that does not exist yet is given as ``None``.
    """
    fresh = drop_stamps(source)
    merged = fresh if target is None else delete_insert(drop_stamps(target), fresh, keys)
    return add_audit(stamp_load(merged, run_stamp), audit_at, audit_by, audit_source)


def full_reload(target: DataFrame, stage: DataFrame) -> DataFrame:
    """The stage projected to the target's columns and types; nothing of the target remains."""
    names = {c.lower() for c in stage.columns}
    return stage.select(
        *[
            (F.col(f.name) if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def _has_key(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _counted_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(_has_key(keys)).groupBy(*keys, spread(keys)).agg(F.count(F.lit(1)).alias("_n"))


def _repeated(keys: Sequence[str]) -> Column:
    return F.raise_error(F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys))))


def checked_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key without nulls once, failing the job when one occurs twice. Only keys are shuffled."""
    once = F.when(F.col("_n") > 1, _repeated(keys).cast("boolean")).otherwise(F.lit(True))
    return _counted_keys(df, keys).filter(once).select(*keys)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's non-key columns, unmatched source rows are added.

    Columns only the target has are kept, and are null in added rows. Two source rows with one
    key are an error; a source row with a null key matches nothing and is added.
    """
    keys = list(keys)
    values = [c for c in source.columns if c not in keys]
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    if not values:
        return target.unionByName(full_reload(target, source.join(distinct_keys(target, keys), keys, "left_anti")))
    carried = source.filter(_has_key(keys)).select(*keys, F.struct(F.lit(True).alias("_hit"), *values).alias("_new"))
    updated = target.join(carried, keys, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.`{c}`")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )
    added = source.join(distinct_keys(target, keys), keys, "left_anti")
    # Keys are counted beside the join, not before it: no rows, but an error when one occurs twice. The error has its own
    # condition, as Spark may evaluate what is made of these columns before the filter.
    failed = F.when(F.col("_n") > 1, _repeated(keys))
    guard = _counted_keys(source, keys).filter("_n > 1").select(*[failed.cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return updated.unionByName(full_reload(target, added)).unionByName(guard)


def scd2_load(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    close_all: bool = False,
) -> DataFrame:
    """Close the current target rows whose key is staged, and add the stage rows.

    Closing sets ``current_indicator`` to 0 and ``record_end_date`` to ``as_of``. Rows closed
    earlier keep their end date unless ``close_all`` is set; they are passed on without a
    shuffle, so the load costs what the current rows cost, not the whole history. Store the
    history partitioned by ``current_indicator`` and each file is still read only once. Two stage
    rows with one key are an error, as both would be current.
    """
    staged = checked_keys(stage, keys).withColumn("_staged", F.lit(True))
    closed = {"current_indicator": F.lit(0), "record_end_date": as_of}

    def close(rows: DataFrame) -> DataFrame:
        return rows.join(staged, list(keys), "left").select(
            *[
                F.when(F.col("_staged"), closed[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
                if c in closed
                else F.col(c)
                for c in target.columns
            ]
        )

    current = F.col("current_indicator").eqNullSafe(1)
    kept = close(target) if close_all else close(target.filter(current)).unionByName(target.filter(~current))
    return kept.unionByName(stage.select(*target.columns))


def open_history(df: DataFrame, as_of: Column, open_end: Column, user_id: str) -> DataFrame:
    """The validity and audit columns of a new current row."""
    return df.withColumns(
        {
            "record_start_date": as_of,
            "record_end_date": open_end,
            "current_indicator": F.lit(1).cast("bigint"),
            "create_date": as_of,
            "update_date": as_of,
            "update_userid": F.lit(user_id),
        }
    )


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("current_indicator") == 1)
