"""Whole loads: raw, flattened, merged, transformed by SQL, historised and incremental."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.columns import AUDIT_COLUMNS, FIRST_CHECKPOINT, LOAD_COLUMN, add_audit, between_checkpoints, drop_stamps
from ..operators.nested import relationalize
from ..sinks import versions, writers
from . import calendar

CHECKPOINT_SCHEMA = "checkpoint_value string"


def load_raw(
    df: DataFrame,
    path: str,
    run_stamp: str,
    at: Column,
    by: str,
    source: str,
    table: str | None = None,
    files: Sequence[str] = (),
    archive: str | None = None,
) -> int:
    """Stamp, audit and land a batch in its own load partition, and count its rows on the way.

    The batch's ``files``, when named, move to ``archive`` once it has landed.
    """
    seen = Observation()
    landed = add_audit(df.drop(LOAD_COLUMN), at, by, source).observe(seen, F.count(F.lit(1)).alias("rows"))
    writers.overwrite_partition(landed, path, LOAD_COLUMN, run_stamp, table)
    if archive:
        writers.archive_files(df.sparkSession, files, archive)
    return seen.get.get("rows", 0)


def load_flattened(
    df: DataFrame,
    path: str,
    run_stamp: str,
    at: Column,
    by: str,
    source: str,
    keys: Sequence[str] = (),
    staging_path: str | None = None,
    table: str | None = None,
    at_once: int = 4,
) -> list[str]:
    """Flatten nested records and land every table as ``<path>_<name>``; the names are returned.

    A few tables are written at once, so that small ones use the executors a large one leaves idle.
    """
    flattened = relationalize(df, keys=keys, staging_path=staging_path)

    def land(name: str) -> None:
        load_raw(flattened[name], f"{path}_{name}", run_stamp, at, by, source, f"{table}_{name}" if table else None)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(df.sparkSession)(land), flattened))
    return list(flattened)


def load_merged(
    spark: SparkSession,
    source: DataFrame,
    base: str,
    keys: Sequence[str],
    run_stamp: str,
    at: Column,
    by: str,
    audit_source: str,
    partition_keys: Sequence[str] = (),
    view: str | None = None,
) -> str:
    """Merge a batch into the current version of a table and store the result as the next one.

    Only files that hold a key of the batch are rewritten; the others are named again by the new version.
    Load stamp and audit columns are the same in all rows of a version, so they stand in its entry
    and not in the files. A view can name one folder only: with a ``view``, or with a stamp as partition
    key, the whole table is written.
    """
    stamped = {LOAD_COLUMN, *AUDIT_COLUMNS}
    after = versions.newest(spark, base)
    if view or stamped & set(partition_keys) or (after is not None and not after.files):
        current = versions.read_version(spark, base, after) if after else None
        merged = merge.merge_replace(current, source, keys, run_stamp, at, by, audit_source)
        return versions.write_version(merged, base, run_stamp, view, partition_keys, after)
    shared = dict(zip((LOAD_COLUMN, *AUDIT_COLUMNS), (F.lit(run_stamp), at, at, F.lit(by), F.lit(by), F.lit(audit_source))))
    fresh = drop_stamps(source)
    return _write_by_file(spark, base, after, fresh, keys, lambda old: merge.delete_insert(old, fresh, keys), run_stamp, partition_keys, shared)


def _write_by_file(
    spark: SparkSession,
    base: str,
    after: Row | None,
    batch: DataFrame,
    keys: Sequence[str],
    change: Callable[[DataFrame], DataFrame],
    run_stamp: str,
    partition_keys: Sequence[str],
    shared: Mapping[str, Column] | None = None,
    among: str | None = None,
) -> str:
    """Apply a change to the rows of the files that hold a key of the batch, among those rows, and keep all other files."""
    if after is None:
        return versions.write_changed(spark, batch, base, run_stamp, None, None, partition_keys, shared)
    held = versions.stored_rows(spark, base, after)
    path = f"{base}/_replaced/version={run_stamp}"
    versions.files_with_keys(held.filter(among) if among else held, batch, keys).write.mode("overwrite").parquet(path)
    replaced = spark.read.schema("file string").parquet(path)
    old = versions.stored_rows(spark, base, after, replaced).drop("_file")
    return versions.write_changed(spark, change(old), base, run_stamp, after, replaced, partition_keys, shared)


def load_compacted(spark: SparkSession, base: str, run_stamp: str, partition_keys: Sequence[str] = ()) -> str:
    """Store the current version anew as files of even size, for tables that many small loads have cut up."""
    after = versions.newest(spark, base)
    rows = versions.stored_rows(spark, base, after)
    shared = versions.constant_columns(after)
    return versions.write_changed(spark, rows if partition_keys else rows.hint("rebalance"), base, run_stamp, after, versions.file_list(spark, base, after).select("file"), partition_keys, shared)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def load_delete_insert(
    spark: SparkSession, source: DataFrame, base: str, keys: Sequence[str], run_stamp: str, partition_keys: Sequence[str] = (), view: str | None = None
) -> str:
    """Replace the rows of the current version whose key is in the batch, and store the result as the next one; see :func:`load_merged`."""
    after = versions.newest(spark, base)
    if view:
        rows = source if after is None else merge.delete_insert(versions.read_version(spark, base, after), source, keys)
        return versions.write_version(rows, base, run_stamp, view, partition_keys, after)
    return _write_by_file(spark, base, after, source, keys, lambda old: merge.delete_insert(old, source, keys), run_stamp, partition_keys)


def load_upserted(
    spark: SparkSession, source: DataFrame, base: str, keys: Sequence[str], run_stamp: str, partition_keys: Sequence[str] = (), view: str | None = None
) -> str:
    """Update and add rows by key in the current version, and store the result as the next one; see :func:`load_merged`."""
    after = versions.newest(spark, base)
    if view:
        rows = source if after is None else merge.merge_upsert(versions.read_version(spark, base, after), source, keys)
        return versions.write_version(rows, base, run_stamp, view, partition_keys, after)
    return _write_by_file(spark, base, after, source, keys, lambda old: merge.merge_upsert(old, source, keys), run_stamp, partition_keys)


def load_calendar(span: DataFrame, holidays: DataFrame, base: str, run_stamp: str) -> tuple[str, str]:
    """Build and store the date and the month dimension; their paths are returned.

    ``holidays`` has text dates, which may repeat; one that cannot be read fails the load.
    """
    dates = calendar.business_calendar(span, calendar.parse_holidays(holidays))
    return writers.write_version(dates, f"{base}/dates", run_stamp), writers.write_version(calendar.month_dim(span), f"{base}/months", run_stamp)


def load_merged_partitions(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    base: str,
    keys: Sequence[str],
    partition: str,
    run_stamp: str,
    at: Column,
    by: str,
    audit_source: str,
) -> list[str]:
    """As :func:`load_merged`, for a catalog table partitioned by a text column of its key.

    Rows with one key then share a partition, so only the partitions the batch touches are read
    and written, and only their rows have the new stamp. ``table`` is a view of a partitioned table that
    belongs to one version: all its partitions are declared before the view is switched, so readers never see
    half a batch. The names of partitions and files pass through the driver, never rows.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be part of the key, or a row could move between partitions")
    if not source.filter(F.col(partition).isNull()).isEmpty():
        raise ValueError(f"{partition} must not be null")
    after = versions.newest(spark, base)
    values = source.select(partition).distinct()
    replaced, old = None, None
    if after is not None:
        _point_view(spark, table, base)  # a run may have been lost after its commit
        path = f"{base}/_replaced/version={run_stamp}"
        held = versions.stored_rows(spark, base, after).select(partition, F.col("_file").alias("file"))
        held.join(values, partition, "left_semi").select("file").distinct().write.mode("overwrite").parquet(path)
        replaced = spark.read.schema("file string").parquet(path)
        old = versions.stored_rows(spark, base, after, replaced).drop("_file")
    merged = merge.merge_replace(old, source, keys, run_stamp, at, by, audit_source)
    versions.write_changed(spark, merged, base, run_stamp, after, replaced, [partition], ready=lambda number, rows: _declare(spark, f"{table}__{number}", rows, base, partition))
    _point_view(spark, table, base)
    return [r[0] for r in values.collect()]


def _declare(spark: SparkSession, table: str, rows: DataFrame, base: str, partition: str) -> None:
    """A catalog table over the folders of a version that is about to be committed."""
    folders = rows.select(partition, F.regexp_extract("_file", "^(.*)/[^/]*$", 1).alias("folder")).distinct().collect()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_file").schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{base}/unused'")
    for at in range(0, len(folders), 500):
        named = " ".join(f"PARTITION (`{partition}` = {_quoted(value)}) LOCATION {_quoted(folder)}" for value, folder in folders[at : at + 500])
        spark.sql(f"ALTER TABLE {table} ADD {named}")


def _point_view(spark: SparkSession, table: str, base: str) -> None:
    """Let the view read the newest version's table, and drop the one before the last; files stay."""
    number = versions.newest(spark, base).number
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {table}__{number}")
    if number > 2:
        spark.sql(f"DROP TABLE IF EXISTS {table}__{number - 2}")


def load_history(spark: SparkSession, stage: DataFrame, base: str, keys: Sequence[str], as_of: Column, run_stamp: str) -> str:
    """Close and add history rows; only files of current rows that hold a staged key are written again.

    What earlier loads closed is neither read nor written. :func:`history_rows` reads the whole history in one scan.
    """
    after = versions.newest(spark, base)
    change = lambda old: merge.scd2_load(old.filter(_CURRENT), stage, keys, as_of)
    return _write_by_file(spark, base, after, stage, keys, change, run_stamp, ["current_indicator"], among=_CURRENT)


_CURRENT = "current_indicator <=> 1"


def history_rows(spark: SparkSession, base: str) -> DataFrame | None:
    """All current and closed rows, in one scan however many loads there were; ``None`` before the first load."""
    return versions.current_version(spark, base)


def transform_sql(spark: SparkSession, text: str, inputs: Mapping[str, DataFrame], **arguments: object) -> DataFrame:
    """A SQL text over named inputs, with ``:name`` arguments."""
    return spark.sql(text, args=arguments, **inputs) if inputs else spark.sql(text, args=arguments)


def read_sql_text(spark: SparkSession, path: str) -> str:
    """A SQL file from any file system Spark can read."""
    return spark.read.text(path, wholetext=True).first().value


def read_checkpoint(spark: SparkSession, path: str) -> str:
    """The last value reached, or the value before all loads."""
    try:
        log = spark.read.schema(CHECKPOINT_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return FIRST_CHECKPOINT
    return log.agg(F.max("checkpoint_value")).first()[0] or FIRST_CHECKPOINT


def write_range(base: str) -> Callable[[DataFrame, str], None]:
    """A writer for :func:`load_incremental`: the rows after a checkpoint have a folder, written over by a retry."""
    return lambda rows, after: writers.overwrite(rows, f"{base}/after={after}")


def load_incremental(
    spark: SparkSession,
    df: DataFrame,
    checkpoint_path: str,
    until: str,
    write: Callable[[DataFrame, str], object],
    column: str = LOAD_COLUMN,
) -> str:
    """Hand the rows since the last checkpoint, and that checkpoint, to ``write``; advance only when it succeeds.

    When a run is lost in between, the next one starts at the same checkpoint. A writer that keeps
    one folder for each, as :func:`write_range` does, then adds no row twice.
    """
    after = read_checkpoint(spark, checkpoint_path)
    write(between_checkpoints(df, column, after, until), after)
    reached = spark.createDataFrame([(until,)], CHECKPOINT_SCHEMA)
    reached.coalesce(1).write.mode("append").json(checkpoint_path)
    return until
