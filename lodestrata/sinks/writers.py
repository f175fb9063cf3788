"""Table and file writes, versions, manifests and file sizing."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.columns import LOAD_COLUMN
from ..sources.readers import listed_files, read_jdbc, read_parquet_merged
from ..storage import file_digests, filesystem, footer_counts
from .versions import all_versions, current_version, write_version  # noqa: F401

# Fixed values.
SAMPLE_FRACTION = 0.01
SAMPLE_ROWS = 100_000
PROCESSED_SCHEMA = "file_name string, rows_processed bigint"


def overwrite_partitions(
    df: DataFrame, path: str, keys: Sequence[str] = (LOAD_COLUMN,), file_format: str = "parquet", table: str | None = None, rebalance: bool = True
) -> None:
    """Replace only the partitions present in the data, as a named table when one is given.

    ``rebalance`` brings the rows of a partition together first, in as many tasks as their size
    asks for, so that there are no small files; leave it out when all rows share one partition.
    """
    rows = df.hint("rebalance", *keys) if rebalance else df
    writer = rows.write.format(file_format).mode("overwrite").partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)


def _escaped(value: str) -> str:
    """A partition value as a folder name, in the way of Spark's own writers."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)


def overwrite_partition(df: DataFrame, path: str, key: str, value: str, table: str | None = None) -> None:
    """Replace the one partition that all rows belong to, as part of a named table when one is given; ``df`` is without its column.

    The folder is written directly: to find the partitions of rows, Spark sorts all of a task before it writes them.
    """
    df.write.mode("overwrite").parquet(f"{path}/{key}={_escaped(value)}")
    if table:
        named = df.sparkSession.createDataFrame([], StructType([*df.schema.fields, StructField(key, StringType())]))
        overwrite_partitions(named, path, [key], table=table, rebalance=False)  # no rows: the table's columns and partitions


def overwrite(df: DataFrame, path: str, file_format: str = "parquet", **options: str | bool | int) -> None:
    df.write.format(file_format).options(**options).mode("overwrite").save(path)


def append(df: DataFrame, path: str, file_format: str = "parquet", **options: str | bool | int) -> None:
    df.write.format(file_format).options(**options).mode("append").save(path)


def overwrite_bucketed(df: DataFrame, path: str, table: str, keys: Sequence[str], buckets: int) -> None:
    """A table distributed by key, so that merges and history loads on that key need not shuffle it.

    Rows are distributed before the write, which gives one file per bucket. A bucket is one task
    and is not split, so choose keys that no large share of the rows has in common.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """CSV with every field quoted and its text unchanged."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, quoteAll=True, escape='"', **kept).csv(path)


def write_jdbc(df: DataFrame, connection: Mapping[str, str], table: str, mode: str = "append", batch_size: int = 10_000) -> None:
    df.write.format("jdbc").options(**connection).option("dbtable", table).option("batchsize", batch_size).mode(mode).save()


def sync_tables(
    spark: SparkSession,
    connection: Mapping[str, str],
    tables: Sequence[str],
    path: str,
    file_format: str = "parquet",
    ranges: Mapping[str, Mapping[str, object]] | None = None,
) -> None:
    """Copy each named database table to files below ``path``.

    ``ranges`` gives tables a ``partition_column``, ``bounds`` and ``partitions``, to be read in as
    many tasks; a table without them is one task.
    """
    for name in tables:
        overwrite(read_jdbc(spark, connection, table=name, **(ranges or {}).get(name, {})), f"{path}/{name}", file_format)


def logged_schema(spark: SparkSession, path: str, partition: str) -> StructType:
    """The union of the columns of all Parquet files below a path, opening only files that have not been looked at before.

    What was looked at is kept in a log below the path, which appears when it is complete; a column with two
    types is an error. Without new files only names are read.
    """
    log = f"{path}/_schemas"
    try:
        seen = spark.read.schema("file_path string, columns string").parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        seen = spark.createDataFrame([], "file_path string, columns string")
    files = listed_files(spark, path, "*.parquet").select(F.col("path").alias("file_path"))
    fresh = [r[0] for r in files.join(seen, "file_path", "left_anti").collect()]
    known = [StructType.fromJson(json.loads(r[0])) for r in seen.where("columns IS NOT NULL").select("columns").distinct().collect()]
    if fresh:
        found = read_parquet_merged(spark, fresh).schema
        known.append(StructType([f for f in found.fields if f.name != partition]))
        entries = files.where(F.col("file_path").isin(fresh)) if len(fresh) < 1000 else files.join(seen.select("file_path"), "file_path", "left_anti")
        entries.withColumn("columns", F.lit(known[-1].json())).write.mode("append").parquet(log)
    merged: dict[str, StructField] = {}
    for field in (f for fields in known for f in fields):
        if merged.setdefault(field.name, field).dataType != field.dataType:
            raise ValueError(f"column {field.name} has types {merged[field.name].dataType.simpleString()} and {field.dataType.simpleString()}")
    return StructType(list(merged.values()))


def register_external_table(spark: SparkSession, table: str, path: str, partition: str) -> None:
    """A table over Parquet files already written, partitioned by one text column.

    Its columns are the union of those in the files (:func:`logged_schema`). Columns the table lacks are added to it; only
    one whose own columns are gone or have other types is declared anew. Files are not touched.
    Then the partitions on storage are found.
    """
    wanted = [(f.name, f.dataType.simpleString()) for f in logged_schema(spark, path, partition)]
    known = [d for d in spark.table(table).dtypes if d[0] != partition] if spark.catalog.tableExists(table) else wanted
    fresh = ", ".join(f"`{name}` {kind}" for name, kind in wanted if (name, kind) not in known)
    if not set(known) <= set(wanted):
        spark.sql(f"DROP TABLE {table}")
    elif fresh:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({fresh})")
    columns = ", ".join(f"`{name}` {kind}" for name, kind in wanted)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{partition}` string) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")


# --- counts and manifests -------------------------------------------------------------------


def archive_files(spark: SparkSession, files: Sequence[str], folder: str, root: str | None = None, at_once: int = 16) -> None:
    """Move the files of a finished batch to a folder, some at once; files moved already, by a run that was lost, are passed over.

    Below ``root`` files keep their relative paths, so equal names in several folders stay apart; without it, such
    names are an error before the first file moves.
    """
    hadoop, settings = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    system = hadoop.Path(folder).getFileSystem(settings)
    top = system.makeQualified(hadoop.Path(root)).toUri().getPath().rstrip("/") + "/" if root else None

    def name(file: str) -> str:
        path = hadoop.Path(file).toUri().getPath()
        return path.removeprefix(top) if top and path.startswith(top) else hadoop.Path(file).getName()

    names = {file: name(file) for file in files}
    if len(set(names.values())) < len(names):
        raise ValueError(f"several files have one name in {folder}")

    def move(file: str) -> None:
        source, target = hadoop.Path(file), hadoop.Path(folder, names[file])
        system.mkdirs(target.getParent())
        if system.exists(source) and not system.rename(source, target):
            raise OSError(f"{file} cannot be moved to {folder}")

    system.mkdirs(hadoop.Path(folder))
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(spark)(move), files))


def write_counted(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "append", **options: str | bool) -> int:
    """Write and count the rows in the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(file_format).options(**options).mode(mode).save(path)
    return seen.get["rows"]


def record_processed(done: DataFrame, checkpoint: str) -> None:
    """Add files and their row counts, as in ``PROCESSED_SCHEMA``, to the log of processed files."""
    done.select("file_name", "rows_processed").write.mode("append").json(checkpoint)


def records_per_file(
    df: DataFrame, scratch: str, target_bytes: int, fraction: float = SAMPLE_FRACTION, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> int:
    """How many records make a file of the target size, from one written sample.

    Size and count come from the same sample, at most ``sample_rows`` written by one task, so that
    the answer does not depend on how many tasks hold the data. A sample without rows is followed
    by the first rows; an empty table gives 0.
    """
    rows = write_counted(df.sample(fraction, seed).limit(sample_rows).coalesce(1), scratch, mode="overwrite")
    rows = rows or write_counted(df.limit(sample_rows).coalesce(1), scratch, mode="overwrite")
    if rows == 0:
        return 0
    size = listed_files(df.sparkSession, scratch, "*.parquet").agg(F.sum("length")).first()[0]
    return max(1, math.floor(rows * target_bytes / size))


def records_per_file_from(spark: SparkSession, path: str, target_bytes: int) -> int:
    """As :func:`records_per_file`, from the footers of Parquet files that are there already; nothing is written or sampled."""
    found = footer_counts(listed_files(spark, path, "*.parquet")).agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).first()
    return max(1, math.floor(found["rows"] * target_bytes / found["size"])) if found["rows"] else 0


def write_sized(df: DataFrame, path: str, max_records: int) -> None:
    overwrite(df, path, maxRecordsPerFile=max_records)


def manifest(
    spark: SparkSession, path: str, extracted_at: Column, specification: str, run_id: str, version: str = "v01", history: str = "N"
) -> DataFrame:
    """One row per written file: counts, size and MD5, as the receiver checks them.

    Each file is one task, which reads it once, in pieces; row counts are those of the footers.
    """
    data = spark.read.parquet(path)
    joined = file_digests(listed_files(spark, path, "*.parquet")).withColumn("_path", F.col("path"))
    # Tasks give their files one name in every partition, so the partition folders are part of it.
    name = F.regexp_extract("_path", "((?:[^/=]+=[^/]*/)*[^/]+)$", 1)
    return joined.select(
        F.concat(F.replace(name, F.lit("/"), F.lit(".")), F.lit(".trg.json")).alias("TriggerFileName"),
        name.alias("DataFileName"),
        F.col("rows").alias("NumberOfRows"),
        F.lit(len(data.columns)).alias("NumberOfColumns"),
        extracted_at.alias("ExtractDateTime"),
        F.lit(specification).alias("SpecificationFileName"),
        F.lit(version).alias("SpecificationFileVersion"),
        F.lit(run_id).alias("RunInvocationID"),
        F.lit(history).alias("HistoryFlag"),
        F.col("md5").alias("MD5HashKey"),
        F.col("size").alias("DataFileSize"),
    )


def _write_named(folder: str):
    """Write each row's text to a file of its own name; a retried task writes the same files again."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for name, text in zip(batch["name"].to_pylist(), batch["text"].to_pylist()):
                with system.open_output_stream(f"{path}/{name}", compression=None) as out:
                    out.write(text.encode())
            yield batch.select(["name"])

    return step


def write_manifest(manifest_rows: DataFrame, trigger_path: str, index_path: str) -> None:
    """A trigger file under its own name for each data file, as JSON, and the list of data files as text."""
    texts = manifest_rows.select(F.col("TriggerFileName").alias("name"), F.to_json(F.struct("*")).alias("text"))
    texts.mapInArrow(_write_named(trigger_path), "name string").write.format("noop").mode("overwrite").save()
    manifest_rows.select("DataFileName").write.mode("overwrite").text(index_path)


def split_malformed(rows: DataFrame, corrupt: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt-record column, and the bad ones with their raw text.

    Both are written in one pass, as two partitions. Reading them from the text twice would
    parse it twice, and each time only the columns asked for, missing errors in the others.
    """
    rows.withColumn("malformed", F.col(corrupt).isNotNull()).write.partitionBy("malformed").parquet(path)
    stored = rows.sparkSession.read.schema(f"{rows.schema.toDDL()}, malformed boolean").parquet(path)
    return stored.filter("NOT malformed").drop("malformed", corrupt), stored.filter("malformed").drop("malformed")
