"""Streams: JSON records enriched with a dimension, and files ingested as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks.writers import archive_files
from ..sources.readers import CORRUPT
from ..storage import decoded

MOST_FILES = 10_000


def json_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 1000) -> DataFrame:
    """Lines of JSON, parsed, with the raw text of unreadable ones. Other sources give the same ``value`` column."""
    return parse_json(spark.readStream.option("maxFilesPerTrigger", max_files).text(path), schema)


def parse_json(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The fields of each record; one that cannot be read has nulls, and its text in ``_corrupt_record``."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(F.from_json(F.col("value").cast("string"), wide, options).alias("data")).select("data.*")


def enrich(stream: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join to a static dimension, which Spark broadcasts when its size allows."""
    return stream.join(dimension, list(keys))


def _run_folder(spark: SparkSession, checkpoint: str) -> str:
    """A folder name for the batches of one checkpoint, which a new or lost checkpoint does not share.

    Batches are numbered from 0 by each checkpoint; its metadata holds the identity of its query.
    """
    return "run=" + spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def append_stream(df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet", **options: str) -> StreamingQuery:
    """Write all data available now, once, and stop."""
    writer = df.writeStream.format(file_format).options(**options).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def append_readable(
    records: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, quarantine: str, checkpoint: str
) -> StreamingQuery:
    """Write the transformed readable records, and the text of unreadable ones apart, then stop.

    A batch is parsed once, into a folder that the next batch writes over. Each batch has its own folder,
    written over when the batch is retried.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = _run_folder(spark, checkpoint)
        staged, folder = f"{quarantine}/_staged/{run}", f"{run}/batch_id={batch_id}"
        batch.withColumn("_bad", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("_bad").parquet(staged)
        rows = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("_bad", T.BooleanType())])).parquet(staged)
        transform(rows.filter("NOT _bad").drop(CORRUPT, "_bad")).write.mode("overwrite").parquet(f"{path}/{folder}")
        rows.filter("_bad").select(F.col(CORRUPT).alias("value")).write.mode("overwrite").text(f"{quarantine}/{folder}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _write_batch(batch: DataFrame, batch_id: int, target: str, quarantine: str, checkpoint: str) -> None:
    """Good files to the target and files with a malformed record to quarantine.

    The batch is parsed once, into a folder that the next batch writes over. Each batch has its own
    target folder, written over when the batch is retried, so no row is added twice. The bad files
    are at most the files of one batch, a number the reader is given, so they can be broadcast and
    a large file's rows stay where they are.
    """
    spark = batch.sparkSession
    run = _run_folder(spark, checkpoint)
    staged = f"{quarantine}/_staged/{run}"
    batch.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    bad_files = F.broadcast(rows.filter(F.col(CORRUPT).isNotNull()).select("_file").distinct())
    good = rows.join(bad_files, "_file", "left_anti").drop("_file", CORRUPT)
    good.write.mode("overwrite").parquet(f"{target}/{run}/batch_id={batch_id}")
    bad = rows.join(bad_files, "_file", "left_semi").withColumnsRenamed({"_file": "file_path", CORRUPT: "raw_record"})
    bad.write.mode("overwrite").json(f"{quarantine}/{run}/batch_id={batch_id}")


def ingest_files(
    spark: SparkSession,
    landing: str,
    target: str,
    quarantine: str,
    checkpoint: str,
    schema: T.StructType,
    archive: str | None = None,
    file_format: str = "csv",
    max_files: int = 1000,
    **options: str | bool,
) -> StreamingQuery:
    """Load files that have not been loaded yet, then stop.

    ``file_format`` is ``csv``, ``json`` or ``parquet``; ``options`` are the reader's, such as
    ``sep``, ``header`` (true unless given), ``quote``, ``nullValue``, ``dateFormat`` or
    ``timestampFormat``. A file with a malformed record is quarantined whole, with the raw text of
    its bad records. The checkpoint remembers files. With ``archive``, the files of all committed batches
    have moved there, below their paths in ``landing``, when this returns. ``max_files`` a batch, 10,000 at most, bound what is broadcast.
    """
    if not 0 < max_files <= MOST_FILES:
        raise ValueError(f"max_files must be from 1 to {MOST_FILES}")
    text = file_format != "parquet"
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if text else schema
    reader = spark.readStream.format(file_format).schema(wide).option("maxFilesPerTrigger", max_files)
    if text:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if file_format == "csv":
        reader = reader.option("header", True)
    rows = reader.options(**options).load(landing).withColumn("_file", F.col("_metadata.file_path"))
    rows = rows if text else rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    query = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: _write_batch(batch, batch_id, target, quarantine, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if archive:
        query.awaitTermination()
        archive_committed(spark, landing, checkpoint, archive)
    return query


def archive_committed(spark: SparkSession, landing: str, checkpoint: str, archive: str) -> None:
    """Move the files of batches that are committed and not archived yet.

    The source's log in the checkpoint names the files of each batch. The last batch whose files have all moved
    is noted afterwards, so a run that is lost in between moves the rest.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(f"{checkpoint}/commits")
    system = commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(commits):
        return
    last = max((int(s.getPath().getName()) for s in system.listStatus(commits) if s.getPath().getName().isdigit()), default=-1)
    done = f"{checkpoint}/_archived"
    before = -1
    if system.exists(hadoop.Path(done)):
        before = spark.read.schema("batch_id long").json(done).agg(F.max("batch_id")).first()[0]
    if last <= before:
        return
    entries = spark.read.text(f"{checkpoint}/sources/0").where(F.startswith("value", F.lit("{"))).select(F.from_json("value", "path string, batchId long").alias("e"))
    names = entries.where((F.col("e.batchId") > before) & (F.col("e.batchId") <= last)).select(decoded("e.path").alias("path")).distinct()
    archive_files(spark, [r["path"] for r in names.collect()], archive, landing)
    spark.createDataFrame([(last,)], "batch_id long").coalesce(1).write.mode("append").json(done)
