"""Scans of delimited, JSON, Parquet and JDBC data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import blank_to_null, null_spellings
from ..session import scratch_path
from . import lines, objects
from .schemas import schema_from_ddl

# File extension to format and separator.
EXTENSIONS = {"csv": ("csv", ","), "txt": ("csv", ","), "tsv": ("csv", "\t"), "parquet": ("parquet", None)}
CORRUPT = "_corrupt_record"


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema_from_ddl(schema) if isinstance(schema, str) else schema


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    strict: bool = False,
    multi_line: bool = False,
    **options: str | bool,
) -> DataFrame:
    """Delimited text with a given schema, or an inferred one when none is given.

    ``strict`` fails the job at its first malformed record. ``multi_line`` lets quoted fields
    hold line breaks; each file is then one task, so keep files to a size one task can read.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("multiLine", multi_line)
    if multi_line:
        reader = reader.option("escape", '"')
    if strict:
        reader = reader.option("mode", "FAILFAST")
    for name, value in options.items():
        reader = reader.option(name, value)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(_schema(schema))
    return reader.csv(path)


def read_with_corrupt(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ",", header: bool = True
) -> DataFrame:
    """Delimited text where a malformed record keeps its raw text in ``_corrupt_record``.

    Errors are found only in the columns a query reads: write all of them before splitting, as
    ``split_malformed`` does.
    """
    wide = T.StructType([*_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return read_delimited(spark, path, wide, sep, header, columnNameOfCorruptRecord=CORRUPT)


def typed(value: Column, to: T.DataType, date_format: str | None = None, timestamp_format: str | None = None) -> Column:
    """Text to a type, null where it does not fit."""
    if isinstance(to, T.DateType) and date_format:
        return F.try_to_timestamp(value, F.lit(date_format)).cast("date")
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)) and timestamp_format:
        return F.try_to_timestamp(value, F.lit(timestamp_format)).cast(to)
    return value if isinstance(to, T.StringType) else value.try_cast(to)


def read_typed_text(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    date_format: str | None = None,
    timestamp_format: str | None = None,
    spellings: Sequence[str] = ("", "null", "none"),
) -> DataFrame:
    """Named and typed columns; every spelling of null is null, blank lines are skipped."""
    target = _schema(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields])
    rows = read_delimited(spark, path, text, sep, header, quote=quote)
    return rows.select(
        *[
            typed(null_spellings(f"`{f.name}`", spellings), f.dataType, date_format, timestamp_format).alias(f.name)
            for f in target.fields
        ]
    )


def read_after_first_line(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, skip: int = 1
) -> DataFrame:
    """Delimited files with ``skip`` lines before the header, dropped from every file, wherever its splits lie.

    Without a schema the columns are text, named by the header, which must be the same in all files.
    """
    names = lines.headers(spark, path, skip, sep) if schema is None else None
    target = T.StructType([T.StructField(n, T.StringType()) for n in names]) if names else _schema(schema)
    body = lines.after_first_lines(spark, path, skip + 1)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target.fields)
    parsed = body.filter(F.col("value") != "").select(F.from_csv("value", ddl, {"sep": sep}).alias("r"))
    return parsed.select("r.*")


def read_quoted(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ",", header: bool = True, **options: str | bool
) -> DataFrame:
    """As :func:`read_delimited` with ``multi_line``, but large files are read by many tasks.

    The rules for quotes are those of :func:`lines.quoted_records`; ``options`` are those of ``from_csv``.
    """
    target = _schema(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target.fields)
    given = {"sep": sep, "escape": '"', "multiLine": "true", **{k: str(v) for k, v in options.items()}}
    return lines.quoted_records(spark, path, header).select(F.from_csv("value", ddl, given).alias("r")).select("r.*")


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
    case_sensitive: bool = False,
) -> DataFrame:
    """JSON records, one per line or one per file; without a schema all their fields are united.

    ``case_sensitive`` keeps names apart that differ only in case. It reads in a session of its
    own, so rename such columns before combining the result with other data.
    """
    if case_sensitive:
        spark = spark.newSession()
        spark.conf.set("spark.sql.caseSensitive", "true")
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_objects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, **options: str | bool) -> DataFrame:
    """As :func:`read_json` with ``multi_line``, but large files are read by many tasks.

    The rules for files are those of :func:`objects.json_objects`, which also takes objects one after
    another; ``options`` are those of Spark's JSON reader. Without a schema the records are stored as lines once,
    since they are read twice from then on.
    """
    found = objects.json_objects(spark, path)
    if schema is None:
        staged = scratch_path(spark, "objects")
        # Strings hold no bare line breaks, so these stand between values only.
        found.select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value")).write.text(staged)
        return spark.read.options(**options).json(staged)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(schema).fields)
    return found.select(F.from_json("value", ddl, {k: str(v) for k, v in options.items()}).alias("r")).select("r.*")


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()


def _retyped(value: Column, to: T.DataType) -> Column:
    if isinstance(to, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_retyped(value[f.name], f.dataType).alias(f.name) for f in to.fields]))
    if isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: _retyped(x, to.elementType))
    return value if isinstance(to, T.StringType) else typed(blank_to_null(value), to)


def read_lenient_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON whose typed fields may hold empty strings, which become null."""
    rows = read_json(spark, path, _as_text(schema), multi_line)
    return rows.select(*[_retyped(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def read_parquet_merged(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet whose files have gained columns over time."""
    return spark.read.option("mergeSchema", True).parquet(*([path] if isinstance(path, str) else path))


def latest_partition_value(df: DataFrame, column: str) -> object:
    """The greatest value of a partition column, in its own type; null partitions do not count.

    Partition values come with the file listing, so no column is read from the files.
    """
    value = df.agg(F.max(column)).first()[0]
    if value is None:
        raise ValueError(f"no files partitioned by {column}")
    return value


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the greatest value of a partition column; the filter on it prunes all other partitions."""
    return df.filter(F.col(column) == F.lit(latest_partition_value(df, column)).cast(df.schema[column].dataType))


def read_latest_file(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    schema: T.StructType | str | None = None,
    pattern: str = "*",
    **options: str | bool,
) -> DataFrame:
    """The file with the greatest path below a folder; only names are read to find it."""
    newest = listed_files(spark, path, pattern).agg(F.max("path")).first()[0]
    if newest is None:
        raise ValueError(f"no files {pattern} below {path}")
    reader = spark.read.format(file_format).options(**options)
    return (reader.option("inferSchema", True) if schema is None else reader.schema(_schema(schema))).load(newest)


def read_by_extension(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in EXTENSIONS:
        raise ValueError(f"no reader for .{extension}; there are {sorted(EXTENSIONS)}")
    file_format, sep = EXTENSIONS[extension]
    if file_format == "parquet":
        return spark.read.parquet(path)
    return read_delimited(spark, path, schema, sep, header)


def jdbc_options(
    connection: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or a query; a table can be read in parallel ranges."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {**connection, "fetchsize": str(fetch_size)}
    options["dbtable" if table else "query"] = table or query
    if partition_column:
        if query or not bounds or not partitions:
            raise ValueError("a partitioned read takes a table, its bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], **request) -> DataFrame:
    """A JDBC table or query; filters, columns and aggregates are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(connection, **request)).load()


def split_arrivals(messages: DataFrame, column: str = "message", max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Arrived files and rejected records, from messages whose body is JSON inside JSON.

    A message may hold many records. Arrivals have bucket, key, size and receipt; rejected ones
    have the message, the record's body and a reason: ``unreadable``, or ``too large`` when
    ``max_bytes`` is given.
    """
    envelope = "Records array<struct<body: string, receiptHandle: string>>"
    body = "detail struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>"
    records = messages.select(F.col(column).alias("message"), F.explode_outer(F.from_json(column, envelope)["Records"]).alias("_record"))
    found = records.select("message", "_record.body", F.col("_record.receiptHandle").alias("receipt"), F.from_json("_record.body", body)["detail"].alias("_detail"))
    key, size = F.col("_detail.object.key"), F.col("_detail.object.size")
    large = F.lit(False) if max_bytes is None else F.coalesce(size > max_bytes, F.lit(False))
    judged = found.withColumn("reason", F.when(key.isNull(), "unreadable").when(large, "too large"))
    arrivals = judged.filter("reason IS NULL").select(F.col("_detail.bucket.name").alias("bucket"), key.alias("key"), size.alias("size"), "receipt")
    return arrivals, judged.filter("reason IS NOT NULL").select("message", "body", "reason")


def parse_arrivals(messages: DataFrame, column: str = "message", max_bytes: int | None = None) -> DataFrame:
    """The arrivals of :func:`split_arrivals`."""
    return split_arrivals(messages, column, max_bytes)[0]


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, path and size of the files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length")


def unprocessed(files: DataFrame, processed: DataFrame | None, on: str = "file_name") -> DataFrame:
    """Files the checkpoint table does not name."""
    return files if processed is None else files.join(processed.select(on), on, "left_anti")
