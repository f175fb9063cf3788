"""Versions of a table: a log of commits, each of which names a folder or a list of files.

Files are never changed. A new version names files of earlier ones again and adds its own, so a merge
rewrites only the files that hold a matched key. An entry of the log is put in place only if there
is none with its number yet: of two writers that began from one version, the second fails, and readers
see a version whole or not at all.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import distinct_keys
from ..storage import ConflictError, decoded, put_if_absent  # noqa: F401

VERSION_SCHEMA = "version string, path string, schema string, rows bigint, number bigint, files string, constants string"
FILE_SCHEMA = "file string, rows bigint"
#: the folder name that leads to a version's data, as a partition column beside the table's own
FOLDER = "version"


def version_log(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(VERSION_SCHEMA).json(f"{base}/_versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, base: str) -> Row | None:
    """The entry of the last commit, or ``None`` before the first."""
    log = version_log(spark, base)
    return log.agg(F.max_by(F.struct("*"), F.struct(F.coalesce("number", F.lit(0)), "version")).alias("e")).first()["e"] if log else None


def _unused(spark: SparkSession, base: str, version: str) -> None:
    log = version_log(spark, base)
    if log is not None and not log.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"{base}/{FOLDER}={version} is complete already")


def _next(after: Row | None) -> int:
    return ((after.number or 0) if after else 0) + 1


def _commit(spark: SparkSession, base: str, after: Row | None, **entry: object) -> None:
    number = _next(after)
    put_if_absent(spark, f"{base}/_versions/{number:012d}.json", json.dumps({**entry, "number": number}))


def write_version(df: DataFrame, base: str, version: str, view: str | None = None, keys: Sequence[str] = (), after: Row | None | bool = False) -> str:
    """Write a whole table as a new version beside the old ones, then make it current.

    A merge reads the current version while it writes the next, so nothing is written over its
    own input. The log keeps the schema, so that partition keys come back in their own types, and the
    number of rows. ``after`` is the entry the rows were made from; a commit since then is a
    ``ConflictError``. A view, when named, is then switched to the new version.
    """
    path, spark = f"{base}/{FOLDER}={version}", df.sparkSession
    after = newest(spark, base) if after is False else after
    _unused(spark, base, version)
    seen = Observation()
    rows = df.hint("rebalance", *keys) if keys else df
    # A folder that is not in the log is what a lost run left.
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*keys).parquet(path)
    _commit(spark, base, after, version=version, path=path, schema=df.schema.json(), rows=seen.get.get("rows", 0))
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return path


def _file() -> Column:
    """The path of a row's file as a reader takes it; the metadata column has it URL-encoded."""
    return decoded("_metadata.file_path")


def _constants(text: str | None) -> dict[str, Column]:
    kinds = {"timestamp": lambda v: F.timestamp_micros(F.lit(int(v)))}
    found = json.loads(text) if text else {}
    return {name: kinds.get(kind, lambda v, kind=kind: F.lit(v).cast(kind))(value) for name, (kind, value) in found.items()}


def constant_columns(entry: Row) -> dict[str, Column]:
    return _constants(entry.constants)


def constants(spark: SparkSession, values: dict[str, Column]) -> str:
    """Columns that have one value in all rows of a version, computed once and kept in its entry instead of its files."""
    row = spark.range(1).select(*[c.alias(n) for n, c in values.items()])
    kinds = dict(row.dtypes)
    texts = row.select(*[F.unix_micros(n).cast("string").alias(n) if kinds[n] == "timestamp" else F.col(n).cast("string").alias(n) for n in kinds]).first()
    return json.dumps({n: (kinds[n], texts[n]) for n in kinds})


def _read(spark: SparkSession, base: str, schema: StructType, files: Sequence[str]) -> DataFrame:
    """The named files, with the partition columns of their folders, and the path of each row's file as ``_file``."""
    if not files:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
    reader = spark.read.schema(StructType([*schema.fields]).add(FOLDER, "string")).option("basePath", base)
    return reader.parquet(*files).withColumn("_file", _file()).select(*[F.col(f"`{c}`") for c in schema.names], "_file")


def file_list(spark: SparkSession, base: str, entry: Row) -> DataFrame:
    """(file, rows) of a version."""
    if entry.files:
        return spark.read.schema(FILE_SCHEMA).parquet(entry.files)
    return _listed(spark, base, StructType.fromJson(json.loads(entry.schema)), entry.path)


def _listed(spark: SparkSession, base: str, schema: StructType, path: str) -> DataFrame:
    """The files below a folder with rows, by their own counts."""
    return spark.read.schema(schema).parquet(path).groupBy(_file().alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def stored_rows(spark: SparkSession, base: str, entry: Row, files: DataFrame | None = None) -> DataFrame:
    """What the files of a version hold, or some of them, with ``_file``; constants are not added."""
    names = [r[0] for r in (file_list(spark, base, entry) if files is None else files).select("file").collect()]
    return _read(spark, base, StructType.fromJson(json.loads(entry.schema)), names)


def read_version(spark: SparkSession, base: str, entry: Row) -> DataFrame:
    """A version as a table. However many loads made it, it is one scan."""
    if entry.files:
        return stored_rows(spark, base, entry).drop("_file").withColumns(_constants(entry.constants))
    reader = spark.read.schema(StructType.fromJson(json.loads(entry.schema))) if entry.schema else spark.read
    return reader.parquet(entry.path)


def current_version(spark: SparkSession, base: str) -> DataFrame | None:
    """The table as last committed, or ``None`` before the first version."""
    entry = newest(spark, base)
    return read_version(spark, base, entry) if entry else None


def all_versions(spark: SparkSession, base: str) -> list[DataFrame]:
    """Every version, oldest first."""
    log = version_log(spark, base)
    return [read_version(spark, base, e) for e in log.orderBy("number", "version").collect()] if log else []


def files_with_keys(rows: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """The files that hold a key of the second table, of rows as ``stored_rows`` gives them; only key columns are read.

    Rows are shuffled and sorted with a hash of their file's path: paths compress so well that tasks sized by
    what was shuffled would hold many times that in memory. Two paths of one hash only name a file too many.
    """
    mark = F.xxhash64("_file").alias("_mark")
    held = rows.select(*names, mark).join(distinct_keys(keys, names), list(names), "left_semi").select("_mark").distinct()
    return rows.select(F.col("_file").alias("file"), mark).distinct().join(held, "_mark", "left_semi").select("file")


def write_changed(
    spark: SparkSession,
    rows: DataFrame,
    base: str,
    version: str,
    after: Row | None,
    replaced: DataFrame | None,
    keys: Sequence[str] = (),
    shared: dict[str, Column] | None = None,
    ready: Callable[[int, DataFrame], None] | None = None,
) -> str:
    """Store rows as new files, and commit a version of them and of the files of ``after`` that they do not replace.

    ``shared`` columns have one value in all rows of the version, also in those of files named again.
    ``ready`` gets the version's number and its rows, with ``_file``, right before the commit.
    """
    path, folder = f"{base}/{FOLDER}={version}", f"{base}/_files/{FOLDER}={version}"
    if FOLDER in rows.columns:
        raise ValueError(f"a table kept by files may not have a column {FOLDER}")
    _unused(spark, base, version)
    stored = rows.drop("_file")
    (stored.hint("rebalance", *keys) if keys else stored).write.mode("overwrite").partitionBy(*keys).parquet(path)
    files = _listed(spark, base, stored.schema, path)
    if after is not None:
        kept = file_list(spark, base, after)
        files = files.unionByName(kept if replaced is None else kept.join(replaced, "file", "left_anti"))
    files.write.mode("overwrite").parquet(folder)
    named = spark.read.schema(FILE_SCHEMA).parquet(folder)
    count = named.agg(F.sum("rows")).first()[0] or 0
    if ready:
        ready(_next(after), _read(spark, base, stored.schema, [r[0] for r in named.select("file").collect()]))
    _commit(spark, base, after, version=version, path=path, schema=stored.schema.json(), rows=count, files=folder, constants=constants(spark, shared) if shared else None)
    return path
