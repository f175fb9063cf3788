"""Data checks, reconciliation and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import decimal
from ..operators import quality
from ..session import scratch_path
from ..sinks import writers
from ..sources import readers
from ..streaming import streams
from . import table, workload


@workload(
    """
    SELECT 'orders present' AS rule, 'orders' AS dataset, 'row_count' AS metric, (SELECT count(*) FROM orders) AS value,
           (SELECT count(*) FROM orders) > 0 AS passed
    UNION ALL SELECT 'status known', 'orders', 'failed_rows', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')),
           (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) = 0
    UNION ALL SELECT 'key unique', 'orders', 'duplicate_count', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)),
           (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) = 0
    UNION ALL SELECT 'type long enough', 'events', 'failed_rows', (SELECT count(*) FROM events WHERE length(event_type) < 6),
           (SELECT count(*) FROM events WHERE length(event_type) < 6) = 0
    UNION ALL SELECT 'one event per user', 'events', 'duplicate_count', (SELECT count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)),
           (SELECT count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)) = 0
    UNION ALL SELECT 'as many events as orders', 'orders,events', 'same_row_count',
           (SELECT count(*) FROM orders) - (SELECT count(*) FROM events), (SELECT count(*) FROM orders) = (SELECT count(*) FROM events)
    """
)
def dq_report(spark, sf_dir):
    datasets = {name: table(spark, sf_dir, name) for name in ("orders", "events")}
    rules = [
        {"name": "orders present", "type": "row_count", "dataset": "orders"},
        {"name": "status known", "type": "failed_rows", "dataset": "orders", "bad": "o_orderstatus NOT IN ('F', 'O')"},
        {"name": "key unique", "type": "duplicate_count", "dataset": "orders", "keys": ["o_orderkey"]},
        {"name": "type long enough", "type": "failed_rows", "dataset": "events", "bad": "length(event_type) < 6"},
        {"name": "one event per user", "type": "duplicate_count", "dataset": "events", "keys": ["user_id"]},
        {"name": "as many events as orders", "type": "same_row_count", "datasets": ["orders", "events"]},
    ]
    return quality.run_checks(datasets, rules)


@workload(
    """
    WITH days AS (SELECT '20261130_000000' AS run_stamp, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
                  UNION ALL SELECT '20261201_000000', o_orderkey, o_orderstatus FROM orders),
    found AS (
      SELECT run_stamp, 'orders present' AS rule, 'orders' AS dataset, 'row_count' AS metric, count(*) AS value, count(*) > 0 AS passed FROM days GROUP BY run_stamp
      UNION ALL
      SELECT run_stamp, 'status known', 'orders', 'failed_rows', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')),
             count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0 FROM days GROUP BY run_stamp)
    SELECT *, lag(value) OVER (PARTITION BY rule, dataset, metric ORDER BY run_stamp) AS previous FROM found
    """
)
def dq_repository(spark, sf_dir):
    """Two runs kept in the metrics repository, each value beside that of the run before: the second run has the pending orders too."""
    path, orders = scratch_path(spark, "metrics"), table(spark, sf_dir, "orders")
    rules = [
        {"name": "orders present", "type": "row_count", "dataset": "orders"},
        {"name": "status known", "type": "failed_rows", "dataset": "orders", "bad": "o_orderstatus NOT IN ('F', 'O')"},
    ]
    for stamp, rows in (("20261130_000000", orders.filter("o_orderstatus <> 'P'")), ("20261201_000000", orders)):
        quality.store_results(quality.run_checks({"orders": rows}, rules), path, stamp)
    stored = spark.read.schema("rule string, dataset string, metric string, value long, passed boolean, run_stamp string").parquet(path)
    return quality.with_previous(stored)


@workload("SELECT event_id, event_type FROM events WHERE length(event_type) < 6")
def failed_rows(spark, sf_dir):
    return quality.failed_rows(table(spark, sf_dir, "events").select("event_id", "event_type"), "length(event_type) < 6")


_TOTALS_SQL = """
    SELECT count(*) AS declared_rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS declared_checksum,
           count(*) AS loaded_rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS loaded_checksum,
           CAST(0 AS BIGINT) AS unreadable, true AS reconciled FROM lineitem
"""


@workload(f"SELECT t.*, loaded_rows AS promoted_rows FROM ({_TOTALS_SQL}) t")
def reconcile_counts(spark, sf_dir):
    """Trigger files declare rows and a checksum per supplier; the run's rows must add up to them."""
    base = scratch_path(spark, "reconcile")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", decimal("l_quantity", 18, 2).alias("quantity"), F.lit("run-1").alias("etl_process_id")
    )
    writers.append(lines, f"{base}/staged")
    declared = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("checksum"))
    declared.select(F.concat("l_suppkey", F.lit(".csv")), F.lit("20261201"), "n", "checksum").write.option("sep", "|").csv(f"{base}/triggers")
    ddl = "filename string, tmstmp string, record_count string, record_checksum string"
    triggers = readers.read_delimited(spark, f"{base}/triggers", ddl, sep="|", header=False)
    staged = spark.read.parquet(f"{base}/staged")
    verdict = quality.reconcile(triggers, staged, "etl_process_id", "run-1", "quantity")
    quality.promote(staged, verdict, f"{base}/main", "run-1")
    promoted = spark.read.parquet(f"{base}/main").agg(F.count(F.lit(1)).alias("loaded_rows"))
    return verdict.join(promoted.withColumn("promoted_rows", F.col("loaded_rows")), "loaded_rows")


@workload(
    """
    SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name, n_chars AS length FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def new_files_only(spark, sf_dir):
    checkpoint = scratch_path(spark, "processed")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    files = documents.select("doc_id", F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")).alias("file_name"), F.col("n_chars").alias("length"))
    done = files.join(labels.select("doc_id"), "doc_id", "left_semi").select("file_name", F.lit(1).cast("bigint").alias("rows_processed"))
    writers.record_processed(done, checkpoint)
    processed = spark.read.schema(writers.PROCESSED_SCHEMA).json(checkpoint)
    return readers.unprocessed(files.drop("doc_id"), processed)


@workload(
    """
    SELECT event_id, user_id AS c_custkey, c_name, c_mktsegment, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events JOIN customer ON c_custkey = user_id
    """
)
def stream_enrich(spark, sf_dir):
    base = scratch_path(spark, "stream")
    record = F.struct("event_id", F.col("user_id").alias("c_custkey"), F.from_json("props", "k int").alias("props"))
    table(spark, sf_dir, "events").select(F.to_json(record).alias("value")).write.text(f"{base}/in")
    records = streams.json_stream(spark, f"{base}/in", "event_id bigint, c_custkey bigint, props struct<k: int>")
    dimension = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")

    def joined(rows):
        return streams.enrich(rows, dimension, ["c_custkey"]).select("event_id", "c_custkey", "c_name", "c_mktsegment", "props.k")

    streams.append_readable(records, joined, f"{base}/out", f"{base}/bad", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("run", "batch_id")


@workload(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'quarantined' ELSE 'loaded' END AS outcome FROM orders
    UNION ALL SELECT o_orderkey, 'archived' FROM orders
    """
)
def stream_file_ingest(spark, sf_dir):
    """Files arrive in two waves; those with malformed records are set aside; the third run adds nothing."""
    base = scratch_path(spark, "ingest")
    orders = table(spark, sf_dir, "orders")
    schema = T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, o_orderstatus string")

    def arrive(status: str) -> None:
        price = F.lit("n/a") if status == "F" else F.col("o_totalprice").cast("string")
        wave = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", price.alias("o_totalprice"), "o_orderstatus")
        wave.write.mode("append").option("header", True).csv(f"{base}/landing")

    def ingest() -> None:
        streams.ingest_files(
            spark, f"{base}/landing", f"{base}/loaded", f"{base}/bad", f"{base}/checkpoint", schema, archive=f"{base}/archive"
        ).awaitTermination()

    arrive("O")
    arrive("F")
    ingest()
    arrive("P")
    ingest()
    ingest()
    loaded = spark.read.parquet(f"{base}/loaded").select("o_orderkey", F.lit("loaded").alias("outcome"))
    bad = spark.read.json(f"{base}/bad").select("o_orderkey", F.lit("quarantined").alias("outcome"))
    ddl = "o_orderkey bigint, o_totalprice string, o_orderstatus string"
    archived = spark.read.option("recursiveFileLookup", True).option("header", True).schema(ddl).csv(f"{base}/archive")
    return loaded.unionByName(bad).unionByName(archived.select("o_orderkey", F.lit("archived").alias("outcome")))


@workload("SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type <> 'view' THEN value END AS value FROM events")
def stream_typed_ingest(spark, sf_dir):
    """Semicolon-separated files with single quotes, a spelling of null and a date format."""
    base = scratch_path(spark, "ingest")
    events = table(spark, sf_dir, "events")
    quoted = F.concat(F.lit("'"), "event_type", F.lit("'"))
    value = F.when(F.col("event_type") == "view", "none").otherwise(F.col("value").cast("string"))
    line = F.concat_ws(";", "event_id", quoted, F.date_format("ts", "dd.MM.yyyy"), value)
    events.select(line.alias("value")).write.text(f"{base}/landing")
    schema = T.StructType.fromDDL("event_id bigint, event_type string, day date, value double")
    options = {"sep": ";", "quote": "'", "nullValue": "none", "dateFormat": "dd.MM.yyyy", "header": False}
    streams.ingest_files(spark, f"{base}/landing", f"{base}/loaded", f"{base}/bad", f"{base}/checkpoint", schema, **options).awaitTermination()
    return spark.read.parquet(f"{base}/loaded").select("event_id", "event_type", F.col("day").cast("string").alias("day"), "value")
