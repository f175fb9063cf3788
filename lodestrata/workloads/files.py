"""Files written from the tables and scanned back in every supported way."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import decimal, strip_line_breaks
from ..operators.columns import LOAD_COLUMN, stamp_load
from ..operators.latest import latest_value_rows
from ..operators.merge import full_reload as reload
from ..plans import loads
from ..session import scratch_path
from ..sinks import writers
from ..sources import readers
from . import history, table, workload

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_CUSTOMER_DDL = "c_custkey bigint, c_name varchar(25), c_nationkey integer, c_acctbal double, c_mktsegment varchar(10)"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@workload(_CUSTOMER_SQL)
def scan_csv_schema(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _customers(spark, sf_dir).write.options(sep="\t", header=True).csv(path)
    return readers.read_delimited(spark, path, _CUSTOMER_DDL, sep="\t")


@workload(
    """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """
)
def scan_csv_infer(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _customers(spark, sf_dir).write.options(sep="|", header=True).csv(path)
    return readers.read_delimited(spark, path, sep="|")


@workload(_CUSTOMER_SQL)
def scan_csv_strict(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _customers(spark, sf_dir).write.option("header", True).csv(path)
    return readers.read_delimited(spark, path, _CUSTOMER_DDL, strict=True)


@workload(
    f"SELECT *, '20261201_000000' AS load_stamp FROM ({_CUSTOMER_SQL})"
)
def scan_space_separated(spark, sf_dir):
    source, landed = scratch_path(spark, "spaced"), scratch_path(spark, "landed")
    _customers(spark, sf_dir).write.options(sep=" ", header=True).csv(source)
    rows = stamp_load(readers.read_delimited(spark, source, _CUSTOMER_DDL, sep=" "), "20261201_000000", "load_stamp")
    writers.overwrite_partitions(rows, landed, ["load_stamp"])
    return spark.read.parquet(landed).withColumn("load_stamp", F.col("load_stamp").cast("string"))


@workload(
    """
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
           DATE '2020-01-01' + c_nationkey AS joined FROM customer
    """
)
def scan_typed_text(spark, sf_dir):
    path = scratch_path(spark, "typed")
    text = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).otherwise("None").alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("null").alias("c_acctbal"),
        F.date_format(F.date_add(F.lit("2020-01-01"), F.col("c_nationkey")), "dd/MM/yyyy").alias("joined"),
    )
    text.write.option("header", True).csv(path)
    ddl = "c_custkey bigint, c_name text, c_acctbal double, joined date"
    return readers.read_typed_text(spark, path, ddl, date_format="dd/MM/yyyy")


def _framed(batches: Iterator[pa.RecordBatch], first: list[str], between: str, last: list[str]) -> Iterator[pa.RecordBatch]:
    """Lines of one file: leading lines, the rows with a separator before all but the first, closing lines."""
    started = False
    for batch in batches:
        lines = pc.binary_join_element_wise(pa.scalar(between), batch.column(0), "")
        if not started and len(batch):
            yield pa.RecordBatch.from_pydict({"value": [*first, batch.column(0)[0].as_py()]})
            started, lines = True, lines.slice(1)
        yield pa.RecordBatch.from_pydict({"value": lines})
    if started and last:
        yield pa.RecordBatch.from_pydict({"value": last})


@workload(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
    """
)
def scan_skip_first(spark, sf_dir):
    path = scratch_path(spark, "skip")
    lines = table(spark, sf_dir, "customer").select(F.concat_ws(";", "c_custkey", "c_name", "c_mktsegment").alias("value"))
    lead = ["extract of the day", "c_custkey;c_name;c_mktsegment"]
    lines.repartition("value").mapInArrow(lambda b: _framed(b, lead, "", []), "value string").write.text(path)
    return readers.read_after_first_line(spark, path, sep=";")


@workload("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events")
def scan_multiline_json(spark, sf_dir):
    path = scratch_path(spark, "multiline")
    record = F.struct("event_id", "user_id", "value", F.from_json("props", "k bigint").alias("props"))
    lines = table(spark, sf_dir, "events").select(F.to_json(record, {"pretty": "true"}).alias("value"))
    lines.mapInArrow(lambda b: _framed(b, ["["], ",", ["]"]), "value string").write.text(path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, value double, props struct<k: bigint>")
    return readers.read_json(spark, path, schema, multi_line=True).select("event_id", "user_id", "props.k", "value")


@workload("SELECT l_orderkey AS orderkey, l_linenumber AS line, l_returnflag || ' {\"}\" \\ ' || l_linestatus AS status FROM lineitem")
def scan_json_objects(spark, sf_dir):
    """Arrays of nested records without line breaks, whose files are read by many tasks."""
    path = scratch_path(spark, "objects")
    line = F.struct(F.col("l_linenumber").alias("line"), F.concat("l_returnflag", F.lit(' {"}" \\ '), "l_linestatus").alias("status"))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    records = orders.select(F.to_json(F.struct(F.col("l_orderkey").alias("orderkey"), "lines")).alias("value"))
    records.mapInArrow(lambda b: _framed(b, ["["], ",", ["]"]), "value string").write.option("lineSep", " ").text(path)
    found = readers.read_json_objects(spark, path, "orderkey bigint, lines array<struct<line: integer, status: string>>")
    return found.select("orderkey", F.explode("lines").alias("l")).select("orderkey", "l.line", "l.status")


@workload(
    """
    SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS clicker, CASE WHEN event_type <> 'click' THEN value END AS amount FROM events
    """
)
def scan_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    events = table(spark, sf_dir, "events")
    clicked = F.to_json(F.struct("event_id", F.col("user_id").alias("clicker")))
    others = F.to_json(F.struct("event_id", F.col("value").alias("amount")))
    events.select(F.when(F.col("event_type") == "click", clicked).otherwise(others)).write.text(path)
    return readers.read_json(spark, path)


@workload(
    """
    SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value,
           CASE WHEN event_type <> 'error' THEN [CAST(user_id AS BIGINT), NULL] END AS ids FROM events
    """
)
def scan_lenient_json(spark, sf_dir):
    path = scratch_path(spark, "lenient")
    value = F.when(F.col("event_type") != "view", F.col("value").cast("string")).otherwise("")
    ids = F.when(F.col("event_type") != "error", F.array(F.col("user_id").cast("string"), F.lit("")))
    table(spark, sf_dir, "events").select("event_id", value.alias("value"), ids.alias("ids")).write.json(path)
    schema = T.StructType.fromDDL("event_id bigint, value double, ids array<bigint>")
    return readers.read_lenient_json(spark, path, schema)


@workload("SELECT page_id, url AS host_ip, length(html) AS host_url FROM pages")
def scan_case_sensitive_json(spark, sf_dir):
    from ..operators.columns import rename_by_substring

    """Each file is one array whose records go over several lines."""
    path = scratch_path(spark, "cases")
    host = F.concat(F.lit('{\n"page_id":'), "page_id", F.lit(',\n"host":"'), "url", F.lit('",\n"Host":'), F.length("html"), F.lit("}"))
    part = F.floor(F.col("page_id") / 100).alias("part")
    files = table(spark, sf_dir, "pages").groupBy(part).agg(F.concat(F.lit("["), F.array_join(F.collect_list(host), ",\n"), F.lit("]")).alias("value"))
    files.write.partitionBy("part").text(path)
    rows = readers.read_json(spark, path, multi_line=True, case_sensitive=True).drop("part")
    return rename_by_substring(rows, {"host": "host_ip", "Host": "host_url"})


@workload(
    """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment,
           CASE WHEN c_acctbal >= 0 THEN 'later' ELSE 'early' END AS load FROM customer
    """
)
def scan_merge_schema(spark, sf_dir):
    path = scratch_path(spark, "evolving")
    customers = table(spark, sf_dir, "customer")
    customers.filter("c_acctbal < 0").select("c_custkey", "c_name").write.parquet(f"{path}/load=early")
    customers.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment").write.parquet(f"{path}/load=later")
    return readers.read_parquet_merged(spark, path)


@workload("SELECT * FROM orders")
def scan_by_extension_parquet(spark, sf_dir):
    return readers.read_by_extension(spark, f"{sf_dir}/orders.parquet")


@workload(_CUSTOMER_SQL)
def scan_by_extension_tsv(spark, sf_dir):
    path = f"{scratch_path(spark, 'extension')}/customer.tsv"
    _customers(spark, sf_dir).write.options(sep="\t", header=True).csv(path)
    return readers.read_by_extension(spark, path, _CUSTOMER_DDL)


@workload(
    """
    SELECT o_orderkey, o_totalprice, CAST(month(o_orderdate) AS INTEGER) AS load_month FROM orders
    WHERE month(o_orderdate) = (SELECT max(month(o_orderdate)) FROM orders)
    """
)
def latest_partition_scan(spark, sf_dir):
    """Months are numbers without leading zeros, so their order as text would be another one."""
    path = scratch_path(spark, "months")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("load_month"))
    writers.overwrite_partitions(orders, path, ["load_month"])
    return readers.latest_partition(spark.read.parquet(path), "load_month")


@workload(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders
    """
)
def partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "partitions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.overwrite_partitions(orders, path, ["o_orderstatus"])
    again = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    writers.overwrite_partitions(again, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@workload("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def latest_file_scan(spark, sf_dir):
    """A file for each order status; the greatest name is that of the pending orders."""
    landing, orders = scratch_path(spark, "feeds"), table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        feed = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", decimal("o_totalprice", 18, 2).alias("o_totalprice"))
        feed.coalesce(1).write.option("header", True).csv(f"{landing}/feed_{status}")
    return readers.read_latest_file(spark, landing, schema="o_orderkey bigint, o_totalprice decimal(18,2)", pattern="*.csv", header=True)


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def external_table(spark, sf_dir):
    path = scratch_path(spark, "external")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.overwrite_partitions(orders, path, ["o_orderstatus"])
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    writers.register_external_table(spark, name, path, "o_orderstatus")
    return spark.table(name)


@workload(r"SELECT doc_id, regexp_replace(text, '\n', '', 'g') AS text, source FROM documents")
def line_break_cleanup(spark, sf_dir):
    """Fields with line breaks, quotes and commas through quoted CSV, cleaned on the way back."""
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    writers.write_quoted_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), raw)
    ddl = "doc_id string, text string, source string"
    rows = readers.read_quoted(spark, raw, ddl)
    writers.write_quoted_csv(rows.select(*[strip_line_breaks(c).alias(c) for c in rows.columns]), clean)
    return readers.read_delimited(spark, clean, "doc_id bigint, text string, source string", escape='"')


@workload(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'bad' ELSE 'good' END AS outcome FROM orders
    """
)
def quarantine_split(spark, sf_dir):
    path = scratch_path(spark, "malformed")
    price = F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf_dir, "orders").select("o_orderkey", price, "o_orderstatus").write.csv(path)
    rows = readers.read_with_corrupt(spark, path, "o_orderkey bigint, o_totalprice double, o_orderstatus string", header=False)
    good, bad = writers.split_malformed(rows, readers.CORRUPT, f"{path}-split")
    marked = [part.select("o_orderkey", F.lit(outcome).alias("outcome")) for part, outcome in ((good, "good"), (bad, "bad"))]
    return marked[0].unionByName(marked[1])


@workload(
    """
    SELECT 'l_returnflag=' || l_returnflag AS folder, count(*) AS total_rows, CAST(3 AS INTEGER) AS total_columns, true AS named_apart,
           true AS all_hashed, true AS all_sized FROM lineitem GROUP BY l_returnflag
    """
)
def file_manifest(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    writers.overwrite_partitions(lines, f"{path}/data", ["l_returnflag"])
    rows = writers.manifest(spark, f"{path}/data", F.lit("2026-12-01T00:00:00"), "lines", "run-1")
    writers.write_manifest(rows, f"{path}/triggers", f"{path}/lines.index")
    written = spark.read.option("pathGlobFilter", "*.trg.json").json(f"{path}/triggers")
    return written.groupBy(F.substring_index("DataFileName", "/", 1).alias("folder")).agg(
        F.sum("NumberOfRows").alias("total_rows"),
        (F.count_distinct("TriggerFileName") == F.count(F.lit(1))).alias("named_apart"),
        F.max("NumberOfColumns").cast("int").alias("total_columns"),
        F.every(F.length("MD5HashKey") == 32).alias("all_hashed"),
        F.every(F.col("DataFileSize") > 0).alias("all_sized"),
    )


@workload("SELECT count(*) AS total_rows, true AS within_limit FROM lineitem")
def file_sizing(spark, sf_dir):
    lines, path = table(spark, sf_dir, "lineitem"), scratch_path(spark, "sized")
    limit = writers.records_per_file(lines, scratch_path(spark, "sample"), target_bytes=200_000, fraction=0.1)
    writers.write_sized(lines, path, limit)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("total_rows"), F.every(F.col("n") <= limit).alias("within_limit"))


@workload("SELECT l_returnflag, count(*) AS stored, (SELECT count(*) FROM lineitem) AS written FROM lineitem GROUP BY l_returnflag")
def source_target_counts(spark, sf_dir):
    path = scratch_path(spark, "counted")
    written = writers.write_counted(table(spark, sf_dir, "lineitem"), path)
    stored = spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("stored"))
    return stored.withColumn("written", F.lit(written).cast("bigint"))


@workload(
    """
    SELECT c_custkey, c_name, CAST(NULL AS DATE) AS joined, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer
    """
)
def full_reload(spark, sf_dir):
    path = scratch_path(spark, "reload")
    customers = table(spark, sf_dir, "customer")
    writers.overwrite(customers.selectExpr("-c_custkey AS c_custkey", "c_name", "current_date() AS joined", "cast(c_acctbal AS decimal(18,2)) AS balance"), path)
    stage = customers.select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"))
    target = spark.read.parquet(path)
    writers.overwrite(reload(target, stage), f"{path}-next")
    return spark.read.parquet(f"{path}-next")


@workload(
    """
    SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS partition_load_dt_tmstmp FROM events WHERE strftime(ts, '%Y%m%d_%H%M%S') <= '20240125_000000'
    """
)
def incremental_load(spark, sf_dir):
    base = scratch_path(spark, "incremental")
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd_HHmmss").alias(LOAD_COLUMN))
    for until in ("20240110_000000", "20240125_000000"):
        loads.load_incremental(spark, events, f"{base}/checkpoint", until, loads.write_range(f"{base}/data"))
    return spark.read.parquet(f"{base}/data").drop("after")


@workload(history.VERSIONED_MERGE_SQL)
def versioned_merge(spark, sf_dir):
    """Two merges; the second reads the version the first stored."""
    base = scratch_path(spark, "versions")
    orders = history.priced_orders(spark, sf_dir)
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    for stamp, batch in (("20261130_000000", orders), ("20261201_000000", history.order_feed(orders))):
        loads.load_merged(spark, batch, base, ["o_orderkey"], stamp, at, "loader", "orders")
    return writers.current_version(spark, base)


@workload(
    """
    WITH target AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y') AS order_year FROM orders),
    feed AS (SELECT o_orderkey, 'F' AS o_orderstatus, CAST(o_totalprice + 10 AS DECIMAL(18,2)) AS o_totalprice, order_year FROM target
             WHERE o_orderstatus = 'O' AND order_year = (SELECT max(order_year) FROM target)
             UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_totalprice, order_year FROM target
             WHERE o_orderstatus = 'P' AND order_year = (SELECT max(order_year) FROM target))
    SELECT *, CASE WHEN order_year = (SELECT max(order_year) FROM target) THEN '20261201_000000' ELSE '20261130_000000' END AS partition_load_dt_tmstmp
    FROM (SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.o_orderkey = t.o_orderkey AND f.order_year = t.order_year)
          UNION ALL SELECT * FROM feed)
    """
)
def partition_merge(spark, sf_dir):
    """The batch is from the last year of orders, so only that year's partition is rewritten."""
    base = scratch_path(spark, "yearly")
    name = base.rsplit("/", 1)[-1].replace("-", "_")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("order_year")]
    orders = history.priced_orders(spark, sf_dir)
    target = orders.select(*columns)
    feed = latest_value_rows(history.order_feed(orders).select(*columns), "order_year")
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    for stamp, batch in (("20261130_000000", target), ("20261201_000000", feed)):
        loads.load_merged_partitions(spark, batch, name, base, ["o_orderkey", "order_year"], "order_year", stamp, at, "loader", "orders")
    return spark.table(name).select("o_orderkey", "o_orderstatus", "o_totalprice", "order_year", LOAD_COLUMN)


@workload(
    """
    SELECT c_mktsegment, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS balance
    FROM customer WHERE c_acctbal > 100 GROUP BY c_mktsegment
    """
)
def sql_transform(spark, sf_dir):
    text = """
      SELECT c_mktsegment, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS balance
      FROM {customer} WHERE c_acctbal > :floor GROUP BY c_mktsegment
    """
    path = scratch_path(spark, "sql")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return loads.transform_sql(spark, loads.read_sql_text(spark, path), {"customer": table(spark, sf_dir, "customer")}, floor=100)
