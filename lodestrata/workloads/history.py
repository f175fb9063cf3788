"""Latest rows, merges and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import age_in_years, decimal, hash_key, open_end_date
from ..operators import merge
from ..operators.columns import LOAD_COLUMN, add_audit, between_checkpoints, stamp_load
from ..operators.latest import latest_per_key, latest_value_rows
from ..plans.loads import history_rows, load_delete_insert, load_history, load_upserted
from ..session import scratch_path
from ..sinks.writers import current_version, overwrite_bucketed
from . import table, workload


def _as_of() -> Column:
    return F.to_date(F.lit("2026-12-01"))


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_totalprice", decimal("o_totalprice", 18, 2))


def order_feed(orders: DataFrame) -> DataFrame:
    """Open orders with a new status and price, and pending orders reissued under new keys."""
    changed = orders.filter(F.col("o_orderstatus") == "O").withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": (F.col("o_totalprice") + 10).cast("decimal(18,2)")}
    )
    reissued = orders.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return changed.unionByName(reissued)


_FEED_SQL = """
  target AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
                    o_orderdate, o_orderpriority FROM orders),
  feed AS (
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, CAST(o_totalprice + 10 AS DECIMAL(18,2)) AS o_totalprice,
           o_orderdate, o_orderpriority FROM target WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM target WHERE o_orderstatus = 'P')
"""


@workload(
    """
    SELECT * EXCLUDE (rn) FROM (
      SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
    """
)
def latest_per_key_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return latest_per_key(orders, ["o_custkey"], F.col("o_orderdate"), [F.col("o_orderkey")])


@workload(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS load_month FROM orders
    WHERE strftime(o_orderdate, '%Y%m') = (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)
    """
)
def latest_value_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("load_month")
    )
    return latest_value_rows(orders, "load_month")


@workload(
    """
    WITH last_order AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                     FROM orders) WHERE rn = 1)
    SELECT n_name, c_mktsegment, count(*) AS customers, count(o_orderkey) AS with_orders,
           max(o_orderdate) AS last_order_date, max(CASE WHEN o_orderstatus = 'F' THEN c_name END) AS last_filled,
           max(CASE WHEN o_orderstatus IN ('O', 'P') THEN c_name END) AS last_unfilled,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS last_total
    FROM customer LEFT JOIN last_order ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment
    """
)
def latest_order_summary(spark, sf_dir):
    """The flagship: latest order per customer, joined to its dimensions, attributes to columns."""
    from ..operators.reshape import attribute_columns

    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    latest = latest_per_key(orders, ["o_custkey"], F.col("o_orderdate"), [F.col("o_orderkey")])
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return (
        customers.join(latest, customers.c_custkey == latest.o_custkey, "left")
        .join(nations, customers.c_nationkey == nations.n_nationkey, "left")
        .groupBy("n_name", "c_mktsegment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count("o_orderkey").alias("with_orders"),
            F.max("o_orderdate").alias("last_order_date"),
            *attribute_columns(
                F.col("o_orderstatus"), F.col("c_name"), {"last_filled": ["F"], "last_unfilled": ["O", "P"]}
            ),
            F.sum(decimal("o_totalprice", 18, 2)).cast("decimal(38,2)").alias("last_total"),
        )
    )


VERSIONED_MERGE_SQL = f"""
WITH {_FEED_SQL}
SELECT *, '20261201_000000' AS partition_load_dt_tmstmp,
       TIMESTAMP '2026-12-01 00:00:00' AS audit_created_tmstmp, TIMESTAMP '2026-12-01 00:00:00' AS audit_updated_tmstmp,
       'loader' AS audit_created_by, 'loader' AS audit_updated_by, 'orders' AS audit_data_source
FROM (SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.o_orderkey = t.o_orderkey)
      UNION ALL SELECT * FROM feed)
"""


@workload(VERSIONED_MERGE_SQL)
def merge_replace(spark, sf_dir):
    orders = priced_orders(spark, sf_dir)
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    stored = add_audit(stamp_load(orders, "20261130_000000"), at, "earlier", "orders")
    return merge.merge_replace(stored, order_feed(orders), ["o_orderkey"], "20261201_000000", at, "loader", "orders")


_LINES_SQL = """
  target AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity FROM lineitem),
  stage AS (SELECT l_orderkey, l_linenumber, l_partkey, 'X' AS l_returnflag, CAST(-l_quantity AS DECIMAL(18,2)) AS l_quantity
            FROM target WHERE l_returnflag = 'R')
"""


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", decimal("l_quantity", 18, 2).alias("l_quantity")
    )
    stage = target.filter(F.col("l_returnflag") == "R").withColumns(
        {"l_returnflag": F.lit("X"), "l_quantity": (-F.col("l_quantity")).cast("decimal(18,2)")}
    )
    return target, stage


_DELETE_INSERT_SQL = f"""
    WITH {_LINES_SQL}
    SELECT * FROM target t WHERE NOT EXISTS (
      SELECT 1 FROM stage s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
    UNION ALL SELECT * FROM stage
"""


@workload(_DELETE_INSERT_SQL)
def delete_insert(spark, sf_dir):
    target, stage = _lines(spark, sf_dir)
    return merge.delete_insert(target, stage, ["l_orderkey", "l_linenumber"])


@workload(_DELETE_INSERT_SQL)
def delete_insert_load(spark, sf_dir):
    """Two loads; the second replaces keys of the version the first stored."""
    base = scratch_path(spark, "replaced")
    for stamp, batch in zip(("20261130_000000", "20261201_000000"), _lines(spark, sf_dir)):
        load_delete_insert(spark, batch, base, ["l_orderkey", "l_linenumber"], stamp)
    return current_version(spark, base)


@workload(
    f"""
    WITH {_LINES_SQL}
    SELECT * FROM target t WHERE NOT EXISTS (
      SELECT 1 FROM stage s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
    """
)
def delete_matching(spark, sf_dir):
    target, stage = _lines(spark, sf_dir)
    return merge.delete_matching(target, stage, ["l_orderkey", "l_linenumber"])


_UPSERT_SQL = f"""
    WITH {_FEED_SQL}
    SELECT coalesce(f.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_custkey ELSE t.o_custkey END AS o_custkey,
           CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
           t.o_orderpriority AS o_orderpriority
    FROM target t FULL OUTER JOIN feed f ON t.o_orderkey = f.o_orderkey
"""


@workload(_UPSERT_SQL)
def merge_upsert(spark, sf_dir):
    orders = priced_orders(spark, sf_dir)
    return merge.merge_upsert(orders, order_feed(orders).drop("o_orderpriority"), ["o_orderkey"])


@workload(_UPSERT_SQL)
def upsert_load(spark, sf_dir):
    """Two loads; the second updates and adds to the version the first stored."""
    base, orders = scratch_path(spark, "upserted"), priced_orders(spark, sf_dir)
    for stamp, batch in (("20261130_000000", orders), ("20261201_000000", order_feed(orders).drop("o_orderpriority"))):
        load_upserted(spark, batch, base, ["o_orderkey"], stamp)
    return current_version(spark, base)


_HISTORY_SQL = """
  people AS (SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
                    sha256(c_name || CAST(c_custkey AS VARCHAR)) AS hash_key FROM customer),
  hist AS (
    SELECT *, DATE '2025-01-01' AS record_start_date, DATE '9999-09-09' AS record_end_date, CAST(1 AS BIGINT) AS current_indicator,
           DATE '2025-01-01' AS create_date, DATE '2025-01-01' AS update_date, 'loader' AS update_userid FROM people
    UNION ALL
    SELECT *, DATE '2020-01-01', DATE '2025-01-01', CAST(0 AS BIGINT), DATE '2020-01-01', DATE '2020-01-01', 'loader'
    FROM people WHERE c_mktsegment = 'BUILDING'),
  changed AS (
    SELECT c_custkey, c_name, 'RESTATED' AS c_mktsegment, c_acctbal, hash_key FROM people WHERE c_acctbal < 0
    UNION ALL
    SELECT -c_custkey - 1, c_name, c_mktsegment, c_acctbal, sha256(c_name || CAST(-c_custkey - 1 AS VARCHAR))
    FROM people WHERE c_mktsegment = 'MACHINERY'),
  stage AS (
    SELECT *, DATE '2026-12-01' AS record_start_date, DATE '9999-09-09' AS record_end_date, CAST(1 AS BIGINT) AS current_indicator,
           DATE '2026-12-01' AS create_date, DATE '2026-12-01' AS update_date, 'loader' AS update_userid FROM changed),
  loaded AS (
    SELECT h.c_custkey, h.c_name, h.c_mktsegment, h.c_acctbal, h.hash_key, h.record_start_date,
           CASE WHEN s.hash_key IS NOT NULL AND h.current_indicator = 1 THEN DATE '2026-12-01' ELSE h.record_end_date END AS record_end_date,
           CASE WHEN s.hash_key IS NOT NULL THEN 0 ELSE h.current_indicator END AS current_indicator,
           h.create_date, h.update_date, h.update_userid
    FROM hist h LEFT JOIN (SELECT DISTINCT hash_key FROM stage) s ON s.hash_key = h.hash_key
    UNION ALL SELECT * FROM stage)
"""


def _history_and_stage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    people = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        decimal("c_acctbal", 18, 2).alias("c_acctbal"),
        hash_key("c_name", "c_custkey").alias("hash_key"),
    )
    earlier, first = (F.to_date(F.lit(d)) for d in ("2025-01-01", "2020-01-01"))
    closed = merge.open_history(people.filter(F.col("c_mktsegment") == "BUILDING"), first, earlier, "loader")
    closed = closed.withColumn("current_indicator", F.lit(0).cast("bigint"))
    hist = merge.open_history(people, earlier, open_end_date(), "loader").unionByName(closed)
    restated = people.filter(F.col("c_acctbal") < 0).withColumn("c_mktsegment", F.lit("RESTATED"))
    fresh = people.filter(F.col("c_mktsegment") == "MACHINERY").withColumn("c_custkey", -F.col("c_custkey") - 1)
    fresh = fresh.withColumn("hash_key", hash_key("c_name", "c_custkey"))
    stage = merge.open_history(restated.unionByName(fresh), _as_of(), open_end_date(), "loader")
    return hist, stage


def _loaded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, stage = _history_and_stage(spark, sf_dir)
    return merge.scd2_load(hist, stage, ["hash_key"], _as_of())


@workload(f"WITH {_HISTORY_SQL} SELECT * FROM loaded")
def scd2_load(spark, sf_dir):
    return _loaded_history(spark, sf_dir)


@workload(f"WITH {_HISTORY_SQL} SELECT * FROM loaded")
def versioned_history(spark, sf_dir):
    """Two history loads; the second reads the version the first stored."""
    base = scratch_path(spark, "history")
    for stamp, batch in zip(("20261130_000000", "20261201_000000"), _history_and_stage(spark, sf_dir)):
        load_history(spark, batch, base, ["hash_key"], _as_of(), stamp)
    return history_rows(spark, base)


@workload(f"WITH {_HISTORY_SQL} SELECT * FROM loaded WHERE current_indicator = 1")
def scd2_current(spark, sf_dir):
    return merge.current_rows(_loaded_history(spark, sf_dir))


@workload(f"WITH {_HISTORY_SQL} SELECT * FROM loaded")
def scd2_load_bucketed(spark, sf_dir):
    """The history is stored by hash key, so only the staged keys are shuffled."""
    hist, stage = _history_and_stage(spark, sf_dir)
    path = scratch_path(spark, "history")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    overwrite_bucketed(hist, path, name, ["hash_key"], 8)
    return merge.scd2_load(spark.table(name), stage, ["hash_key"], _as_of())


@workload(
    """
    SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d_%H%M%S') AS partition_load_dt_tmstmp FROM events
    WHERE strftime(ts, '%Y%m%d_%H%M%S') > '20240105_120000' AND strftime(ts, '%Y%m%d_%H%M%S') <= '20240120_120000'
    """
)
def incremental_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd_HHmmss").alias(LOAD_COLUMN)
    )
    return between_checkpoints(events, LOAD_COLUMN, "20240105_120000", "20240120_120000")


@workload(
    """
    SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || o_orderpriority) AS hash_key,
           CAST(round((12 * (2026 - year(o_orderdate)) + (12 - month(o_orderdate)) + (1 - day(o_orderdate)) / 31.0) / 12, 0) AS BIGINT) AS age
    FROM orders
    """
)
def age_and_hash(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        hash_key("o_orderkey", "o_orderpriority").alias("hash_key"),
        age_in_years(F.to_date("o_orderdate"), _as_of()).alias("age"),
    )
