"""Calendars over the span of the orders, joined to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import decimal
from ..plans import calendar, loads
from ..session import scratch_path
from ..sinks import writers
from . import table, workload

# Month and day of the holidays used here.
HOLIDAYS = {"0101": "New Year", "0704": "Fourth of July", "1111": "Eleventh of November", "1225": "Christmas"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))


def _span(orders: DataFrame) -> DataFrame:
    return orders.agg(F.min("date").alias("first"), F.max("date").alias("last"))


def _holidays(span: DataFrame) -> DataFrame:
    code = F.date_format("date", "MMdd")
    name = F.coalesce(*[F.when(code == day, text) for day, text in HOLIDAYS.items()])
    return calendar.days(span).select("date", name.alias("holiday_description")).filter(F.col("holiday_description").isNotNull())


_DAYS_SQL = """
  span AS (SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders),
  all_days AS (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date, first_day FROM span)
"""


@workload(
    f"""
    WITH {_DAYS_SQL}
    SELECT CAST(date - first_day AS BIGINT) AS date_id, CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_wid, date,
           lower(dayname(date)) AS day_of_week, CAST(NULL AS VARCHAR) AS is_business_day, CAST(NULL AS VARCHAR) AS is_federal_holiday,
           CAST(NULL AS VARCHAR) AS holiday_description, coalesce(n, 0) AS orders
    FROM all_days LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) ON d = date
    """
)
def date_dim(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    counts = orders.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    return calendar.date_dim(_span(orders)).join(counts, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@workload(
    f"""
    WITH {_DAYS_SQL},
    months AS (SELECT DISTINCT lower(monthname(date)) AS month_description, last_day(date) AS end_of_month_date, strftime(date, '%Y%m') AS month_code FROM all_days)
    SELECT CAST(row_number() OVER (ORDER BY month_code) AS BIGINT) AS month_id, month_description, end_of_month_date, month_code,
           coalesce(n, 0) AS orders, total
    FROM months LEFT JOIN (SELECT strftime(o_orderdate, '%Y%m') AS m, count(*) AS n,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total FROM orders GROUP BY 1) ON m = month_code
    """
)
def month_dim(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    totals = orders.groupBy(F.date_format("date", "yyyyMM").alias("month_code")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(decimal("o_totalprice", 18, 2)).cast("decimal(38,2)").alias("total")
    )
    return calendar.month_dim(_span(orders)).join(totals, "month_code", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


_CALENDAR_SQL = f"""
  {_DAYS_SQL},
  flagged AS (
    SELECT date, first_day, CASE strftime(date, '%m%d') {" ".join(f"WHEN '{d}' THEN '{t}'" for d, t in HOLIDAYS.items())} END AS holiday_description
    FROM all_days),
  marked AS (
    SELECT *, CASE WHEN holiday_description IS NOT NULL THEN 'Y' ELSE 'N' END AS is_federal_holiday,
           CASE WHEN dayofweek(date) IN (0, 6) OR holiday_description IS NOT NULL THEN 'N' ELSE 'Y' END AS is_business_day FROM flagged),
  nexts AS (SELECT m.date, min(b.date) AS next_business_date FROM marked m LEFT JOIN marked b ON b.date > m.date AND b.is_business_day = 'Y' GROUP BY m.date),
  afters AS (SELECT n.date, n.next_business_date, min(b.date) AS day_after_business_date
             FROM nexts n LEFT JOIN marked b ON b.date > n.next_business_date AND b.is_business_day = 'Y' GROUP BY ALL),
  calendar AS (
    SELECT CAST(m.date - first_day AS BIGINT) AS date_id, CAST(strftime(m.date, '%Y%m%d') AS BIGINT) AS date_wid, m.date,
           lower(dayname(m.date)) AS day_of_week, next_business_date, day_after_business_date, is_business_day, is_federal_holiday,
           holiday_description, CAST(dense_rank() OVER (ORDER BY strftime(m.date, '%Y%m')) AS BIGINT) AS month_id
    FROM marked m JOIN afters a ON a.date = m.date)
"""


@workload(
    f"""
    WITH {_CALENDAR_SQL}
    SELECT c.*, coalesce(n, 0) AS orders FROM calendar c LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) ON d = date
    """
)
def calendar_load(spark, sf_dir):
    """Two loads of the dimensions, the second with repeated holidays; read back beside the orders of each day."""
    base, orders = scratch_path(spark, "calendar"), _orders(spark, sf_dir)
    span = _span(orders)
    holidays = _holidays(span).withColumn("date", F.col("date").cast("string"))
    for stamp, listed in (("20261130_000000", holidays.limit(1)), ("20261201_000000", holidays.unionAll(holidays))):
        loads.load_calendar(span, listed, base, stamp)
    counts = orders.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    stored = writers.current_version(spark, f"{base}/dates")
    return stored.join(counts, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@workload(
    f"""
    WITH {_CALENDAR_SQL}
    SELECT o_orderkey, c.* FROM orders JOIN calendar c ON c.date = CAST(o_orderdate AS DATE)
    """
)
def business_calendar_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    span = _span(orders)
    return orders.drop("o_totalprice").join(calendar.business_calendar(span, _holidays(span)), "date")
