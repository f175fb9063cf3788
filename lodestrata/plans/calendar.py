"""Date and month dimensions with business days.

A calendar has one row per day, so its size is bounded by the date type whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import dirty_cast
from ..operators.columns import constant
from ..operators.joins import lookup
from ..operators.latest import next_qualifying

# Fixed values.
FIRST_DAY = "2000-01-01"
YEARS_AHEAD = 5


def default_span(spark: SparkSession, as_of: Column) -> DataFrame:
    """From the first day to the end of the fifth year after ``as_of``."""
    last = F.make_date(F.year(as_of) + YEARS_AHEAD, F.lit(12), F.lit(31))
    return spark.range(1).select(F.lit(FIRST_DAY).cast("date").alias("first"), last.alias("last"))


def days(span: DataFrame) -> DataFrame:
    """Every day from ``first`` to ``last``, with the span kept beside it."""
    return span.select("first", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def date_dim(span: DataFrame) -> DataFrame:
    """Ids are dense and count from the first day, so a rerun gives the same ones."""
    return days(span).select(
        F.date_diff("date", "first").cast("bigint").alias("date_id"),
        F.date_format("date", "yyyyMMdd").cast("bigint").alias("date_wid"),
        "date",
        F.lower(F.date_format("date", "EEEE")).alias("day_of_week"),
        constant(None, "string").alias("is_business_day"),
        constant(None, "string").alias("is_federal_holiday"),
        constant(None, "string").alias("holiday_description"),
    )


def month_dim(span: DataFrame) -> DataFrame:
    months = days(span).select(
        (_month_number(F.col("date")) - _month_number(F.col("first")) + 1).cast("bigint").alias("month_id"),
        F.lower(F.date_format("date", "MMMM")).alias("month_description"),
        F.last_day("date").alias("end_of_month_date"),
        F.date_format("date", "yyyyMM").alias("month_code"),
    )
    return months.distinct()


def business_calendar(span: DataFrame, holidays: DataFrame) -> DataFrame:
    """The date dimension with business-day flags, the next two business days and its month.

    ``holidays`` has ``date`` and ``holiday_description``; of a date listed more than once the
    least description counts.
    """
    marked = date_dim(span).drop("is_business_day", "is_federal_holiday", "holiday_description")
    holiday = holidays.groupBy("date").agg(F.min("holiday_description").alias("holiday_description"), F.lit(True).alias("_holiday"))
    flagged = marked.join(holiday, "date", "left").withColumns(
        {
            "is_federal_holiday": F.when(F.col("_holiday"), "Y").otherwise("N"),
            "is_business_day": F.when(F.dayofweek("date").isin(1, 7) | F.col("_holiday").isNotNull(), "N").otherwise("Y"),
        }
    )
    business, day = F.col("is_business_day") == "Y", F.col("date")
    following = flagged.withColumn("next_business_date", next_qualifying(day, business, day)).withColumn(
        "day_after_business_date", next_qualifying(F.col("next_business_date"), business, day)
    )
    with_month = lookup(following, month_dim(span), [(F.date_format("date", "yyyyMM"), "month_code")], {"month_id": "month_id"})
    return with_month.select(
        "date_id",
        "date_wid",
        "date",
        "day_of_week",
        "next_business_date",
        "day_after_business_date",
        "is_business_day",
        "is_federal_holiday",
        "holiday_description",
        "month_id",
    )


def split_holidays(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Holiday rows with their text dates parsed, and those whose date cannot be read, as they were."""
    readable = dirty_cast("date", "date").isNotNull()
    return rows.filter(readable).withColumn("date", dirty_cast("date", "date")), rows.filter(~readable)


def parse_holidays(rows: DataFrame) -> DataFrame:
    """Holiday rows with text dates; a date that cannot be read fails the job."""
    message = F.concat(F.lit("unreadable holiday "), F.coalesce(F.col("date"), F.lit("null")))
    return rows.withColumn("date", F.coalesce(dirty_cast("date", "date"), F.raise_error(message).cast("date")))
