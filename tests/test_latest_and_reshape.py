import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import scalar
from lodestrata.operators import columns, reshape
from lodestrata.operators.latest import latest_per_key, latest_value_rows
from lodestrata.plans import calendar
from tests.helpers import plan, rows


def test_latest_breaks_ties_and_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 9), ("a", "t1", 1), ("a", "t1", 2), ("b", None, 1), (None, "t", 3)], "k string, t string, i int")
    got = rows(latest_per_key(df, ["k"], F.col("t"), [F.col("i")]))
    assert got == [(None, "t", 3), ("a", "t1", 2), ("b", None, 1)]


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(latest_per_key(df, ["k"], F.col("id"), [F.col("id")]))
    assert "Partial" in text and text.index("Exchange") < text.index("Partial")


def test_latest_value_rows(spark):
    df = spark.createDataFrame([("20260101_000000", 1), ("20260102_000000", 2), ("20260102_000000", 3)], "p string, i int")
    assert rows(latest_value_rows(df, "p").select("i")) == [(2,), (3,)]


def test_attribute_pivot_takes_the_greatest_value(spark):
    df = spark.createDataFrame([(1, "x", "a"), (1, "x", "b"), (1, "y", "c"), (2, "z", "d")], "k int, n string, v string")
    assert rows(reshape.attributes_to_columns(df, ["k"], "n", "v", {"xy": ["x", "y"], "x": ["x"]})) == [(1, "c", "b"), (2, None, None)]


def test_pivot_has_all_listed_columns(spark):
    df = spark.createDataFrame([(1, "A", 2), (1, "Q", 9), (2, "Q", 1)], "k int, g string, v int")
    assert rows(reshape.pivot_sum(df, ["k"], "g", {"A": "a", "B": "b"}, "v")) == [(1, 2, None), (2, None, None)]


def test_stack_and_unpivot_keep_nulls(spark):
    df = spark.createDataFrame([(1, "p", None)], "k int, a string, b string")
    assert rows(reshape.stack_pairs(df, ["k"], [("A", "a"), ("B", "b")], "n", "v")) == [(1, "A", "p"), (1, "B", None)]
    assert rows(reshape.unpivot_with_nulls(df, ["k"], ["a", "b"], "n", "v")) == [(1, "a", "p"), (1, "b", None)]


def test_conditional_sums_ignore_case(spark):
    df = spark.createDataFrame([("Employee", 1), ("MATCH", 2), (None, 5)], "g string, v int")
    sums = df.agg(*reshape.conditional_sums(F.col("g"), F.col("v"), {"e": "EMPLOYEE", "a": "AUTOMATIC", "m": "MATCH"}))
    assert [v if v is None else int(v) for v in sums.first()] == [1, None, 2]
    assert sums.select(reshape.null_safe_total(F.col("e"), F.col("a"), F.col("m"))).first()[0] == 3


def test_scalar_functions(spark):
    one = spark.range(1)
    as_of = F.to_date(F.lit("2026-12-01"))
    got = one.select(
        scalar.age_in_years(F.to_date(F.lit("1981-01-01")), as_of),
        scalar.hash_key(F.lit("a"), F.lit(None).cast("string")),
        scalar.blank_to_null(F.lit("")),
        scalar.null_spellings(F.lit("NoNe")),
        scalar.dirty_cast(F.lit("abc"), "int"),
        scalar.dirty_cast(F.lit(""), "date"),
        scalar.strip_line_breaks(F.lit("a\nb")),
        scalar.join_broken_fields(F.lit("a\n,b,\nc\nd")),
        scalar.array_difference(F.array(F.lit(5), F.lit(6), F.lit(7)), F.array(F.lit(1), F.lit(2))),
        scalar.parse_offset_timestamp(F.lit("2026-01-01T00:00:00.500-06:00")),
        scalar.parse_offset_timestamp(F.lit("2026-01-01T00:00:00.500-06:00"), "America/Chicago"),
        scalar.parse_offset_timestamp(F.lit("garbage")),
    ).first()
    assert tuple(got)[:9] == (46, None, None, None, None, None, "ab", "a,b,c\nd", [4, 4])
    assert got[9].astimezone(dt.timezone.utc).replace(tzinfo=None) == dt.datetime(2026, 1, 1, 6, 0, 0, 500000)
    assert (got[10] - got[9]) == dt.timedelta(hours=6) and got[11] is None


def test_delimited_and_xml_records(spark):
    schema = spark.createDataFrame([], "id int, name string, sal double, dt date").schema
    raw = spark.createDataFrame([(b"1,a,,2020-01-02\n",), (b"2,,x,\r\n",), (b"3",)], "r binary")
    got = rows(raw.select(scalar.delimited_record("r", schema, charset="UTF-8").alias("s")).select("s.*"))
    assert got == [(1, "a", None, dt.date(2020, 1, 2)), (2, None, None, None), (3, None, None, None)]
    xml = spark.createDataFrame([("<a><c1>hello</c1><c2>hi</c2><c3/></a>",)], "x string")
    assert rows(xml.select(scalar.xml_record("x", ["c1", "c2", "c3"]).alias("s")).select("s.*")) == [("hello", "hi", None)]


def test_column_operators(spark):
    df = spark.createDataFrame([("1", "b", "c")], "`a.host` string, Host string, std_x string")
    kept = columns.drop_prefixed(df)
    assert kept.columns == ["a.host", "Host"]
    assert columns.rename_by_substring(columns.dots_to_underscores(kept), {"host": "host_ip", "Host": "host_url"}).columns == ["a_host_ip", "host_url"]
    typed = columns.retype_by_position(kept, "n:int, text varchar(20)")
    assert typed.dtypes == [("n", "int"), ("text", "string")]


def test_calendar(spark):
    span = spark.sql("SELECT date'2025-12-24' AS first, date'2026-01-06' AS last")
    listed = [("2025-12-25", "Christmas"), ("2026-01-01", "New Year"), ("2026-01-01", "Year"), ("soon", "x")]
    holidays, unreadable = calendar.split_holidays(spark.createDataFrame(listed, "date string, holiday_description string"))
    assert rows(unreadable) == [("soon", "x")]
    with pytest.raises(Exception, match="unreadable holiday soon"):
        calendar.parse_holidays(spark.createDataFrame(listed, "date string, holiday_description string")).collect()
    assert calendar.business_calendar(span, holidays).count() == 14
    by_day = {str(r.date): r for r in calendar.business_calendar(span, holidays).collect()}
    eve = by_day["2025-12-24"]
    assert (str(eve.next_business_date), str(eve.day_after_business_date)) == ("2025-12-26", "2025-12-29")
    assert by_day["2025-12-25"].is_federal_holiday == "Y" and by_day["2025-12-27"].is_business_day == "N"
    assert by_day["2026-01-06"].next_business_date is None and by_day["2026-01-01"].month_id == 2
    assert [r.date_id for r in sorted(by_day.values(), key=lambda r: r.date)] == list(range(14))


def test_default_span(spark):
    span = calendar.default_span(spark, F.to_date(F.lit("2026-12-01")))
    assert calendar.date_dim(span).count() == 11_688 and calendar.month_dim(span).count() == 384
