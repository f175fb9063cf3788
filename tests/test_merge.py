import pytest
from pyspark.sql import functions as F

from lodestrata.operators import merge
from lodestrata.operators.columns import AUDIT_COLUMNS, LOAD_COLUMN, add_audit, stamp_load
from lodestrata.operators.joins import left_join_many, lookup
from lodestrata.sinks.writers import overwrite_bucketed
from tests.helpers import final_plan, plan, rows


def frame(spark, values, ddl="k int, v string"):
    return spark.createDataFrame(values, ddl)


def test_delete_insert_keeps_stage_duplicates_and_null_keys(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (None, "n")])
    stage = frame(spark, [(2, "x"), (2, "x"), (None, "m"), (5, "y")])
    got = rows(merge.delete_insert(target, stage, ["k"]))
    assert got == [(None, "m"), (None, "n"), (1, "a"), (2, "x"), (2, "x"), (5, "y")]


def test_delete_insert_twice_changes_nothing(spark):
    target, stage = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "x"), (3, "y")])
    once = merge.delete_insert(target, stage, ["k"])
    assert rows(merge.delete_insert(once, stage, ["k"])) == rows(once)


def test_merge_replace_without_target_and_with_old_stamps(spark):
    at = F.lit("2026-12-01").cast("timestamp")
    source = add_audit(stamp_load(frame(spark, [(1, "a")]), "20200101_000000"), at, "old", "old")
    got = merge.merge_replace(None, source, ["k"], "20261201_000000", at, "me", "src")
    assert got.columns == ["k", "v", LOAD_COLUMN, *AUDIT_COLUMNS]
    assert got.first()[LOAD_COLUMN] == "20261201_000000" and got.first()["audit_created_by"] == "me"
    again = merge.merge_replace(got, frame(spark, [(1, "b"), (2, "c")]), ["k"], "20261202_000000", at, "me", "src")
    assert rows(again.select("k", "v", LOAD_COLUMN)) == [(1, "b", "20261202_000000"), (2, "c", "20261202_000000")]


def test_upsert_keeps_target_only_columns_and_adds_null_keys(spark):
    target = frame(spark, [(1, "a", 10), (2, "b", 20), (2, "b2", 21)], "k int, v string, extra int")
    source = frame(spark, [(2, None), (3, "c"), (None, "n"), (None, "n")])
    got = rows(merge.merge_upsert(target, source, ["k"]))
    assert got == [(None, "n", None), (None, "n", None), (1, "a", 10), (2, None, 20), (2, None, 21), (3, "c", None)]


def test_upsert_twice_changes_nothing(spark):
    target, source = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "x"), (3, "y")])
    once = merge.merge_upsert(target, source, ["k"])
    assert rows(merge.merge_upsert(once, source, ["k"])) == rows(once)


def test_upsert_refuses_repeated_keys(spark):
    target, source = frame(spark, [(1, "a")]), frame(spark, [(9, "x"), (9, "y")])
    with pytest.raises(Exception, match="several source rows"):
        merge.merge_upsert(target, source, ["k"]).collect()


def test_upsert_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="no columns"):
        merge.merge_upsert(frame(spark, [(1, "a")]), frame(spark, [(1, 2)], "k int, w int"), ["k"])


def history(spark, values):
    return spark.createDataFrame(values, "k int, v string, record_end_date string, current_indicator bigint").withColumn(
        "record_end_date", F.to_date("record_end_date")
    )


def test_scd2_leaves_one_current_row_per_key(spark):
    target = history(spark, [(1, "a", "9999-09-09", 1), (1, "z", "2020-01-01", 0), (2, "b", "9999-09-09", 1)])
    stage = history(spark, [(1, "c", "9999-09-09", 1), (3, "d", "9999-09-09", 1)])
    loaded = merge.scd2_load(target, stage, ["k"], F.to_date(F.lit("2026-12-01")))
    got = [(r.k, r.v, str(r.record_end_date), r.current_indicator) for r in loaded.orderBy("k", "v").collect()]
    assert got == [
        (1, "a", "2026-12-01", 0),
        (1, "c", "9999-09-09", 1),
        (1, "z", "2020-01-01", 0),
        (2, "b", "9999-09-09", 1),
        (3, "d", "9999-09-09", 1),
    ]
    current = merge.current_rows(loaded).groupBy("k").count()
    assert current.filter("count > 1").isEmpty()


def test_scd2_keeps_rows_without_an_indicator(spark):
    target = history(spark, [(1, "n", None, None), (1, "z", "2020-01-01", 0)])
    stage = history(spark, [(1, "c", "9999-09-09", 1)])
    loaded = merge.scd2_load(target, stage, ["k"], F.to_date(F.lit("2026-12-01")))
    assert rows(loaded.select("v", "current_indicator")) == [("c", 1), ("n", None), ("z", 0)]


def test_scd2_refuses_repeated_stage_keys(spark):
    target, stage = history(spark, [(1, "n", "9999-09-09", 1)]), history(spark, [(2, "a", "9999-09-09", 1), (2, "b", "9999-09-09", 1)])
    with pytest.raises(Exception, match="several source rows"):
        merge.scd2_load(target, stage, ["k"], F.to_date(F.lit("2026-12-01"))).collect()


def test_scd2_close_all_moves_earlier_end_dates(spark):
    target = history(spark, [(1, "z", "2020-01-01", 0)])
    stage = history(spark, [(1, "c", "9999-09-09", 1)])
    loaded = merge.scd2_load(target, stage, ["k"], F.to_date(F.lit("2026-12-01")), close_all=True)
    assert [str(r.record_end_date) for r in loaded.orderBy("v").collect()] == ["9999-09-09", "2026-12-01"]


def test_full_reload_projects_to_the_target(spark):
    target = frame(spark, [(1, "a", 2.0)], "k int, v string, w double")
    got = merge.full_reload(target, frame(spark, [("7", "q", "x")], "K string, v string, other string"))
    assert got.schema == target.schema and rows(got) == [(7, "q", None)]


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    overwrite_bucketed(spark.range(2000).withColumn("v", F.lit("a")), str(tmp_path / "t"), "bucketed_target", ["id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stage = spark.range(1000, 3000).withColumn("v", F.lit("b"))
        text = plan(merge.delete_matching(spark.table("bucketed_target"), stage, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and text.count("Exchange hashpartitioning") == 1


def test_left_join_many_equals_left_join(spark):
    left = frame(spark, [(1, "a"), (2, "b"), (None, "n"), (2, "b2")])
    right = spark.createDataFrame([(2, 5), (2, 6), (3, 7), (None, 8)], "k int, w int")
    assert rows(left_join_many(left, right, ["k"])) == rows(left.join(right, "k", "left"))


def test_lookup_compares_as_text(spark):
    table = spark.createDataFrame([("1", "one"), ("3", "three")], "code string, name string")
    got = lookup(frame(spark, [(1, "a"), (2, "b"), (None, "c")]), table, [(F.col("k"), "code")], {"name": "label"})
    assert rows(got) == [(None, "c", None), (1, "a", "one"), (2, "b", None)]


@pytest.fixture
def small_limits(spark):
    """Thresholds at which test data counts as skewed, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("hot", [7, None])
def test_a_key_with_a_third_of_the_rows_is_split(spark, small_limits, hot):
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("bigint")
    target = spark.range(200_000).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(16)
    stage = spark.range(100_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    hot_rows, staged, absent = 66_667, 66_666, 33_334
    deleted = merge.delete_matching(target, stage, ["k"])
    assert "skew=true" in final_plan(deleted)
    assert deleted.count() == 200_000 - staged - (0 if hot is None else hot_rows)
    upserted = merge.merge_upsert(target, stage, ["k"])
    assert "skew=true" in final_plan(upserted)
    assert upserted.count() == 200_000 + absent
    if hot is not None:
        many = left_join_many(stage, target.withColumnRenamed("v", "w"), ["k"])
        assert "skew=true" in final_plan(many)
        assert many.count() == staged + hot_rows + absent
