"""Plans that must hold whatever the data size: shuffles, pruning and pushdown."""

import re

import pytest

import __spark_entry__ as entry
from lodestrata.operators.nested import relationalize
from tests.helpers import final_plan, plan, rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def shuffles(text):
    return text.count("Exchange hashpartitioning")


@pytest.mark.parametrize(
    "name, expected",
    [
        ("participant_header_nested", 1),
        ("attribute_pivot", 1),
        ("pivot_sum", 1),
        ("activity_header", 1),
        ("activity_detail", 1),
        ("latest_per_key_orders", 1),
        ("relationalize_grandchild", 0),
        ("json_props", 0),
        ("message_events", 0),
        ("incremental_window", 0),
        ("retype_by_position", 0),
        ("audit_stamp", 0),
        ("participant_history", 6),
        ("contributions_report", 1),
    ],
)
def test_shuffle_count(spark, name, expected):
    assert shuffles(plan(QUERIES[name](spark, SF_DIR))) == expected


@pytest.mark.parametrize("name", ["merge_replace", "merge_upsert", "scd2_load", "summary_report", "participant_history_nested", "dq_report"])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(QUERIES["pivot_sum"](spark, SF_DIR))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["l_suppkey:bigint,l_quantity:double,l_returnflag:string"]


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderstatus,O)" in plan(QUERIES["merge_upsert"](spark, SF_DIR))


def test_flattened_branches_read_only_themselves(spark, tmp_path):
    nested = spark.createDataFrame(
        [(1, [("x", [1])], [("y", "z")])], "k int, a array<struct<b: string, c: array<int>>>, d array<struct<e: string, f: string>>"
    )
    tables = relationalize(nested, keys=["k"], staging_path=str(tmp_path / "s"))
    assert "d:" not in re.findall(r"ReadSchema: (.*)", plan(tables["root_a_val_c"]))[0]
    assert "a:" not in re.findall(r"ReadSchema: (.*)", plan(tables["root_d"]))[0]


def test_join_of_many_rows_shares_its_left_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "ReusedExchange" in plan(QUERIES["left_join_many_orders"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_balances_shuffle_each_table_once(spark):
    """Both halves of the join of many rows share what they are made from."""
    text = final_plan(QUERIES["participant_balances"](spark, SF_DIR))
    assert shuffles(text) <= 14 and "ReusedExchange" in text


def test_gathered_people_equal_joined_people(spark):
    from pyspark.sql import functions as F

    from lodestrata.plans import participants as marts
    from lodestrata.workloads import messages

    flat = messages._flattened(messages._person_messages(spark, SF_DIR))
    tie = [flat.name(marts.PREFERENCES)]
    joined = marts.people_from_tables(flat, marts.latest_top(flat, tie))
    gathered = marts.latest_people_from_tables(flat, tie)
    assert rows(gathered.select(*joined.columns)) == rows(joined) and gathered.count() > 100
    assert gathered.select(F.max(F.size("origins"))).first()[0] == 2


@pytest.mark.parametrize("name", ["participant_balances", "participant_balances_nested", "summary_report"])
def test_rows_are_shuffled_between_their_join_and_their_aggregate(spark, name):
    """A task that joins by one key does not hold a group for nearly every row it makes."""
    lines = plan(QUERIES[name](spark, SF_DIR)).splitlines()
    first = next(i for i, line in enumerate(lines) if "HashAggregate(" in line)
    above = lines[first : next(i for i, line in enumerate(lines) if i > first and "Join " in line)]
    last = max(i for i, line in enumerate(above) if "HashAggregate(" in line)
    assert any("Exchange " in line for line in above[last:])


def test_summary_shuffles_its_balances_once(spark):
    assert shuffles(plan(QUERIES["summary_report"](spark, SF_DIR))) == 1


def test_distinct_rows_are_shuffled_once(spark):
    from lodestrata.operators.joins import distinct_rows

    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, None, None), (None, None, None), (None, None, None), (2, "a", "b")], "k int, a string, b string")
    got = distinct_rows(df)
    assert shuffles(plan(got)) == 1 and rows(got) == rows(df.distinct()) and len(rows(got)) == 4


def test_join_of_many_rows_takes_its_keys_without_the_joins_behind_the_values(spark):
    from lodestrata.operators.joins import left_join_many

    rows_of = spark.range(9).selectExpr("cast(id % 4 AS string) AS k", "id AS link").join(spark.range(5).selectExpr("id AS link", "id * 2 AS v"), "link", "left")
    left = spark.createDataFrame([("0",), ("1",), ("x",), (None,)], "k string")
    got = left_join_many(left, rows_of.select("k", "v"), ["k"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == 1
    assert rows(got) == rows(left.join(rows_of.select("k", "v"), "k", "left"))
