import pytest

from lodestrata.operators.nested import find_table, relationalize
from tests.helpers import rows


def messages(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(
        '{"k":"a","m":{"h":{"x":1,"@t":"q"},"arr":[{"v":1,"in":["p","q"]},{"v":2,"in":null},{"v":3,"in":[]}],"6":"six"}}\n'
        '{"k":"b","m":{"h":{"x":2,"@t":"z"},"arr":[],"6":""}}\n'
        '{"k":"c","m":{"h":null,"arr":null}}\n'
    )
    return spark.read.json(str(path))


def test_relationalize(spark, tmp_path):
    tables = relationalize(messages(spark, tmp_path), keys=["k"])
    assert sorted(tables) == ["root", "root_m_arr", "root_m_arr_val_in"]
    assert tables["root"].columns == ["k", "m_6", "m_arr", "m_h_@t", "m_h_x"]
    assert rows(tables["root"].select("k", "m_arr", "m_h_x")) == [("a", "a", 1), ("b", "b", 2), ("c", None, None)]
    assert rows(tables["root_m_arr"].select("id", "index", "m_arr_val_v")) == [("a", 0, 1), ("a", 1, 2), ("a", 2, 3)]
    assert rows(tables["root_m_arr_val_in"]) == [("a.0", 0, "p"), ("a.0", 1, "q")]


def test_staged_without_keys(spark, tmp_path):
    tables = relationalize(messages(spark, tmp_path), staging_path=str(tmp_path / "stage"), underscores=False)
    root, child = tables["root"], tables["root_m.arr"]
    joined = root.join(child, root["`m.arr`"] == child["id"]).select("k", "`m.arr.val.v`")
    assert rows(joined) == [("a", 1), ("a", 2), ("a", 3)]


def test_composite_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a", "b|c", [1]), ("a|b", "c", [2])], "x string, y string, arr array<int>")
    tables = relationalize(df, keys=["x", "y"])
    assert tables["root"].select("arr").distinct().count() == 2


def test_arrays_of_arrays_and_carried_columns(spark):
    df = spark.createDataFrame([(1, "L1", [[1, 2], [3]])], "k int, load string, a array<array<int>>")
    tables = relationalize(df, keys=["k"], carry=["load"])
    assert rows(tables["root_a_val"]) == [("1.0", 0, "L1", 1), ("1.0", 1, "L1", 2), ("1.1", 0, "L1", 3)]


def test_needs_a_key_or_staging(spark):
    with pytest.raises(ValueError, match="staging"):
        relationalize(spark.createDataFrame([(1,)], "k int"))


def test_name_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, (2,), 3)], "k int, a struct<b: int>, a_b int")
    with pytest.raises(ValueError, match="more than once"):
        relationalize(df, keys=["k"])


def test_find_table_ignores_case(spark):
    df = spark.range(1)
    assert find_table({"Root_X": df}, "root_x") is df
    with pytest.raises(KeyError, match="Root_X"):
        find_table({"Root_X": df}, "nothing")
