"""Merges by file, histories in one scan, and commits of two writers."""

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.columns import LOAD_COLUMN
from lodestrata.plans import loads
from lodestrata.sinks import versions
from tests.helpers import plan, rows

NOON = "2026-12-01 12:00:00"


def at():
    return F.lit(NOON).cast("timestamp")


def files(spark, base):
    return {r[0] for r in versions.file_list(spark, base, versions.newest(spark, base)).collect()}


def batch(spark, values):
    return spark.createDataFrame(values, "k int, v string, p string")


def many(spark):
    return spark.range(100).selectExpr("cast(id AS int) AS k", "concat('v', id) AS v", "concat('p', id % 3) AS p").repartitionByRange(10, "k")


@pytest.mark.parametrize("partition_keys", [[], ["p"]])
def test_a_merge_leaves_other_files_in_place(spark, tmp_path, partition_keys):
    base = str(tmp_path / "t")
    loads.load_merged(spark, many(spark), base, ["k"], "20260101_000000", at(), "me", "s", partition_keys)
    before = files(spark, base)
    loads.load_merged(spark, batch(spark, [(7, "new", "p2"), (None, "null", "p0")]), base, ["k"], "20260102_000000", at(), "you", "s", partition_keys)
    after = files(spark, base)
    assert len(before - after) == 1 and len(before & after) == len(before) - 1 > 0
    found = versions.current_version(spark, base)
    assert found.count() == 101 and rows(found.filter("k = 7 OR k IS NULL").select("v", "p")) == [("new", "p2"), ("null", "p0")]
    assert rows(found.select(LOAD_COLUMN, "audit_created_by", "audit_updated_tmstmp").distinct().select(LOAD_COLUMN, "audit_created_by")) == [("20260102_000000", "you")]
    assert found.select(F.max("audit_created_tmstmp") == at()).first()[0] and dict(found.dtypes)["audit_created_tmstmp"] == "timestamp"
    assert versions.newest(spark, base).rows == 101


def test_upserts_and_replacements_by_file(spark, tmp_path):
    for name, load, change in (("u", loads.load_upserted, None), ("d", loads.load_delete_insert, None)):
        base = str(tmp_path / name)
        load(spark, many(spark), base, ["k"], "1")
        before = files(spark, base)
        load(spark, batch(spark, [(99, "x", "p9"), (500, "y", None)]), base, ["k"], "2")
        assert len(before - files(spark, base)) == 1
        load(spark, batch(spark, [(501, "z", "p")]), base, ["k"], "3")  # touches no file
        found = versions.current_version(spark, base)
        assert found.count() == 102 and rows(found.filter("k >= 99")) == [(500, "y", None), (501, "z", "p"), (99, "x", "p9")]
        loads.load_compacted(spark, base, "4")
        assert rows(versions.current_version(spark, base)) == rows(found) and len(files(spark, base)) < len(before)
    with pytest.raises(Exception, match="several source rows"):
        loads.load_upserted(spark, batch(spark, [(1, "a", "b"), (1, "c", "d")]), str(tmp_path / "u"), ["k"], "5")


def test_the_plan_of_a_history_does_not_grow(spark, tmp_path):
    base = str(tmp_path / "h")
    as_of = F.to_date(F.lit("2026-12-01"))

    def staged(first, last):
        return spark.sql(f"SELECT id AS k, date'9999-09-09' AS record_end_date, 1L AS current_indicator FROM range({first}, {last})")

    loads.load_history(spark, staged(0, 20).repartitionByRange(4, "k"), base, ["k"], as_of, "01")
    sizes = []
    for i in range(2, 8):
        before = files(spark, base)
        loads.load_history(spark, staged(0, 2), base, ["k"], as_of, f"{i:02d}")
        closed = {f for f in before if "current_indicator=0" in f}
        assert closed <= files(spark, base)
        sizes.append(plan(loads.history_rows(spark, base)).count("FileScan"))
    assert sizes == [1] * 6
    assert rows(loads.history_rows(spark, base).groupBy("current_indicator").count()) == [(0, 12), (1, 20)]


def test_two_writers_from_one_version(spark, tmp_path):
    base = str(tmp_path / "w")
    loads.load_delete_insert(spark, batch(spark, [(1, "a", "p")]), base, ["k"], "1")
    base_entry = versions.newest(spark, base)
    mine = versions.stored_rows(spark, base, base_entry).drop("_file")
    loads.load_delete_insert(spark, batch(spark, [(2, "b", "p")]), base, ["k"], "2")  # another writer is faster
    with pytest.raises(versions.ConflictError):
        versions.write_changed(spark, mine, base, "3", base_entry, None)
    with pytest.raises(versions.ConflictError):
        versions.write_version(mine, base, "4", after=base_entry)
    assert rows(versions.current_version(spark, base).select("k", "v")) == [(1, "a"), (2, "b")]
    assert [r.count() for r in versions.all_versions(spark, base)] == [1, 2]
    loads.load_delete_insert(spark, batch(spark, [(3, "c", "p")]), base, ["k"], "3")  # begun anew, with the files of the lost try written over
    assert versions.current_version(spark, base).count() == 3


def test_a_name_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    versions.put_if_absent(spark, path, "a")
    with pytest.raises(versions.ConflictError):
        versions.put_if_absent(spark, path, "b")
    assert open(path).read() == "a" and [f.name for f in (tmp_path / "log").iterdir() if not f.name.endswith(".crc")] == ["1.json"]


def test_partitions_are_switched_at_once(spark, tmp_path, monkeypatch):
    """A run that fails between its statements leaves readers with the old version in all partitions."""
    base = str(tmp_path / "s")

    def load(values, stamp):
        return loads.load_merged_partitions(spark, batch(spark, values), "switched", base, ["k", "p"], "p", stamp, at(), "me", "s")

    load([(1, "a", "x"), (2, "b", "y")], "1")
    calls, plain = [], loads._quoted

    def failing(value):
        calls.append(value)
        if len(calls) > 2:
            raise RuntimeError("lost")
        return plain(value)

    monkeypatch.setattr(loads, "_quoted", failing)
    with pytest.raises(RuntimeError):
        load([(1, "A", "x"), (2, "B", "y")], "2")
    assert rows(spark.table("switched").select("k", "v")) == [(1, "a"), (2, "b")]
    monkeypatch.undo()
    load([(1, "A", "x"), (2, "B", "y")], "2")
    assert rows(spark.table("switched").select("k", "v")) == [(1, "A"), (2, "B")]
    monkeypatch.setattr(loads, "_point_view", lambda *_: None)  # lost after the commit, before the view is switched
    load([(1, "AA", "x")], "3")
    monkeypatch.undo()
    load([(9, "c", "x")], "4")
    assert rows(spark.table("switched").select("k", "v")) == [(1, "AA"), (2, "B"), (9, "c")]


def test_paths_with_odd_values(spark, tmp_path):
    base = str(tmp_path / "odd dir+x")
    values = [(1, "a", "x y/1:%+"), (2, "b", "O'B"), (3, "c", None), (4, "d", "[z]")]
    loads.load_delete_insert(spark, batch(spark, values), base, ["k"], "1", ["p"])
    loads.load_delete_insert(spark, batch(spark, [(2, "B", "O'B")]), base, ["k"], "2", ["p"])
    assert rows(versions.current_version(spark, base).select("k", "v", "p")) == [(1, "a", "x y/1:%+"), (2, "B", "O'B"), (3, "c", None), (4, "d", "[z]")]
    with pytest.raises(ValueError, match="column version"):
        loads.load_delete_insert(spark, spark.range(1).withColumn("version", F.lit(1)), str(tmp_path / "n"), ["id"], "1")


def test_paths_stay_out_of_the_join_of_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (None, "d")], "k long, _file string")
    found = versions.files_with_keys(rows, spark.createDataFrame([(2,), (3,), (9,), (None,)], "k long"), ["k"])
    assert [r.file for r in found.collect()] == ["b"]
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join LeftSemi, (k#", 1)[1]
    assert "xxhash64(_file#" in joined.split("\n")[1]  # a row carries eight bytes for its file, not the path
