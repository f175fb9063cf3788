"""Digests by pieces, footers, archives, the schema log and promotion."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lodestrata import storage
from lodestrata.operators import merge, quality
from lodestrata.sinks import writers
from lodestrata.sources import readers
from tests.helpers import plan, rows


def test_digests_by_pieces(spark, tmp_path):
    spark.range(5000).withColumn("v", F.expr("uuid()")).repartition(3).write.parquet(str(tmp_path / "d"))
    files = readers.listed_files(spark, str(tmp_path / "d"), "*.parquet")
    found = storage.file_digests(files, piece=1000).collect()  # every file is many pieces
    assert sum(r["rows"] for r in found) == 5000 and len(found) == 3
    for r in found:
        data = open(storage.filesystem(r["path"])[1], "rb").read()
        assert len(data) == r["size"] > 20_000 and hashlib.md5(data).hexdigest() == r["md5"]
    assert storage.file_digests(files).rdd.getNumPartitions() == 3


def test_file_systems(tmp_path):
    assert storage.filesystem(f"file:{tmp_path}/a b")[1] == storage.filesystem(f"file://{tmp_path}/a b")[1] == f"{tmp_path}/a b"
    system, path = storage.filesystem("s3a://bucket/a/b?region=us-east-1")
    assert type(system).__name__ == "S3FileSystem" and path == "bucket/a/b"


def test_sizing_from_footers_agrees_with_a_sample(spark, tmp_path):
    df = spark.range(40_000).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    df.repartition(4).write.parquet(str(tmp_path / "d"))
    sampled = writers.records_per_file(df, str(tmp_path / "s"), 100_000, fraction=0.5)
    assert abs(writers.records_per_file_from(spark, str(tmp_path / "d"), 100_000) / sampled - 1) < 0.1
    spark.range(0).write.parquet(str(tmp_path / "e"))
    assert writers.records_per_file_from(spark, str(tmp_path / "e"), 100_000) == 0


def test_archives_keep_paths(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "x.csv").write_text(folder)
    files = [f"{tmp_path}/in/a/x.csv", f"file:{tmp_path}/in/b/x.csv"]
    with pytest.raises(ValueError, match="one name"):
        writers.archive_files(spark, files, str(tmp_path / "done"))
    assert (tmp_path / "in" / "a" / "x.csv").exists()
    writers.archive_files(spark, files, str(tmp_path / "done"), str(tmp_path / "in"))
    assert [(tmp_path / "done" / f / "x.csv").read_text() for f in "ab"] == ["a", "b"]


def test_only_new_files_are_opened(spark, tmp_path, monkeypatch):
    path, opened, plain = str(tmp_path / "t"), [], writers.read_parquet_merged
    monkeypatch.setattr(writers, "read_parquet_merged", lambda s, p: opened.append(list(p)) or plain(s, p))
    for i in range(3):
        spark.createDataFrame([(i, "x")], "a int, b string" if i else "a int, c string").coalesce(1).write.parquet(f"{path}/p={i}")
        writers.register_external_table(spark, "logged_files", path, "p")
    writers.register_external_table(spark, "logged_files", path, "p")
    assert [len(o) for o in opened] == [1, 1, 1]
    assert rows(spark.table("logged_files").select("a", "b", "c", "p")) == [(0, None, "x", "0"), (1, "x", None, "1"), (2, "x", None, "2")]
    spark.createDataFrame([("s",)], "a string").write.parquet(f"{path}/p=9")
    with pytest.raises(ValueError, match="column a has types"):
        writers.register_external_table(spark, "logged_files", path, "p")


def test_a_promotion_is_there_once_and_whole(spark, tmp_path):
    main, verdict = str(tmp_path / "main"), spark.sql("SELECT true AS reconciled")
    assert quality.promote(spark.range(3), verdict, main, "r1") and quality.promote(spark.range(100), verdict, main, "r1")
    assert quality.promote(spark.range(4), verdict, main, "r2")
    assert rows(spark.read.parquet(main).groupBy("run").count()) == [("r1", 3), ("r2", 4)]
    assert "run=r1" in os.listdir(main)


def test_results_beside_the_run_before(spark, tmp_path):
    result = spark.createDataFrame([("a", "d", "row_count", 3, True)], "rule string, dataset string, metric string, value long, passed boolean")
    for stamp, value in (("1", 3), ("2", 5)):
        quality.store_results(result.withColumn("value", F.lit(value).cast("long")), str(tmp_path / "m"), stamp)
    found = quality.with_previous(spark.read.parquet(str(tmp_path / "m")))
    assert rows(found.select("value", "previous")) == [(3, None), (5, 3)]


def test_an_upsert_sorts_nothing_to_aggregate(spark):
    frames = [spark.createDataFrame([(1, "a")], "k int, v string") for _ in range(2)]
    assert "SortAggregate" not in plan(merge.merge_upsert(*frames, ["k"]))
