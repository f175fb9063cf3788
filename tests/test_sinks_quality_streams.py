import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators import quality
from lodestrata.operators.batches import add_column_in_batches
from lodestrata.operators.columns import LOAD_COLUMN
from lodestrata.plans import loads
from lodestrata.sinks import writers
from lodestrata.streaming import streams
from tests.helpers import rows


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    writers.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"], table="dynamic_table")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]
    assert spark.table("dynamic_table").count() >= 1


def test_external_table_follows_its_files(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{path}/p=x")
    writers.register_external_table(spark, "external_files", path, "p")
    assert rows(spark.table("external_files")) == [(1, "x")]
    spark.createDataFrame([(2, "n")], "a int, b string").write.parquet(f"{path}/p=y")
    writers.register_external_table(spark, "external_files", path, "p")
    assert rows(spark.table("external_files")) == [(1, None, "x"), (2, "n", "y")]


def test_versions_replace_whole_tables(spark, tmp_path):
    base = str(tmp_path / "v")
    assert writers.current_version(spark, base) is None
    at = F.lit("2026-12-01").cast("timestamp")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    loads.load_merged(spark, first, base, ["k"], "20260101_000000", at, "me", "s", ["v"], view="versioned_view")
    loads.load_merged(spark, second, base, ["k"], "20260102_000000", at, "me", "s", ["v"], view="versioned_view")
    expected = [(1, "a", "20260102_000000"), (2, "x", "20260102_000000"), (3, "y", "20260102_000000")]
    assert rows(writers.current_version(spark, base).select("k", "v", LOAD_COLUMN)) == expected
    assert rows(spark.table("versioned_view").select("k", "v", LOAD_COLUMN)) == expected


def test_partition_merge_rewrites_only_what_it_touches(spark, tmp_path):
    base, at = str(tmp_path / "pm"), F.lit("2026-12-01").cast("timestamp")

    def load(values, stamp):
        batch = spark.createDataFrame(values, "k int, v string, p string")
        return loads.load_merged_partitions(spark, batch, "partition_merged", base, ["k", "p"], "p", stamp, at, "me", "s")

    load([(1, "a", "x"), (2, "b", "x"), (3, "c", "y: 1/2")], "20260101_000000")
    assert sorted(load([(2, "B", "x"), (4, "D", "z")], "20260102_000000")) == ["x", "z"]
    got = rows(spark.table("partition_merged").select("k", "v", "p", LOAD_COLUMN))
    assert got == [
        (1, "a", "x", "20260102_000000"),
        (2, "B", "x", "20260102_000000"),
        (3, "c", "y: 1/2", "20260101_000000"),
        (4, "D", "z", "20260102_000000"),
    ]
    load([(3, "C", "y: 1/2")], "20260103_000000")
    assert rows(spark.table("partition_merged").select("k", "v").filter("k = 3")) == [(3, "C")]
    assert sorted(os.listdir(tmp_path / "pm" / "version=20260102_000000"))[-2:] == ["p=x", "p=z"]
    with pytest.raises(ValueError, match="part of the key"):
        loads.load_merged_partitions(spark, spark.range(1), "t", base, ["id"], "p", "x", at, "me", "s")


def test_history_load_starts_empty(spark, tmp_path):
    base = str(tmp_path / "h")
    stage = spark.sql("SELECT 1 AS k, 'a' AS v, date'9999-09-09' AS record_end_date, 1L AS current_indicator")
    as_of = F.to_date(F.lit("2026-12-01"))
    assert loads.history_rows(spark, base) is None
    for stamp in ("20260101_000000", "20260102_000000", "20260103_000000"):
        spark.range(1).write.parquet(f"{base}/version={stamp}")  # what a lost run left
        loads.load_history(spark, stage, base, ["k"], as_of, stamp)
    assert rows(loads.history_rows(spark, base).select("current_indicator")) == [(0,), (0,), (1,)]
    assert spark.read.parquet(f"{base}/version=20260103_000000").count() == 2  # closed rows are written once
    with pytest.raises(ValueError, match="complete"):
        loads.load_history(spark, stage, base, ["k"], as_of, "20260103_000000")


def test_checkpoint_advances_only_after_the_write(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(f"2026010{i}_000000",) for i in range(1, 6)], f"{LOAD_COLUMN} string")
    assert loads.read_checkpoint(spark, path) == "20000101_000000"

    def fail(*_):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        loads.load_incremental(spark, df, path, "20260102_000000", fail)
    assert loads.read_checkpoint(spark, path) == "20000101_000000"
    seen = []
    for until in ("20260102_000000", "20260104_000000"):
        loads.load_incremental(spark, df, path, until, lambda part, after: seen.append((part.count(), after)))
    assert seen == [(2, "20000101_000000"), (2, "20260102_000000")] and loads.read_checkpoint(spark, path) == "20260104_000000"


def test_flattened_load_writes_every_table(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "k int, a array<int>")
    at = F.lit("2026-12-01").cast("timestamp")
    names = loads.load_flattened(df, str(tmp_path / "x"), "20260101_000000", at, "me", "s", keys=["k"], table="flat_table")
    assert names == ["root", "root_a"]
    assert rows(spark.table("flat_table_root_a").select("id", "index", "a_val")) == [("1", 0, 1), ("1", 1, 2)]


def test_raw_load_writes_without_a_sort(spark, tmp_path, monkeypatch):
    at, path, plans = F.lit("2026-12-01").cast("timestamp"), str(tmp_path / "raw"), []
    add = loads.add_audit
    monkeypatch.setattr(loads, "add_audit", lambda *a: plans.append(add(*a)) or plans[-1])
    for stamp, rows_in in (("20260101_000000", 5), ("a:b", 3), ("a:b", 2), ("a:b", 2)):
        assert loads.load_raw(spark.range(rows_in), path, stamp, at, "me", "s", table="raw_unsorted") == rows_in
    assert LOAD_COLUMN not in plans[0].columns  # so that no task sorts its rows by it
    got = [("20260101_000000", 5), ("a:b", 2)]
    assert rows(spark.table("raw_unsorted").groupBy(LOAD_COLUMN).count()) == got
    assert rows(spark.read.parquet(path).groupBy(LOAD_COLUMN).count()) == got


def test_raw_load_and_sql_text(spark, tmp_path):
    at = F.lit("2026-12-01").cast("timestamp")
    (tmp_path / "in.csv").write_text("1\n2\n3\n")
    batch = spark.read.csv(str(tmp_path / "in.csv"))
    assert loads.load_raw(batch, str(tmp_path / "raw"), "20260101_000000", at, "me", "s", files=batch.inputFiles(), archive=str(tmp_path / "done")) == 3
    assert (tmp_path / "done" / "in.csv").exists() and not (tmp_path / "in.csv").exists()
    writers.archive_files(spark, [f"file://{tmp_path}/in.csv"], str(tmp_path / "done"))
    assert os.path.isdir(tmp_path / "raw" / f"{LOAD_COLUMN}=20260101_000000")
    (tmp_path / "q.sql").write_text("SELECT count(*) AS n\nFROM {t} WHERE id > :floor")
    text = loads.read_sql_text(spark, str(tmp_path / "q.sql"))
    assert loads.transform_sql(spark, text, {"t": spark.range(10)}, floor=6).first().n == 3


def test_manifest_has_one_row_per_file(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(100, numPartitions=3).withColumn("v", F.lit("x")).write.parquet(path)
    manifest = writers.manifest(spark, path, F.lit("now"), "spec", "run")
    got = manifest.collect()
    assert len(got) == 3 and sum(r.NumberOfRows for r in got) == 100
    assert {r.NumberOfColumns for r in got} == {2} and all(len(r.MD5HashKey) == 32 for r in got)
    writers.write_manifest(manifest, str(tmp_path / "trg"), str(tmp_path / "index"))
    assert spark.read.text(str(tmp_path / "index")).count() == 3
    assert {f.name for f in (tmp_path / "trg").iterdir()} == {r.DataFileName + ".trg.json" for r in got}


def test_manifest_names_differ_between_partitions(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string").coalesce(1).write.partitionBy("p").parquet(path)
    got = writers.manifest(spark, path, F.lit("now"), "spec", "run").collect()
    assert len({r.TriggerFileName for r in got}) == 3 and {r.DataFileName.split("/")[0] for r in got} == {"p=a", "p=b", "p=c"}


def test_versions_keep_types(spark, tmp_path):
    base, at = str(tmp_path / "typed"), F.lit("2026-12-01").cast("timestamp")
    for stamp, code in (("1", "007"), ("2", "008"), ("3", "0100")):
        batch = spark.createDataFrame([(int(stamp), code)], "k int, code string")
        loads.load_merged(spark, batch, base, ["k"], stamp, at, "me", "s", ["code"])
    assert rows(writers.current_version(spark, base).select("k", "code")) == [(1, "007"), (2, "008"), (3, "0100")]


def test_incremental_retry_adds_nothing_twice(spark, tmp_path):
    df = spark.createDataFrame([(i, f"2026010{i}_000000") for i in range(1, 6)], f"id int, {LOAD_COLUMN} string")
    write = loads.write_range(str(tmp_path / "data"))
    write(df.limit(2), loads.read_checkpoint(spark, str(tmp_path / "c")))  # a run lost before its checkpoint
    for until in ("20260103_000000", "20260105_000000"):
        loads.load_incremental(spark, df, str(tmp_path / "c"), until, write)
    assert rows(spark.read.parquet(str(tmp_path / "data")).select("id")) == [(1,), (2,), (3,), (4,), (5,)]


def test_partition_merge_completes_after_a_lost_run(spark, tmp_path, monkeypatch):
    base, at = str(tmp_path / "lost"), F.lit("2026-12-01").cast("timestamp")

    def load(values, stamp):
        batch = spark.createDataFrame(values, "k int, p string")
        return loads.load_merged_partitions(spark, batch, "lost_run", base, ["k", "p"], "p", stamp, at, "me", "s")

    load([(1, "O'B"), (2, "b\\c")], "1")
    monkeypatch.setattr(loads, "_quoted", lambda value: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load([(3, "O'B"), (4, "d")], "2")
    monkeypatch.undo()
    load([(3, "O'B"), (4, "d")], "2")
    assert rows(spark.table("lost_run").select("k", "p")) == [(1, "O'B"), (2, "b\\c"), (3, "O'B"), (4, "d")]
    with pytest.raises(ValueError, match="complete"):
        load([(5, "d")], "2")


def test_file_sizing(spark, tmp_path):
    df = spark.range(20_000, numPartitions=2).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    limit = writers.records_per_file(df, str(tmp_path / "s"), target_bytes=100_000, fraction=0.1)
    writers.write_sized(df, str(tmp_path / "o"), limit)
    sizes = [f.stat().st_size for f in (tmp_path / "o").glob("*.parquet")]
    assert max(sizes) < 200_000 and len(sizes) > 5
    many = writers.records_per_file(df.repartition(200), str(tmp_path / "m"), target_bytes=100_000, fraction=0.1)
    assert abs(many - limit) < 0.1 * limit
    assert writers.records_per_file(spark.range(0), str(tmp_path / "e"), 1000) == 0
    assert writers.records_per_file(df, str(tmp_path / "n"), 100_000, fraction=0.0) > 100


def test_quoted_csv_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([(' a "b"\n', ""), ("c,d ", "\\")], "x string, y string")
    writers.write_quoted_csv(df, str(tmp_path / "q"))
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "q"))
    assert rows(back.na.fill("")) == rows(df)


def test_processed_files_table(spark, tmp_path):
    path = str(tmp_path / "p")
    for done in (("a.csv", 3), ("b.csv", 4)):
        writers.record_processed(spark.createDataFrame([done], writers.PROCESSED_SCHEMA), path)
    assert rows(spark.read.schema(writers.PROCESSED_SCHEMA).json(path)) == [("a.csv", 3), ("b.csv", 4)]


def test_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, "long enough"), (1, "short"), (2, None)], "id int, codename string")
    rules = [
        {"name": "rows", "type": "row_count", "dataset": "d"},
        {"name": "short", "type": "failed_rows", "dataset": "d", "bad": "length(codename) < 10"},
        {"name": "unique", "type": "duplicate_count", "dataset": "d", "keys": ["id"]},
        {"name": "empty", "type": "row_count", "dataset": "e"},
        {"name": "same", "type": "same_row_count", "datasets": ["d", "e"]},
    ]
    result = quality.run_checks({"d": df, "e": df.limit(0)}, rules)
    got = {r.rule: (r.value, r.passed) for r in result.collect()}
    assert got == {"rows": (3, True), "short": (1, False), "unique": (1, False), "empty": (0, False), "same": (3, False)}
    assert rows(quality.failed_rows(df, "length(codename) < 10")) == [(1, "short")]
    quality.store_results(result, str(tmp_path / "r"), "20260101_000000")
    assert spark.read.parquet(str(tmp_path / "r")).count() == 5
    with pytest.raises(ValueError, match="invalid rule type"):
        quality.run_checks({"d": df}, [{"name": "x", "type": "magic", "dataset": "d"}])


def test_reconciliation_gates_promotion(spark, tmp_path):
    loaded = spark.createDataFrame([("r1", 5), ("r1", 6), ("r0", 9)], "run string, amount int")
    columns = "filename string, tmstmp string, record_count string, record_checksum string"
    right = spark.createDataFrame([("a", "t", "1", "5"), ("b", "t", "1", "6")], columns)
    wrong = spark.createDataFrame([("a", "t", "2", "12")], columns)
    main = str(tmp_path / "main")
    good = quality.reconcile(right, loaded, "run", "r1", "amount")
    bad = quality.reconcile(wrong, loaded, "run", "r1", "amount")
    assert good.first().reconciled and not bad.first().reconciled
    assert quality.reconcile(wrong, loaded, "run", "r1").first().reconciled
    assert not quality.promote(loaded, bad, main, "r1") and not os.path.exists(main)
    for _ in range(2):
        assert quality.promote(loaded, good, main, "r1") and spark.read.parquet(main).count() == 3
    unreadable = spark.createDataFrame([("a", "t", "2", "11"), ("b", "t", "oops", None)], columns)
    assert not quality.reconcile(unreadable, loaded, "run", "r1", "amount").first().reconciled


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"id":1,"value":"x"}\n{"id":9,"value":"y"}\nnot json\n')
    dimension = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")

    def run(checkpoint="cp"):
        stream = streams.json_stream(spark, str(tmp_path / "in"), "id int, value string")
        enriched = lambda records: streams.enrich(records, dimension, ["id"])
        streams.append_readable(stream, enriched, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / checkpoint)).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("id", "value", "name"))

    assert run() == [(1, "x", "A")]
    assert run() == [(1, "x", "A")]
    assert rows(spark.read.text(str(tmp_path / "bad")).select("value")) == [("not json",)]
    (tmp_path / "in" / "b.txt").write_text('{"id":2,"value":"z"}\n')
    assert run() == [(1, "x", "A"), (2, "z", "B")]
    assert run("other") == [(1, "x", "A"), (1, "x", "A"), (2, "z", "B"), (2, "z", "B")]


def test_file_ingest_quarantines_whole_files_and_archives(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = T.StructType.fromDDL("id int, v string")
    paths = [str(tmp_path / n) for n in ("landing", "loaded", "bad", "cp")]

    def run():
        streams.ingest_files(spark, *paths, schema, archive=str(tmp_path / "archive")).awaitTermination()

    (landing / "good.csv").write_text("id,v\n1,a\n2,b\n")
    (landing / "bad.csv").write_text("id,v\n3,c\nfour,d\n")
    run()
    assert rows(spark.read.parquet(paths[1]).select("id", "v")) == [(1, "a"), (2, "b")]
    bad = spark.read.json(paths[2])
    assert bad.count() == 2 and bad.filter("raw_record = 'four,d'").count() == 1
    run()
    assert spark.read.parquet(paths[1]).count() == 2
    (landing / "next.csv").write_text("id,v\n5,e\n")
    run()
    assert spark.read.parquet(paths[1]).count() == 3
    assert list((tmp_path / "archive").rglob("good.csv"))
    other = tmp_path / "second"
    other.mkdir()
    (other / "more.csv").write_text("id,v\n6,f\n")
    streams.ingest_files(spark, str(other), *paths[1:3], str(tmp_path / "cp2"), schema).awaitTermination()
    assert spark.read.parquet(paths[1]).count() == 4
    with pytest.raises(ValueError, match="max_files"):
        streams.ingest_files(spark, str(other), *paths[1:], schema, max_files=10**6)


def test_split_malformed(spark, tmp_path):
    from lodestrata.sources import readers

    (tmp_path / "a.csv").write_text("1,2020-01-01\nx,2020-01-02\n3,never\n")
    parsed = readers.read_with_corrupt(spark, str(tmp_path / "a.csv"), "id int, d date", header=False)
    good, bad = writers.split_malformed(parsed, readers.CORRUPT, str(tmp_path / "split"))
    assert rows(good.select("id")) == [(1,)]
    assert rows(bad.select(readers.CORRUPT)) == [("3,never",), ("x,2020-01-02",)]


def test_column_in_batches(spark):
    got = add_column_in_batches(spark.range(3), "twice", T.LongType(), lambda batch: batch["id"] * 2)
    assert rows(got) == [(0, 0), (1, 2), (2, 4)]


def test_batch_functions_get_slices_of_long_texts(spark):
    texts = spark.range(40, numPartitions=1).select("id", F.repeat(F.lit("x"), 1 << 20).alias("text"), F.when(F.col("id") > 3, F.col("id")).alias("gap"))
    got = add_column_in_batches(texts, "mb", T.LongType(), lambda b: (b["text"].str.len().sum() >> 20) + 0 * b["text"].str.len(), needs=["text"])
    seen = got.select("id", "gap", "mb").collect()
    assert [r.id for r in seen] == list(range(40)) and [r.gap for r in seen] == [None] * 4 + list(range(4, 40))
    assert max(r.mb for r in seen) <= 4  # MB of text a call has in Python
