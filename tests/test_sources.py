import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.session import scratch_path, shared_folder, use_folder
from lodestrata.sources import readers, schemas
from tests.helpers import plan, rows


def test_ddl_lists():
    schema_text = "a varchar(10), b decimal(10,2), c decimal, d numeric(12,6), e text, f bytea, g bigint, h:date"
    assert schemas.name_type_pairs(schema_text) == [
        ("a", "string"),
        ("b", "decimal(10,2)"),
        ("c", "decimal(38,10)"),
        ("d", "decimal(12,6)"),
        ("e", "string"),
        ("f", "binary"),
        ("g", "bigint"),
        ("h", "date"),
    ]


def test_schema_from_ddl(spark):
    assert schemas.schema_from_ddl("a varchar(3), b decimal(10,2)").simpleString() == "struct<a:string,b:decimal(10,2)>"


def test_schema_from_avsc():
    inner = {"type": "record", "name": "Phone", "fields": [{"name": "no", "type": ["null", "string"]}]}
    doc = {
        "type": "record",
        "name": "Top",
        "fields": [
            {"name": "@timestamp", "type": {"type": "string", "logicalType": "timestamp-millis"}},
            {"name": "phones", "type": {"type": "array", "items": inner}},
            {"name": "home", "type": ["null", "Phone"]},
            {"name": "pay", "type": "double"},
            {"name": "born", "type": {"type": "int", "logicalType": "date"}},
            {"name": "seen", "type": {"type": "long", "logicalType": "timestamp-micros"}},
            {"name": "due", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        ],
    }
    got = schemas.schema_from_avsc(json.dumps(doc)).simpleString()
    assert got == (
        "struct<@timestamp:string,phones:array<struct<no:string>>,home:struct<no:string>,pay:double,born:date,seen:timestamp,due:decimal(9,2)>"
    )
    with pytest.raises(ValueError, match="union"):
        schemas.schema_from_avsc({"type": "record", "name": "x", "fields": [{"name": "u", "type": ["int", "string"]}]})


def test_skip_first_line_of_every_file_and_split(spark, tmp_path):
    for n in range(3):
        body = "".join(f"{n}-{i};v{i}\n" for i in range(500))
        (tmp_path / f"f{n}.csv").write_text(f"junk line {n}\nid;value\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = readers.read_after_first_line(spark, str(tmp_path), sep=";")
        assert got.columns == ["id", "value"] and got.count() == 1500
        assert got.filter(~F.col("id").rlike("^[0-2]-[0-9]+$")).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_typed_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,d\n1,"x, y",31/01/2020\n\nnull,NONE,none\nabc,z,99/99/9999\n')
    got = readers.read_typed_text(spark, str(tmp_path), "id bigint, name varchar(9), d date", date_format="dd/MM/yyyy")
    assert rows(got) == [(None, None, None), (None, "z", None), (1, "x, y", dt.date(2020, 1, 31))]


def test_strict_scan_fails_when_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\nabc\n")
    frame = readers.read_delimited(spark, str(tmp_path), "id int", strict=True)
    with pytest.raises(Exception, match="(?i)malformed"):
        frame.collect()


def test_multi_line_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"a\nb ""q"""\n')
    assert rows(readers.read_delimited(spark, str(tmp_path), "id int, t string", multi_line=True)) == [(1, 'a\nb "q"')]


def test_json_forms(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a":1}\n{"b":"x"}\n')
    assert rows(readers.read_json(spark, str(tmp_path / "lines.json"))) == [(None, "x"), (1, None)]
    (tmp_path / "one.json").write_text('{\n "a": {\n "b": ""\n }, "n": "7", "l": [{"d": ""}]\n}')
    schema = T.StructType.fromDDL("a struct<b: int>, n int, l array<struct<d: date>>")
    got = readers.read_lenient_json(spark, str(tmp_path / "one.json"), schema, multi_line=True)
    assert got.schema.simpleString() == schema.simpleString()
    assert got.first().asDict(recursive=True) == {"a": {"b": None}, "n": 7, "l": [{"d": None}]}


def test_case_sensitive_names(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"host":"1","Host":"2"}\n')
    got = readers.read_json(spark, str(tmp_path / "c.json"), case_sensitive=True)
    assert sorted(got.columns) == ["Host", "host"]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_latest_partition_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).select("id", F.concat(F.lit("2026010"), F.col("id") % 3, F.lit("_000000")).alias("p")).write.partitionBy("p").parquet(path)
    got = readers.latest_partition(spark.read.parquet(path), "p")
    assert rows(got.select("id")) == [(2,), (5,)]
    assert "PartitionFilters: [isnotnull(p" in plan(got)


def test_latest_partition_by_value(spark, tmp_path):
    numbers = spark.range(1, 13).select("id", F.col("id").cast("int").alias("m"))
    numbers.write.partitionBy("m").parquet(str(tmp_path / "n"))
    assert rows(readers.latest_partition(spark.read.parquet(str(tmp_path / "n")), "m").select("id")) == [(12,)]
    times = spark.sql("SELECT id, IF(id = 0, NULL, concat('2026-01-0', id, ' 00:00:00')) AS p FROM range(3)")
    times.write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert rows(readers.latest_partition(spark.read.parquet(str(tmp_path / "t")), "p").select("id")) == [(2,)]
    with pytest.raises(ValueError, match="partitioned"):
        readers.latest_partition(spark.read.parquet(str(tmp_path / "n")).limit(0), "m")


def test_first_lines_beyond_the_first_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 3000 + "\na;b\n1;2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert rows(readers.read_after_first_line(spark, str(tmp_path), sep=";")) == [("1", "2")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows(readers.read_after_first_line(spark, str(tmp_path), sep=";")) == [("1", "2")]


def test_headers_are_parsed_and_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text('lead\n"a;x";b\n"1;1";2\n')
    got = readers.read_after_first_line(spark, str(tmp_path), sep=";")
    assert got.columns == ["a;x", "b"] and rows(got) == [("1;1", "2")]
    (tmp_path / "b.csv").write_text("lead\na;b\n1;2\n")
    with pytest.raises(Exception, match="has the header"):
        readers.read_after_first_line(spark, str(tmp_path), sep=";").collect()


def test_latest_file(spark, tmp_path):
    for day in ("20260101", "20260102"):
        (tmp_path / f"{day}.csv").write_text(f"d\n{day}\n")
    assert rows(readers.read_latest_file(spark, str(tmp_path), header=True)) == [(20260102,)]
    assert rows(readers.read_latest_file(spark, str(tmp_path), schema="d varchar(8)", header=True)) == [("20260102",)]
    with pytest.raises(ValueError, match="no files"):
        readers.read_latest_file(spark, str(tmp_path), pattern="*.dat")


def test_by_extension(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n")
    assert rows(readers.read_by_extension(spark, str(tmp_path / "a.tsv"), "x int, y int")) == [(1, 2)]
    with pytest.raises(ValueError, match="no reader"):
        readers.read_by_extension(spark, "a.xls")


def test_jdbc_options():
    base = {"url": "jdbc:x:y"}
    assert readers.jdbc_options(base, query="select 1")["query"] == "select 1"
    got = readers.jdbc_options(base, table="t", partition_column="id", bounds=(1, 9), partitions=4)
    assert (got["dbtable"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("t", "1", "9", "4")
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            readers.jdbc_options(base, **bad)


def test_arrivals_and_unprocessed(spark, tmp_path):
    def message(key, size):
        body = json.dumps({"detail": {"bucket": {"name": "b"}, "object": {"key": key, "size": size}}})
        return (json.dumps({"Records": [{"body": body, "receiptHandle": "r"}]}),)

    sent = spark.createDataFrame([message("small", 10), message("limit", 1_048_576), message("big", 1_048_577), ("junk",)], "message string")
    both = json.loads(message("small", 10)[0])["Records"] + json.loads(message("second", None)[0])["Records"]
    assert rows(readers.parse_arrivals(sent).select("key")) == [("big",), ("limit",), ("small",)]
    assert rows(readers.parse_arrivals(spark.createDataFrame([(json.dumps({"Records": both}),)], "message string")).select("key")) == [("second",), ("small",)]
    arrived, rejected = readers.split_arrivals(sent, max_bytes=1_048_576)
    assert rows(rejected.select("reason")) == [("too large",), ("unreadable",)]
    assert rows(arrived.select("key")) == [("limit",), ("small",)]
    done = spark.createDataFrame([("small", 1)], "file_name string, rows_processed bigint")
    assert rows(readers.unprocessed(arrived.withColumnRenamed("key", "file_name"), done).select("file_name")) == [("limit",)]
    (tmp_path / "f.csv").write_text("abc")
    assert rows(readers.listed_files(spark, str(tmp_path)).select("file_name", "length")) == [("f.csv", 3)]


def test_shared_folder_follows_the_session(spark, tmp_path):
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))

    named = session(**{"spark.checkpoint.dir": f"{tmp_path}/"})
    assert scratch_path(named, "x").startswith(f"{tmp_path}/lodestrata/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(**{"spark.master": "yarn"}))
    local = session(**{"spark.master": "local[2]", "spark.app.id": "some-app"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(local)
    use_folder(local, str(tmp_path))
    assert shared_folder(local) == str(tmp_path)
