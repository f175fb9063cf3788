"""JSON files of any layout: the rows of the whole-file reader for every split size."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import objects, readers
from tests.helpers import rows

DDL = "id int, t string, n struct<a: array<struct<b: string>>, c: double>"


@pytest.fixture
def split_by(spark):
    yield lambda size: [spark.conf.set(k, size) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def records(r, count):
    texts = ["plain", "", "}", "{", '"', '\\', '\\"}', "]}[{", "two\nlines", "é}ü", "}" * 30, '"},{"', "x" * 120, None]
    return [{"id": i, "t": r.choice(texts), "n": r.choice([None, {"a": [{"b": r.choice(texts)}] * r.randrange(3), "c": 0.5}, {}])} for i in range(count)]


@pytest.mark.parametrize("size", (17, 150, 10_000_000))
def test_objects_equal_the_whole_file_reader(spark, tmp_path, split_by, size):
    r = random.Random(3)
    for name, layout in {"line": {}, "pretty": {"indent": 2}, "bare": {"ensure_ascii": False}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(records(r, 12), **layout))
    (tmp_path / "one.json").write_text(json.dumps(records(r, 1)[0], indent=1))
    (tmp_path / "end.json").write_text("\n " + json.dumps(records(r, 2)) + " \n\n")
    (tmp_path / "mark.json").write_text("\ufeff" + json.dumps(records(r, 2)))
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "space.json").write_text("[\n]\n")
    (tmp_path / "empty.json").write_text("")
    whole = rows(readers.read_json(spark, str(tmp_path), readers._schema(DDL), multi_line=True))
    assert len(whole) == 41
    split_by(size)
    assert rows(readers.read_json_objects(spark, str(tmp_path), DDL)) == whole


@pytest.mark.parametrize("size", (9, 40, 10_000_000))
def test_objects_one_after_another(spark, tmp_path, split_by, size):
    given = records(random.Random(4), 30)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(x) for x in given[:10]))
    (tmp_path / "pretty.json").write_text("\n".join(json.dumps(x, indent=4) for x in given[10:20]) + "\n")
    (tmp_path / "tight.json").write_text("".join(json.dumps(x) for x in given[20:]))
    (tmp_path / "blank.json").write_text(" \n")
    split_by(size)
    found = objects.json_objects(spark, str(tmp_path)).collect()
    assert sorted((json.loads(r["value"]) for r in found), key=lambda x: x["id"]) == given


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path, split_by):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "t": "}"} for i in range(3000)]))
    split_by(4000)
    found = readers.read_json_objects(spark, str(tmp_path), "id int, t string")
    assert found.agg(F.count("*"), F.sum("id"), F.min("t")).first()[:] == (3000, 2999 * 1500, "}")
    assert objects._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_filters_pushed_below_the_reader_meet_no_rest(spark, tmp_path):
    (tmp_path / "a.json").write_text(' [{"id": 1, "n": [1, 2]}, {"id": 2, "n": []}] ')
    found = readers.read_json_objects(spark, str(tmp_path), "id int, n array<int>")
    assert rows(found.select("id", F.explode("n"))) == [(1, 1), (1, 2)]
    assert rows(found.where("size(n) < 1").select("id")) == [(2,)]


def test_schema_found_in_the_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2, "t": "a\nb"}, {"n": {"k": 0.5}}], indent=2))
    found = readers.read_json_objects(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in found.schema} == {"id": "bigint", "t": "string", "n": "struct<k:double>"}
    assert rows(found.select("id", "t", "n.k")) == [(None, None, 0.5), (1, None, None), (2, "a\nb", None)]


@pytest.mark.parametrize("size", (2, 10_000_000))
@pytest.mark.parametrize(
    ("text", "message"),
    [
        ('[{"id":1},{"id":2', "do not match"),
        ('[{"id":1}', "do not match"),
        ('{"id":1', "do not match"),
        ('{"id":{"a":1}', "do not match"),
        ('[{"id":1},{"t":"a}]', "do not match"),
        ('[{"id":1}]{"id":2}', "do not match"),
        ('[{"id":1}] more', "not only objects"),
        ('[{"id":1}, null, {"id":2}]', "not only objects"),
        ('[[{"id":1}]]', "not only objects"),
        ("[1, 2]", "not only objects"),
        ("5", "not only objects"),
    ],
)
def test_other_files_fail(spark, tmp_path, split_by, text, message, size):
    (tmp_path / "a.json").write_text(text)
    split_by(size)
    with pytest.raises(Exception, match=message):
        objects.json_objects(spark, str(tmp_path)).collect()
