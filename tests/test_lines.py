"""Readers whose records and first lines may cross splits: the same rows for every split size."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import lines, readers
from tests.helpers import rows

SIZES = (7, 23, 64, 150, 1000, 10_000_000)


@pytest.fixture
def split_by(spark):
    yield lambda size: [spark.conf.set(k, size) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def quoted(r, records):
    fields = ["plain", "", 'say ""hi""', "two\nlines", "a,b", "\n\n\n", 'end""', "é\r\nü", "x" * 90 + "\n" + "y" * 40, '"",""\n']
    return "".join(",".join([str(i)] + [f'"{r.choice(fields)}"' for _ in range(2)]) + "\n" for i in range(records))


@pytest.mark.parametrize("size", SIZES)
def test_quoted_records_equal_the_whole_file_reader(spark, tmp_path, split_by, size):
    r = random.Random(5)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text('id,"a\nb",c\n' + quoted(r, 30 + k), newline="")
    (tmp_path / "windows.csv").write_text('\r\nid,a,c\r\n1,"x\r\ny",z\r\n\r\n2,"",""\r\n', newline="")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,a,c")
    ddl = "id int, a string, c string"
    whole = rows(readers.read_delimited(spark, str(tmp_path), ddl, multi_line=True))
    split_by(size)
    found = readers.read_quoted(spark, str(tmp_path), ddl)
    assert rows(found) == whole and len(whole) == 95
    if size < 100:
        assert lines._lines(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 6


def test_large_files_are_read_by_many_tasks(spark, tmp_path, split_by):
    (tmp_path / "a.csv").write_text("id,t\n" + "".join(f'{i},"a\nb"\n' for i in range(2000)))
    split_by(2000)
    found = readers.read_quoted(spark, str(tmp_path), "id int, t string")
    assert found.agg(F.count("*"), F.sum("id"), F.min("t")).first()[:] == (2000, 1999 * 1000, "a\nb")
    assert found.rdd.getNumPartitions() > 6


def test_quotes_that_do_not_match_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"open\n2,x\n')
    with pytest.raises(Exception, match="quotes do not match"):
        readers.read_quoted(spark, str(tmp_path), "id int, t string").collect()


def test_without_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1;"a;b"\n2;"c\nd"\n')
    assert rows(readers.read_quoted(spark, str(tmp_path), "id int, t string", sep=";", header=False)) == [(1, "a;b"), (2, "c\nd")]


@pytest.mark.parametrize("size", SIZES)
def test_first_lines_in_any_split(spark, tmp_path, split_by, size):
    for n in range(3):
        lead = "".join(f"lead {i} {'x' * 40}\n" for i in range(4))
        (tmp_path / f"f{n}.csv").write_text(f"{lead}id;value\n" + "".join(f"{n}-{i};v{i}\n" for i in range(40)))
    (tmp_path / "short.csv").write_text("lead\nlead\n")
    split_by(size)
    found = readers.read_after_first_line(spark, str(tmp_path), sep=";", skip=4)
    assert found.columns == ["id", "value"]
    assert rows(found) == sorted((f"{n}-{i}", f"v{i}") for n in range(3) for i in range(40))
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_file_has_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lead\n")
    with pytest.raises(ValueError, match="line 3"):
        readers.read_after_first_line(spark, str(tmp_path), skip=2)
