import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import token_files

RANKS = b"\n".join(base64.b64encode(bytes([b])) + f" {b}".encode() for b in range(256))
PATTERN = r"\s+|\S+"


def test_counts_of_texts(spark):
    texts = [None, "", "abc", "é é", "x" * 5000, "<|endoftext|>"] + ["t" * n for n in range(40)] + ["abc"]
    rows = spark.createDataFrame([(i if i != 7 else None, t, "f") for i, t in enumerate(texts)], "doc_id long, text string, file string").repartition(4)
    got = token_files.count_documents(spark, rows, RANKS, PATTERN, separator=300).collect()
    want = [(i if i != 7 else None, len((t or "").encode())) for i, t in enumerate(texts)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_files.count_documents(spark, rows.limit(0), RANKS, PATTERN, 300).count() == 0


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 21])
def test_stitching_across_blocks(spark, tmp_path, block):
    r = random.Random(block)
    want = set()
    for k in range(4):
        ids = [r.choice([1, 2, 3, 9]) if k else 1 for _ in range(r.randint(1, 60))]
        np.array(ids, "<u2").tofile(path := f"{tmp_path}/{k}.tokens")
        place = count = 0
        for i in ids:
            if i == 9:
                want.add((path, place, count, True))
                place, count = place + 1, 0
            else:
                count += 1
        if count:
            want.add((path, place, count, False))
    open(f"{tmp_path}/empty.tokens", "w").close()
    files = spark.createDataFrame([(f"{tmp_path}/{k}.tokens",) for k in (0, 1, 2, 3, "empty")], "file string")
    assert set(map(tuple, token_files.count_tokens(files, 9, block_tokens=block).collect())) == want


def test_half_an_id_fails(spark, tmp_path):
    (tmp_path / "x.tokens").write_bytes(b"abc")
    with pytest.raises(Exception, match="broken token file"):
        token_files.count_tokens(spark.createDataFrame([(f"{tmp_path}/x.tokens",)], "file string"), 9).collect()


def test_blocks_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """The list of blocks fits one partition; the blocks must not be read by one task."""
    for k in range(4):
        np.array([1, 2, 9] * 100, "<u2").tofile(f"{tmp_path}/{k}.tokens")
    files = spark.createDataFrame([(f"{tmp_path}/{k}.tokens",) for k in range(4)], "file string")
    made, plain = [], token_files.written

    def spied(session, rows, label):
        made.append((label, rows))
        return plain(session, rows, label)

    monkeypatch.setattr(token_files, "written", spied)
    assert token_files.count_tokens(files, 9, block_tokens=50).count() == 400
    scan = dict(made)["token-ends"]
    assert scan.count() == 24 and scan.select(F.spark_partition_id()).distinct().count() > 12
