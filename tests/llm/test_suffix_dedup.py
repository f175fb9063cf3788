import hashlib
import random

import numpy as np
import pytest

from lodestrata.llm import suffix_dedup


def brute(texts, length):
    counts, parts = {}, [(t or "").encode() for t in texts]
    for b in parts:
        for i in range(len(b) - length + 1):
            counts[b[i : i + length]] = counts.get(b[i : i + length], 0) + 1
    out = []
    for b in parts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def texts_for(length):
    r = random.Random(length)
    base = ["".join(r.choice("abé") for _ in range(length * 4)) for _ in range(3)]
    texts = [None, "", "a" * (length * 3), "a" * (length - 1), "aé" * length]
    for _ in range(50):
        text = ""
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            i = r.randint(0, len(b))
            text += b[i : r.randint(i, len(b))] + "".join(r.choice("xyzé") for _ in range(r.randint(0, 9)))
        texts.append(text)
    return texts + texts[:15]


@pytest.mark.parametrize("period", sorted(suffix_dedup.DIFFERENCE_COVERS))
def test_covers_hold_every_difference(period):
    residues = suffix_dedup.DIFFERENCE_COVERS[period]
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("length", [5, 20, 200])
def test_against_all_substrings(spark, length):
    texts = texts_for(length)
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes_before int").repartition(3)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark, rows, length=length, group_bytes=4096).collect()}
    want = brute(texts, length)
    assert {i: tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for i in got} == dict(enumerate(want))
    assert all(got[i]["n_bytes_before"] == i for i in got)


def test_long_text_across_blocks(spark):
    r = random.Random(1)
    noise = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    passage = noise(900)
    long = noise(70_000) + passage + noise(60_000)
    rows = spark.createDataFrame([(1, long), (2, noise(150) + passage + noise(90))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["spans"]) for r in suffix_dedup.remove_repeats(spark, rows, returns=["n_removed", "spans"]).collect()}
    assert got[1][1] == [70_000, 70_900] and got[2] == (900, [150, 1050])


def test_kept_text_drops_cut_characters(spark):
    passage = "é" * 100
    rows = spark.createDataFrame([(1, "x" + passage + "é1"), (2, "y" + passage + "ê2")], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in suffix_dedup.remove_repeats(spark, rows, returns=["kept_text"]).collect()}
    assert got == {1: "x1", 2: "y2"}


def test_empty_table_and_clashing_names(spark):
    rows = spark.createDataFrame([], "doc_id long, text string, owner string, bucket int, c0 long")
    assert suffix_dedup.remove_repeats(spark, rows).count() == 0
    rows = spark.createDataFrame([(1, "a", "o", 2, 3)], rows.schema)
    assert suffix_dedup.remove_repeats(spark, rows).select("owner", "bucket", "c0", "n_bytes").first() == ("o", 2, 3, 1)


def test_names_tell_single_bits_apart():
    data = np.random.default_rng(3).integers(0, 256, 600, dtype=np.uint8)
    for width in (1, 3, 8, 21, 110, 200):
        names = suffix_dedup.window_names(data, width)
        for at in (0, width // 2, width - 1):
            for bit in (1, 128):
                other = data[:width].copy()
                other[at] ^= bit
                assert suffix_dedup.window_names(other, width)[0] != names[0]
