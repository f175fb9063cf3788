import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestrata.llm import collocations
from lodestrata.llm.collocations import count_pairs, merge_counts, words_of

from tests.helpers import rows

COLUMNS = ["lang", "rank", "phrase", "words", "a", "l", "r", "n", "score"]


def expected(table, least, best, share=100):
    counts, totals = {}, Counter()
    for lang, text in table:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        kept = []
        for p, a in found.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if len(p) < 2 or a < least or any(len(q) > len(p) and b >= least and 100 * b >= share * a and inside(q) for q, b in found.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), len(p), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, words, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), words, -a, left, right, totals[lang], -score))
    return sorted(out)


def table(seed, texts=60):
    r = random.Random(seed)
    words = ["Ab", "ab", "c", "dé", "e", " x", "ÀB", "#"]
    phrases = ["c dé e", "e ab c", "# # # #", "ab c dé e ab"]
    blanks = [" ", " ", "\t", "  ", ". ", "\n", " , ", "\x0b"]
    make = lambda: "".join((r.choice(phrases) if r.random() < 0.3 else r.choice(words)) + r.choice(blanks) for _ in range(r.randrange(40)))
    return [(r.choice(["en", "fr", None, "und", ""]), make()) for _ in range(texts)] + [("en", None), ("en", ""), ("de", " . "), ("nl", "one")]


@pytest.mark.parametrize("share", [100, 60])
def test_against_brute_force(spark, share):
    data = table(share)
    docs = spark.createDataFrame([(lang, text, "x") for lang, text in data], "lang string, text string, n string").repartition(5)
    found = collocations.collocations(spark, docs, least=5, best=20, share=share)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == expected(data, 5, 20, share)
    assert max(r["words"] for r in found.collect()) == 5


def test_small_groups_and_rows(spark, monkeypatch):
    data = table(3)
    docs = spark.createDataFrame(data, "lang string, text string").coalesce(1)
    monkeypatch.setattr(collocations, "GROUP_BYTES", 300)
    monkeypatch.setattr(collocations, "_ROW_IDS", 5)
    parts = list(collocations._rows_of(np.array([1, 2, 0, 3, 4, 5, 6, 7, 8, 9, 0, 1])))
    assert [p.tolist() for p in parts] == [[1, 2, 0, 3, 4, 5, 6, 7, 8, 9, 0], [1]]
    assert sorted(map(tuple, collocations.collocations(spark, docs, least=5, best=20).collect())) == expected(data, 5, 20)


def test_no_rows_and_no_frequent_phrase(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert rows(collocations.collocations(spark, docs)) == []
    assert rows(collocations.collocations(spark, spark.createDataFrame([("en", "a b c d")], "lang string, text string"))) == []


def test_a_long_text_and_repeated_rows(spark):
    data = [("en", "to be or not " * 20_000)] + [("en", "to be")] * 50
    found = rows(collocations.collocations(spark, spark.createDataFrame(data, "lang string, text string")).select("phrase", "a", "n"))
    assert "be or not" not in [f[0] for f in found]  # its words stand inside a longer phrase as often
    assert {("to be", 20_050, 80_100), ("to be or not", 20_000, 80_100), ("to be or not to", 19_999, 80_100)} <= set(found)


def test_dense_and_sparse_tiles_agree(monkeypatch):
    r = np.random.default_rng(4)
    codes = np.minimum(r.zipf(1.3, 200_000), 40_000).astype(np.int32)
    codes[r.integers(0, codes.size, 5_000)] = 0
    keys, counts = np.unique([(int(a) << 32) | int(b) for a, b in zip(codes, codes[1:]) if a and b], return_counts=True)
    for dense in (1e-6, 1 / 8, 2.0):
        monkeypatch.setattr(collocations, "DENSE", dense)
        found = count_pairs(codes)
        assert found[0].tolist() == keys.tolist() and found[1].tolist() == counts.tolist()


def test_merging_and_words():
    key, count = merge_counts([np.array([1, 5]), np.array([5, 7])], [np.array([2, 3]), np.array([4, 1])])
    assert key.tolist() == [1, 5, 7] and count.tolist() == [2, 7, 1]
    words, codes = words_of([b"A b.a", b"", b"b  c!", b"..."])
    assert words.to_pylist() == ["a", "b", "c"] and codes.tolist() == [1, 2, 0, 1, 0, 2, 3]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = spark.range(1).select(F.lit(3 * 10**15).alias("a"), F.lit(9 * 10**15).alias("n"), F.array(F.lit(4 * 10**15)).alias("f"), F.array(F.lit(5 * 10**15)).alias("b"))
    got = big.select(collocations._least_cut(*map(F.col, "anfb")).alias("cut")).first()["cut"]
    assert got["score"] == 1000 * 3 * 9 // 20 and got["k"] == 1
