import random

import numpy as np
import pyarrow as pa

from lodestrata.llm import components, minhash_dedup, wordhash
from tests.llm.texts import bag, edited, jaccard, sentence


def test_shingles_and_weighted_jaccard():
    r = random.Random(5)
    texts = [None, "", "...", "One", "two words", "a b c d", "a b c d e", "É é, x"] + [edited(r, sentence(r, 30) + " x " * 9, k) for k in range(20)]
    hashes, bounds = wordhash.shingle_hashes(pa.array(texts))
    assert np.diff(bounds).tolist() == [sum(bag(t).values()) for t in texts]
    part = lambda i: hashes[bounds[i] : bounds[i + 1]]
    for i in range(3, len(texts)):
        for j in range(3, len(texts)):
            assert abs(wordhash.weighted_jaccard(part(i), part(j)) - jaccard(bag(texts[i]), bag(texts[j]))) < 1e-12


def test_registers_agree_as_often_as_bags_are_similar():
    errors = []
    for seed in range(40):
        r = random.Random(seed)
        text = " ".join([sentence(r, 40)] * r.randint(1, 4) + [sentence(r, r.randint(5, 400))])
        pair = [text, edited(r, text, r.randint(1, 12))]
        hashes, bounds = wordhash.shingle_hashes(pa.array(pair))
        signatures = minhash_dedup.bag_minhash(hashes, bounds, 512)
        assert np.isfinite(signatures).all()
        errors.append((signatures[0] == signatures[1]).mean() - jaccard(*map(bag, pair)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_signatures_do_not_depend_on_the_batch():
    r = random.Random(2)
    texts = [sentence(r, n) for n in (3, 9, 40, 200, 900, 4000)] * 2
    whole = minhash_dedup.bag_minhash(*wordhash.shingle_hashes(pa.array(texts)), 64)
    for i, text in enumerate(texts):
        assert (minhash_dedup.bag_minhash(*wordhash.shingle_hashes(pa.array([text])), 64)[0] == whole[i]).all()


def brute_classes(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return {i: (min((k for k in groups[find(i)] if k is not None), default=None), len(groups[find(i)])) for i in range(len(rows))}


def corpus():
    r = random.Random(8)
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "one two three")]
    for family in range(12):
        text = sentence(r, r.choice([30, 120, 400]))
        if family % 3 == 0:
            text = " ".join([text] * 3)
        for _ in range(r.randint(1, 12)):
            # One change in thirty words leaves about 0.7 of the shingles, one in sixty about 0.85.
            text = edited(r, text, max(1, len(text.split()) // r.choice([30, 60, 90, 200])))
            rows.append((len(rows) + 1, text))
    return rows + [(None, rows[10][1]), (rows[11][0], rows[11][1]), (200, rows[12][1])]


def test_classes_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "doc_id long, text string, node int").repartition(4)
    want = brute_classes(rows)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["class_id"], r["class_rows"]) for r in minhash_dedup.near_duplicates(spark, docs).collect())
    assert got == sorted((key is None, key, *want[i]) for i, (key, _) in enumerate(rows))
    kept = minhash_dedup.survivors(spark, docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({w[0] for w in want.values()})


def test_large_family_of_texts_below_the_threshold(spark):
    r = random.Random(4)
    base = sentence(r, 300)
    far = [edited(r, base, 22) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(far)] + [(1000 + i, edited(r, t, 3)) for i, t in enumerate(far[::10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows)
    got = {x["doc_id"]: (x["class_id"], x["class_rows"]) for x in minhash_dedup.near_duplicates(spark, docs).collect()}
    assert got == {key: want[i] for i, (key, _) in enumerate(rows)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_dedup.near_duplicates(spark, docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (7, 7), (300, 400)]
    got = dict(components.components(spark, spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 150: 100, 200: 100, 300: 300, 400: 300}


def test_texts_of_nodes(spark, monkeypatch):
    """Exactly the texts asked for, once each, also when the filter lets nearly all texts pass."""
    from pyspark.sql import functions as F

    texts = spark.range(500).select(F.xxhash64("id").alias("node"), F.concat(F.lit("t"), "id").alias("text"))
    texts = texts.unionAll(texts).repartition(5)
    wanted = texts.where("substr(text, -1) = '7'").select("node").unionAll(texts.limit(3).select("node"))
    for bits in (26, 8):
        monkeypatch.setattr(minhash_dedup, "_FILTER_BITS", bits)
        found = [r["text"] for r in minhash_dedup._one_of_each(texts, wanted).collect()]
        assert len(found) == len(set(found)) and {f"t{i}" for i in range(7, 500, 10)} <= set(found) and len(found) <= 53


def test_recall_by_similarity(spark):
    """Of pairs at the threshold or above, nearly all are found; every link reported is one."""
    r = random.Random(21)
    docs, pairs = [], []
    for i in range(240):
        words = sentence(r, 200).split()
        other = list(words)
        for k in range(r.randint(0, 6)):
            other[r.randrange(len(other))] = f"new{i}x{k}"
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        pairs.append(jaccard(bag(docs[-1][1]), bag(docs[-2][1])))
    found = {x["doc_id"]: x["class_id"] for x in minhash_dedup.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.01)):
        band = [i for i, s in enumerate(pairs) if low <= s < high]
        assert len(band) > 15 and sum(found[2 * i] == found[2 * i + 1] for i in band) >= 0.99 * len(band)
    assert not any(found[2 * i] == found[2 * i + 1] for i, s in enumerate(pairs) if s < 0.8)
