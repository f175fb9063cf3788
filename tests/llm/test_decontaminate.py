import random
import re
from collections import Counter

from lodestrata.llm import decontaminate
from tests.helpers import plan
from tests.llm.texts import edited, jaccard, sentence


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(docs, items):
    found = {}
    for row, (key, text) in enumerate(docs):
        w = words(text)
        for item, target in items:
            t = words(target)
            if len(t) < 5 or len(w) < 5:
                continue
            best = max(jaccard(shingles(w[i : i + len(t)]), shingles(t)) for i in range(max(1, len(w) - len(t) + 1)))
            if best >= 0.8:
                found[row, key, item] = round(best, 9)
    return found


def test_against_all_windows(spark):
    r = random.Random(3)
    items = [(i, sentence(r, r.randint(13, 60))) for i in range(25)] + [(30, "too short"), (31, None), (32, ""), (33, "one two three four five")]
    items.append((34, items[3][1]))
    docs = [(1, None), (2, ""), (3, "few words"), (4, items[0][1]), (5, items[1][1].upper().replace(" ", ", "))]
    for i in range(60):
        text = sentence(r, r.randint(0, 200))
        item = items[r.randrange(25)][1]
        text += " " + edited(r, item, r.choice([0, 1, 1, 2, 5])) + " " + sentence(r, r.randint(0, 50))
        docs.append((i % 50 + 10, text))
    docs.append((None, docs[7][1]))
    docs.append((6, " ".join(items[2][1].split()[1:])))
    rows = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(rows, bench).collect()
    want = brute(docs, items)
    assert Counter((x["doc_id"], x["item_id"], round(x["similarity"], 9)) for x in got) == Counter((k, i, s) for (_, k, i), s in want.items())
    assert len(got) > 15


def test_rotated_and_reordered_items(spark):
    r = random.Random(5)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate((50, 59, 40, 60, 100, 200))] + [(6, sentence(r, 80))]
    docs = []
    for (i, text), turn in zip(items, (10, 10, 6, 5, 30, 90, 8)):
        w = text.split()
        third = len(w) // 3
        for turned in (w[-turn:] + w[:-turn], w[turn:] + w[:turn], w[third:] + w[:third], w[-turn:] + ["and", "so"] + w[:-turn]):
            docs.append((len(docs), f"{sentence(r, 100)} {' '.join(turned)} {sentence(r, 60)}"))
        docs.append((len(docs), " ".join(w[-turn:] + w[:-turn])))
        docs.append((len(docs), " ".join(w[-4:] + w[:-9])))
    docs.append((len(docs), items[0][1] + " " + items[0][1] + " " + items[3][1]))
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(x["doc_id"], x["item_id"], round(x["similarity"], 9)) for x in got} == {(k, i, s) for (_, k, i), s in want.items()}
    assert {x["doc_id"] for x in got} >= {0, 6, 12}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs, bench).count() == 1


def test_blocks_cover_the_fingerprint(spark):
    """Fingerprints share a block if one of the radius + 1 pieces of their bits is equal; within the radius, always."""
    from pyspark.sql import functions as F

    r, rows = random.Random(9), []
    edges = [64 * i // 24 for i in range(25)]
    for n in range(400):
        one = r.getrandbits(64)
        other = one
        for bit in r.sample(range(64), r.randint(0, 40)):
            other ^= 1 << bit
        if n % 3 == 0:  # differ in every block
            other = one ^ sum(1 << r.randrange(a, b) for a, b in zip(edges, edges[1:]))
        agree = any((one ^ other) >> a & ((1 << (b - a)) - 1) == 0 for a, b in zip(edges, edges[1:]))
        assert agree or bin(one ^ other).count("1") > 23
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        rows.append((signed(one), signed(other), agree))
    frame = spark.createDataFrame(rows, "a long, b long, agree boolean")
    assert frame.where(decontaminate.share_block(F.col("a"), F.col("b"), 23) != F.col("agree")).count() == 0
    assert 100 < sum(x[2] for x in rows) < 300


def test_simhash(spark):
    from pyspark.sql import functions as F

    r = random.Random(1)
    hashes = [r.getrandbits(64) - (1 << 63) for _ in range(37)]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(decontaminate.simhash(F.col("h")).alias("s")).first()["s"]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert got % (1 << 64) == want


def test_simhash_of_many_hashes(spark):
    import numpy as np
    from pyspark.sql import functions as F

    r = np.random.default_rng(2)
    hashes = r.integers(-(1 << 63), (1 << 63) - 1, 140_000) | 0x0F0F  # bits that all hashes have overflow a lane of 16
    got = spark.createDataFrame([(hashes.tolist(),)], "h array<long>").select(decontaminate.simhash(F.col("h")).alias("s")).first()["s"]
    want = sum(1 << b for b in range(64) if 2 * int((hashes >> b & 1).sum()) > len(hashes))
    assert got % (1 << 64) == want


def test_a_long_item(spark):
    r = random.Random(8)
    text = sentence(r, 140_000)
    docs = spark.createDataFrame([(1, text), (2, edited(r, text, 2_000)), (3, " ".join(reversed(text.split())))], "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame([(9, text)], "item_id long, text string")).collect()
    assert sorted((x["doc_id"], x["item_id"], x["n_words"]) for x in got) == [(1, 9, 140_000), (2, 9, 140_000)]


def test_the_index_selects(spark, monkeypatch):
    """Of all pairs of a window and an item of one size, under one in a hundred meets; those of a copy and its item do."""
    r = random.Random(11)
    items = [(i, sentence(r, 30)) for i in range(300)]
    docs = [(i, sentence(r, 10) + " " + text) for i, text in items]
    seen, plain = [], decontaminate.meeting
    monkeypatch.setattr(decontaminate, "meeting", lambda w, i, a, radius: seen.append((w, plain(w, i, a, radius))) or seen[-1][1])
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} >= {(i, i) for i in range(300)}
    windows, met = seen[0]
    pairs = met.select("k", "start", "item_row").distinct().count()
    assert windows.count() <= pairs < 0.01 * windows.count() * len(items)


def test_anchors_are_rare_and_enough(spark):
    """A window that lacks every anchor of an item has less than the similarity needs."""
    import math

    r = random.Random(12)
    texts = [sentence(r, n) for n in (5, 6, 9, 20, 40, 41)] + ["a b c d e " * 12]
    items = spark.createDataFrame(list(enumerate(texts)), "item_row long, text string")
    bags = items.select("item_row", decontaminate.shingle_hashes(decontaminate.plain_words(items.text)).alias("hashes"))
    found = decontaminate._anchors(decontaminate._bag(bags, ["item_row"], "hashes"), 0.8).collect()
    for row, text in enumerate(texts):
        bag = Counter(bags.where(bags.item_row == row).first()["hashes"])
        total, mine = sum(bag.values()), {x["h"] for x in found if x["item_row"] == row}
        assert mine and total - sum(bag[h] for h in mine) < math.ceil(0.8 * total - 1e-9)


def test_the_plan_holds_each_step_once(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    items = spark.createDataFrame([(2, "a b c d e f g h")], "item_id long, text string")
    found = decontaminate.find_leaks(rows, items)
    assert plan(found).count("Exchange") <= 20  # the driver holds a plan whole; with all steps in one it had more than 50
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 2)]


def test_texts_without_a_place_stay_out_of_the_shuffle(spark, monkeypatch):
    r = random.Random(13)
    items = [(i, sentence(r, 30)) for i in range(5)]
    docs = [(i, " ".join(f"v{i}x{k}" for k in range(20))) for i in range(2_000)] + [(5_000 + i, text) for i, text in items]
    bodies, plain = [], decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda s, rows, label: [bodies.append(rows) if "body" in rows.columns else None, plain(s, rows, label)][1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as where the keys are too many to broadcast
    try:
        got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
        assert {(x["doc_id"], x["item_id"]) for x in got} == {(5_000 + i, i) for i in range(5)}
        [kept] = bodies
        above, below = plan(kept).split("BroadcastHashJoin", 1)
        assert above.count("hashpartitioning(k") == 1 and "hashpartitioning(k" not in below  # filtered before the only shuffle
        assert 5 <= kept.count() < 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
