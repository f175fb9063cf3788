import random
import re
import zlib

import numpy as np
import pyarrow as pa

from lodestrata.llm import toxicity
from lodestrata.llm.toxicity import Machine, forward, terms_of

from tests.helpers import rows

from .texts import sentence

DOCS, LABELS = "doc_id long, text string, score string, lang string", "doc_id long, toxic int"


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def ends(text):
    """A text's distinct terms, written out: words, and first and last bytes of longer ones."""
    out = set()
    for w in words(text):
        b = w.encode()
        out |= {("word", b)} | {(k, n, x) for n in (4, 5, 6) if len(b) > n for k, x in (("first", b[:n]), ("last", b[-n:]))}
    return out


def test_terms_against_a_plain_version():
    r = random.Random(1)
    texts = [" ".join(r.choice(["Ab", "abcde", "abcdef", "éclairs", "x-y", "xabcde", ""]) for _ in range(r.randrange(8))) for _ in range(40)] + ["", None, "!?", "a" * 50_000]
    found = [set() for _ in texts]
    for hashes, owner in terms_of(pa.array(texts, pa.string())):
        for h, o in zip(hashes.tolist(), owner.tolist()):
            found[o].add(h)
    plain = [ends(t or "") for t in texts]
    assert [len(f) for f in found] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(found[i] & found[j]) == len(plain[i] & plain[j])


def test_forward_is_the_written_out_sum():
    r = np.random.default_rng(2)
    machine = Machine(np.arange(6, dtype=np.uint64), r.normal(size=6), r.normal(size=(6, 3)), 0.5)
    sets = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5]]
    column, row = np.concatenate(sets).astype(int), np.repeat(np.arange(4), [len(s) for s in sets])
    odds, _ = forward(machine, column, row, 4)
    for i, s in enumerate(sets):
        pairs = sum(machine.factors[a] @ machine.factors[b] for x, a in enumerate(s) for b in s[x + 1 :])
        assert abs(odds[i] - (0.5 + machine.weights[s].sum() + pairs)) < 1e-12


def table(seed, count, mark):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        toxic, parts = mark(r)
        made = sentence(r, 30).split()
        for p in parts:
            made.insert(r.randrange(len(made)), p)
        docs.append((i, " ".join(made), "x", "en"))
        labels.append((i, toxic))
    return docs, labels


def accuracy(spark, docs, labels):
    found = toxicity.judge(spark, spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, LABELS)).collect()
    truth = dict(labels)
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found) and len(found) == len(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    return sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held)


def test_held_out_accuracy(spark):
    def mark(r):
        toxic = int(r.random() < 0.2)
        return toxic, [r.choice(["blighter", "Rotter", "rotters", "grubling", "grublings"]) for _ in range(3 * toxic)]

    assert accuracy(spark, *table(1, 1500, mark)) > 0.97


def test_an_insult_with_a_group(spark):
    """Either word alone is harmless; only both together are toxic."""

    def mark(r):
        insult, group = r.random() < 0.5, r.random() < 0.5
        return int(insult and group), (["vermin"] if insult else []) + (["northerners"] if group else [])

    assert accuracy(spark, *table(3, 3000, mark)) > 0.97
    pair = Machine(np.arange(2, dtype=np.uint64), np.array([-4.0, -4.0]), np.array([[4.0], [4.0]]), -2.0)
    assert (forward(pair, np.array([0, 1, 0, 1]), np.array([0, 1, 2, 2]), 3)[0] > 0).tolist() == [False, False, True]


def test_labels_held_out_are_not_read(spark):
    docs, labels = table(4, 400, lambda r: (lambda t: (t, ["blighter"] * t))(int(r.random() < 0.3)))
    turned = [(k, 1 - v if zlib.crc32(str(k).encode()) % 5 == 0 else v) for k, v in labels]
    made = [rows(toxicity.judge(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(x, LABELS))) for x in (labels, turned)]
    assert made[0] == made[1]


def test_odd_rows(spark):
    docs = [(1, None, "", None), (1, None, "", None), (None, "a b", "", ""), (2, "", "", ""), (3, "many words " * 40_000, "", "")]
    none = spark.createDataFrame([], LABELS)
    frame = spark.createDataFrame(docs, DOCS)
    found = rows(toxicity.judge(spark, frame, none))
    assert len(found) == 5 and all(r[2] < 1e-5 and r[3] == 0 for r in found)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (9, 1), (3, 7), (3, 0)], LABELS)
    assert toxicity.judge(spark, frame, labels).count() == 5
    assert rows(toxicity.judge(spark, frame.where("false"), labels)) == []
