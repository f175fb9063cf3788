import math
import re
from collections import Counter

from pyspark.sql import functions as F

from lodestrata.llm import quality
from tests.llm.texts import sentence

import random


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) for k in range(8) if windows[tuple(words[i : i + 8])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeated = len(words), len(covered)
    failed = n < 20 or 100 * repeated > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated, failed


def texts():
    r = random.Random(1)
    block = sentence(r, 12)
    out = [None, "", " \t\n\x0b\x0c\r", "one", "a\x1cb\x85c d\u00a0e", "x #*$%&|<> y", "a\na\n\n \n a\na", "😀 é " * 30, block, block + " " + block, ("w " * 7).strip(), "w " * 8, "w " * 9, "w " * 500]
    for _ in range(40):
        out.append(r.choice(["\n", " ", "\t "]).join(r.choice([block, sentence(r, r.randint(1, 30))]) for _ in range(r.randint(1, 6))))
    return out + out[:5] + [sentence(r, 20_000)]


def test_counts_against_python(spark):
    rows = spark.createDataFrame([(i, t, "en", 7, "r") for i, t in enumerate(texts())], "doc_id long, text string, lang string, n_words int, row string").repartition(3)
    got = {r["doc_id"]: r for r in quality.judge(rows).collect()}
    for i, text in enumerate(texts()):
        assert tuple(got[i][c] for c in quality.RESULTS[:6]) == base(text), repr(text)[:200]
        assert not (got[i]["base_failed"] and got[i]["kept"]) and got[i]["row"] == "r"
    assert quality.judge(rows.limit(0)).count() == 0


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    half = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x)
    return math.sqrt((half(p, q) + half(q, p)) / 2)


def test_distances_against_python(spark):
    r = random.Random(6)
    common = quality.COMMON_WORDS["en"].split()
    rows = [(i, " ".join(r.choice(common + ["Tree,", "House", "blue", "42"]) for _ in range(r.randint(80, 300))), "en") for i in range(12)]
    rows += [(20, "der die und " * 60, "de"), (21, "kein Text", None), (22, "x y z " * 60, "xx")]
    got = {x["doc_id"]: x for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    classes = ["[A-Z]", "[0-9]", "[#*$%&|<>]", r"[,]", " ", "[a-z]"]
    histograms = {i: ([len(re.findall(p, t)) for p in classes], [t.split().count(w) for w in common] + [sum(w not in common for w in t.split())]) for i, t, lang in rows if lang == "en"}
    pooled = [[sum(h[k][j] for h in histograms.values()) for j in range(len(histograms[0][k]))] for k in (0, 1)]
    for i, h in histograms.items():
        long_text, long_words = len(rows[i][1]) >= 400, len(rows[i][1].split()) >= 100
        assert got[i]["class_distance"] is None if not long_text else abs(got[i]["class_distance"] - distance(h[0], pooled[0])) < 1e-9
        assert got[i]["word_distance"] is None if not long_words else abs(got[i]["word_distance"] - distance(h[1], pooled[1])) < 1e-9
    assert got[20]["word_distance"] == 0 and got[21]["class_distance"] is None and got[22]["word_distance"] is None


def test_strange_texts_go_and_ordinary_ones_stay(spark):
    r = random.Random(9)
    common = quality.COMMON_WORDS["en"].split()
    prose = lambda n: " ".join(r.choice(common) if r.random() < 0.45 else r.choice(["river", "stone,", "Walking", "morning.", "bright"]) + "aeiou"[r.randrange(5)] for _ in range(n))
    rows = [(i, prose(r.randint(100, 400))) for i in range(60)]
    rows += [(100, " ".join(w + "###" for w in prose(200).split())), (101, prose(200).upper()), (102, " | ".join("Item" + str(k) for k in range(200)))]
    got = {x["doc_id"]: x["kept"] for x in quality.judge(spark.createDataFrame([(*x, "en") for x in rows], "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in (100, 101, 102))


def test_copies_and_long_tables_do_not_move_the_references(spark, tmp_path):
    from lodestrata.llm.queries import QUERIES

    r = random.Random(12)
    common = quality.COMMON_WORDS["es"].split()
    prose = lambda n: " ".join(r.choice(common) if r.random() < 0.45 else r.choice(["piedra", "mesa,", "Casa", "tarde.", "claro"]) + "aeiou"[r.randrange(5)] for _ in range(n))
    table = " ".join(str(r.randrange(10**6)) for _ in range(2_000))
    rows = [(i, prose(r.randint(200, 400))) for i in range(60)] + [(100 + i, table) for i in range(30)] + [(200, " ".join(str(r.randrange(10**6)) for _ in range(20_000)))]
    spark.createDataFrame([(*x, "es") for x in rows], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["doc_id"]: x["kept"] for x in QUERIES["op9_quality"](spark, str(tmp_path)).collect()}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in got if i >= 100)


def test_shares_of_distinct_texts_against_python(spark):
    rows = [("a1 B", "en"), ("a1 B", "en"), ("a" * 3 + "7" * 97, "en"), ("", "en"), (None, "en"), ("the x", "de")]
    got = {x["language"]: x for x in quality.references(spark.createDataFrame(rows, "text string, lang string"), each_text_once=True).collect()}
    # upper, digit, symbol, mark, blank, other
    want = [0.25, 0.25 + 0.97, 0, 0, 0.25, 0.25 + 0.03]
    assert all(abs(a / 2**32 - b) < 1e-9 for a, b in zip(got["en"]["classes_all"], want))
    assert sum(got["en"]["common_all"]) == 2 * 2**32 and sum(got["de"]["classes_all"]) == 2**32


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
