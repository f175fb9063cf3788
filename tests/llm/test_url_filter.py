import re

import pytest

from lodestrata.llm import url_filter

URLS = [
    None, "", "no-scheme", "http://", "https://Example.NET", "https://example.net/", "https://a.Example.net/en/x?q#f", "https://example.net/en", "https://badexample.net/en/",
    "http://example.com/de/1#x", "http://m.example.com/de", "http://x.org/fr/", "http://org/fr/a", "http://x.org/en/fr/", "http://u@h.test:80/p?a://b", "//x://y.net/z",
    "http://x.net?/a", "http://x.net#/a", "ÀB://ÀZ.net/ü\n/b?c",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_parts_and_rules(spark, model):
    rows = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(URLS + URLS[:6])], "page_id long, url string, host string, grams string").repartition(2)
    got = {r["page_id"]: r for r in url_filter.judge_urls(rows, model).collect()}
    assert len(got) == len(URLS) + 6
    for i, url in enumerate(URLS + URLS[:6]):
        host, path = parts(url)
        name, verdict = rule(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["grams"]) == (host, path, name, "x")
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))
    assert url_filter.judge_urls(rows.limit(0), model).count() == 0


def test_unseen_hosts(spark, model):
    unwanted = ["https://www.casino-win.test/en/1", "http://m.cheap-pills.test/en/2?x", "https://free-bets.test/", "https://spam-farm.test/de/9", "http://blog.ads-track.test/en/1", "https://adult-x.test/es/4"]
    ordinary = ["https://theron.test/en/1", "http://blog.tionble.test/fr/2", "https://m.ththing.test/en/31492.html", "https://observatory.test/", "https://www.gardening-today.test/roses"]
    rows = spark.createDataFrame([(u,) for u in unwanted + ordinary], "url string")
    got = {r["url"]: r["verdict"] for r in url_filter.judge_urls(rows, model, rules=()).collect()}
    assert got == {**dict.fromkeys(unwanted, "block"), **dict.fromkeys(ordinary, "allow")}


def test_held_out_labels(spark):
    labelled = url_filter.labelled_urls(spark).toPandas().sample(frac=1, random_state=1)
    cut = len(labelled) * 3 // 4
    model = url_filter.train(spark.createDataFrame(labelled[:cut]))
    rest = url_filter.judge_urls(spark.createDataFrame(labelled[cut:]), model, rules=()).toPandas()
    assert ((rest["verdict"] == "block") == (rest["label"] == 1)).mean() >= 0.8


def test_bounds_of_the_labelled_table(spark):
    with pytest.raises(ValueError):
        url_filter.train(spark.createDataFrame([(None, 1)], "url string, label int"))
    with pytest.raises(ValueError):
        url_filter.train(spark.range(url_filter.MOST_LABELLED + 1).selectExpr("'http://a.test' AS url", "id % 2 AS label"))


def test_after_an_observation(spark):
    """A session that has observed something cannot be sent to tasks, so the model must not hold it."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    model = url_filter.train(url_filter.labelled_urls(spark))
    assert url_filter.judge_urls(spark.createDataFrame([(1, "http://a.test/")], "page_id long, url string"), model).count() == 1


def test_scores_against_a_regression_written_out(spark, model):
    """The same hashed n-grams and coefficients, added up in Python."""
    import math

    from pyspark.ml.feature import HashingTF

    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    hashing = HashingTF(**url_filter._HASHING)
    for r in url_filter.judge_urls(rows, model).collect():
        grams = set()
        for kind, framed in (("h:", f"^{r['host']}$"), ("p:", f"^{r['path']}$")):
            for n in url_filter.SIZES:
                grams |= {kind + framed[i : i + n] for i in range(len(framed) - n + 1)}
        odds = model.intercept + sum(model.coefficients[i] for i in {hashing.indexOf(g) for g in grams})
        assert abs(r["score"] - 1 / (1 + math.exp(-odds))) < 1e-9
        assert r["rule"] or r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")
