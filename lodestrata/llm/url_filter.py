"""URL filter: list rules first, then logistic regression on hashed character n-grams of host and path.

N-grams, hashing, rules and scores are column expressions and the DataFrame API's transformers; no
Python runs on the executors. The labelled table is small by contract, and its size is checked.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

from .quality import let

SIZES = (3, 4, 5)
MOST_LABELLED = 2000

#: the rules of the registered query: verdict, host and path
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# Words of the built-in labelled table's hosts.
UNWANTED = "casino slots poker bets betting jackpot lottery pills pharma meds viagra replica loans payday spam ads adserver popup clicks adult xxx porn cams escort bingo"
ORDINARY = (
    "news library school weather recipes physics kernel travel bakery council hospital opera station river mountain photos music theory thought action mothers "
    "father another together nothing reading course address window freedom charity alphabet sciences thread tension nation motion portion caution potion garden museum"
)
PARTNERS = "win royal online live free cheap shop best play farm server links track store world club today home"
PLACES = ("/", "/en/1", "/de/17.html", "/fr/853/", "/es/31492?ref=x", "/en/7645#top", "/about", "/page/2")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: (url, label), 1 for unwanted.

    Each word makes hosts alone, and before and after words that sites of both kinds have.
    """
    partners, fronts, ends, rows = PARTNERS.split(), ("", "www.", "m.", "blog."), ("com", "org", "net", "test"), []
    for label, words in ((1, UNWANTED.split()), (0, ORDINARY.split())):
        for i, word in enumerate(words):
            others = [partners[(5 * i + 7 * k) % len(partners)] for k in range(4)]
            names = [word, word, *(f"{word}-{p}" for p in others[:2]), *(f"{p}-{word}" for p in others[2:]), f"{word}{others[0]}", f"{others[1]}{word}"]
            rows += [{"url": f"https://{fronts[(i + k) % 4]}{n}.{ends[(i + k // 4) % 4]}{PLACES[(i + 3 * k) % 8]}", "label": label} for k, n in enumerate(names)]
    return spark.sql(f"SELECT inline(from_json('{json.dumps(rows)}', 'array<struct<url:string,label:int>>'))")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty for null and without ``://``."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), letters, letters.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def ngrams(host: Column, path: Column) -> Column:
    """The distinct n-grams; host and path have n-grams of their own, with both ends marked."""

    def grams(text: Column, kind: str, n: int) -> Column:
        pieces = lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.concat(F.lit(kind), F.substr(t, i, F.lit(n))))
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        return let(framed, lambda t: F.when(F.length(t) >= n, pieces(t)).otherwise(F.array().cast("array<string>")))

    return F.array_distinct(F.concat(*[grams(x, kind, n) for x, kind in ((host, "h:"), (path, "p:")) for n in SIZES]))


_HASHING = {"inputCol": "grams", "outputCol": "features", "numFeatures": 1 << 14, "binary": True}


def _features(rows: DataFrame, url: str) -> DataFrame:
    found = rows.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    return HashingTF(**_HASHING).transform(found.withColumn("grams", ngrams(F.col("host"), F.col("path")))).drop("grams")


def train(labelled: DataFrame, url: str = "url", label: str = "label", decay: float = 0.01) -> LogisticRegressionModel:
    """A regression on the n-grams of a labelled table of at most ``MOST_LABELLED`` rows.

    Rows with a null url or label are left out. More rows, or none, are an error.
    """
    clean = labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
    if not 0 < clean.count() <= MOST_LABELLED:
        raise ValueError(f"between 1 and {MOST_LABELLED} labelled rows are trained on")
    fitted = LogisticRegression(regParam=decay, maxIter=100, standardization=False).fit(_features(clean, "url"))
    # The fitted model keeps its summary, and with it the session, which tasks cannot be sent; a stored one does not.
    path = scratch_path(labelled.sparkSession, "url-model")
    fitted.save(path)
    return LogisticRegressionModel.load(path)


def judge_urls(
    pages: DataFrame, model: LogisticRegressionModel, rules: tuple[tuple[str, str, str], ...] = RULES, url: str = "url", threshold: float = 0.5
) -> DataFrame:
    """Every row with host, path, rule, verdict and score; columns of these names are replaced.

    A rule (verdict, host, path) fits its host and all subdomains if the path begins with the
    rule's; the longest decides. Without one the model does: block from ``threshold`` on. Null urls
    and urls without ``://`` have an empty host and path and are scored like others. Rules are a
    list by hand, held against each row; repeated rows are judged each, an empty table gives none.
    """
    carried = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    inner = pages.select(F.struct(*[F.col(c) for c in carried]).alias("row"), F.col(url).alias("_url"))
    scored = model.transform(_features(inner, "_url")).withColumn("score", vector_to_array("probability")[1])

    def fits(verdict: str, host: str, path: str) -> Column:
        found = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        return F.when(found, F.struct(F.lit(len(host + path)).alias("n"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict")))

    best = F.array_max(F.array(*[fits(*r) for r in rules])) if rules else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    judged = scored.withColumn("best", best)
    guess = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return judged.select(*[F.col("row")[c].alias(c) for c in carried], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", guess).alias("verdict"), "score")
