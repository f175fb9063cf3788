"""Quality rules: counts of words, symbols and repeats, and divergence from the language's own texts.

All of it is column expressions. A document's character classes and common words are held against
the pooled histograms of the documents of its language with the Jensen-Shannon distance (the root of
the divergence to base 2, from 0 to 1).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.session import scratch_path

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

# Frequent function words by language code.
COMMON_WORDS = {
    "en": "the of and to in is that for it with be by on are this from",
    "de": "der die und den von zu das mit sich des auf ist im nicht ein eine",
    "fr": "de la le les et des en un une du pour que dans est sur pas",
    "es": "de la que el en los se del las un por con una para es no",
    "it": "di e il la che in un per del una con non della si le da",
    "pt": "de a o que e do da em um para com os no uma na por",
    "nl": "de van het een en in is dat op te met voor niet zijn aan er",
}
# The character classes that are counted by pattern; blanks and the rest follow.
CLASSES = {"upper": "\\p{Lu}", "digit": "\\p{Nd}", "symbol": SYMBOLS, "mark": "[\\p{P}\\p{S}&&[^#*$%&|<>]]"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _window_hashes(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def _covered(hashes: Column) -> Column:
    """Words in the windows whose hash occurs twice or more: sort with positions, keep equal neighbours, add up."""

    def positions(s: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
        kept = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(kept, lambda i: F.get(s, i)["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        let(ordered, positions),
        start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p + WINDOW - a["end"])).alias("n"), (p + WINDOW).alias("end")),
        lambda a: a["n"],
    )


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight found twice or more in the text, the first one included."""
    counted = let(_window_hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(counted).cast("long")


def _word_counts(words: Column, lang: Column) -> Column:
    """How often each common word of the language occurs as it stands, and all other words; none if the language has no list."""
    lists = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())))])

    def counts(common: Column) -> Column:
        each = F.transform(common, lambda c: (F.size(words) - F.size(F.array_remove(words, c))).cast("double"))
        return let(each, lambda e: F.concat(e, F.array(F.size(words) - F.aggregate(e, F.lit(0.0), lambda a, b: a + b))))

    return F.when(lang.isin(*COMMON_WORDS), let(F.element_at(lists, lang), counts))


def _class_counts(text: Column, words: Column) -> Column:
    """Counts of the named character classes, then of blanks, then of all other characters."""
    body = F.coalesce(text, F.lit(""))

    def complete(counts: Column) -> Column:
        named = F.aggregate(counts, F.lit(0), lambda a, b: a + b)
        return let(F.length(F.array_join(words, "")), lambda inside: F.concat(counts, F.array(F.length(body) - inside, inside - named)))

    return F.transform(let(F.array(*[F.regexp_count(body, F.lit(p)) for p in CLASSES.values()]), complete), lambda x: x.cast("double"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", each_text_once: bool = False) -> DataFrame:
    """(language, classes_all, common_all): both histograms added up over all documents of a language.

    With ``each_text_once`` every distinct text adds its shares instead of its counts, so that it
    weighs 1, however long or often copied; shares are added in units of 2 ** -32, in whole numbers,
    so that the sum does not depend on the order.
    """
    both = let(words_of(F.col(text)), lambda w: F.struct(_class_counts(F.col(text), w).alias("classes"), _word_counts(w, F.col(lang)).alias("common")))
    copy = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    found = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("language"), copy.alias("copy"), both.alias("h"))
    places = {"classes": len(CLASSES) + 2, "common": 1 + max(len(v.split()) for v in COMMON_WORDS.values())}
    names = [f"{k}{i}" for k, n in places.items() for i in range(n)]
    if each_text_once:
        shares = found.select("language", "copy", F.struct(*[_share(F.col(f"h.{k}")).alias(k) for k in places]).alias("h"))
        units = [F.round(F.get(F.col(f"h.{k}"), F.lit(i)) * (1 << 32)).cast("long").alias(f"{k}{i}") for k, n in places.items() for i in range(n)]
        placed = shares.select("language", "copy", *units).groupBy("language", "copy").agg(*[F.max(c).alias(c) for c in names])
    else:
        placed = found.select("language", *[F.get(F.col(f"h.{k}"), F.lit(i)).alias(f"{k}{i}") for k, n in places.items() for i in range(n)])
    sums = [F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in names]
    return placed.groupBy("language").agg(*sums).select("language", *[F.array(*[f"{k}{i}" for i in range(n)]).alias(f"{k}_all") for k, n in places.items()])


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def _share(x: Column) -> Column:
    """A histogram's parts of its total; null if that is 0."""
    return let(_total(x), lambda n: F.when(n > 0, F.transform(x, lambda v: v / n)))


def _divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms; null if either is empty."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    def term(u: Column, v: Column) -> Column:
        u, v = F.coalesce(u, F.lit(0.0)), F.coalesce(v, F.lit(0.0))
        return part(u, (u + v) / 2) + part(v, (u + v) / 2)

    terms = lambda a, b: let(_share(a), lambda s: let(_share(b), lambda t: F.zip_with(s, t, term)))
    return F.sqrt(let(let(p, lambda a: let(q, lambda b: _total(terms(a, b)))), lambda d: F.when(d < 0, F.lit(0.0)).otherwise(d / 2)))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_class_distance: float = 0.28,
    max_word_distance: float = 0.26,
    min_chars: int = 400,
    min_words: int = 100,
    each_text_once: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with its counts, distances and verdict.

    The references are those of all documents of a language, by characters and words; with
    ``each_text_once`` every distinct text weighs the same, so that neither copies nor very long texts
    move them. The distance of character classes
    counts from ``min_chars`` characters on, that of common words from ``min_words`` words on and
    for languages with a list; below that, and for a null language, the method keeps. Null and
    empty texts have no words and fail the base rule. Repeated rows are judged each, an empty table
    gives no rows, columns called like the results are replaced and others pass unchanged. At the
    default thresholds ordinary prose of a hundred words or more stays well below both distances.
    """
    carried = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(F.struct(*[F.col(c) for c in carried]).alias("row"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    # Written first, the references have a size Spark knows: below its threshold no text is shuffled.
    path = scratch_path(docs.sparkSession, "references")
    references(docs, text, lang, each_text_once).coalesce(1).write.parquet(path)
    joined = rows.join(docs.sparkSession.read.parquet(path), F.col("lang") == F.col("language"), "left")

    def measured(words: Column) -> Column:
        long_text, long_words = F.length("text") >= min_chars, F.size(words) >= min_words
        return let(
            _class_counts(F.col("text"), words),
            lambda classes: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.get(classes, F.lit(list(CLASSES).index("symbol"))).cast("long").alias("n_symbols"),
                repeated_words(words).alias("n_repeat_words"),
                F.when(long_text, _divergence(classes, F.col("classes_all"))).alias("class_distance"),
                F.when(long_words, _divergence(_word_counts(words, F.col("lang")), F.col("common_all"))).alias("word_distance"),
            ),
        )

    found = joined.select("row", let(words_of(F.col("text")), measured).alias("m"), repeated_lines(F.col("text")).alias("n_dup_lines"))
    failed = (F.col("m.n_words") < 20) | (100 * F.col("m.n_repeat_words") > 30 * F.col("m.n_words"))
    strange = F.coalesce(F.col("m.class_distance") > max_class_distance, F.lit(False)) | F.coalesce(F.col("m.word_distance") > max_word_distance, F.lit(False))
    return found.select(
        *[F.col("row")[c].alias(c) for c in carried],
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        "n_dup_lines",
        "m.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~strange).alias("kept"),
        "m.class_distance",
        "m.word_distance",
    )
