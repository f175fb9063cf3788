"""Registered queries: each operator over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import collocations, decontaminate, html_text, minhash_dedup, quality, sentencepiece_codec, sharding, suffix_dedup, token_files, toxicity, url_filter, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer_file(name: str) -> bytes:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query()
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_pages(spark, _table(spark, sf_dir, "pages"))
    return warc.read_pages(archives, with_payload=False).drop("url")


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_texts(docs, _tokenizer_file("piece_bpe_32k.model"))


@query()
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), model).drop("url")


@query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query()
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"), keep=["doc_id"])


@query()
def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_rows")


@query()
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return token_files.count_documents(spark, docs, _tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, separator=50256)


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), each_text_once=True).select("doc_id", *quality.RESULTS)


@query()
def op10_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_texts(spark, _table(spark, sf_dir, "documents"))


_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counted AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, range(1, 6) AS t(k))
  GROUP BY lang, k, phrase),
sizes AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= 100),
longest AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, unnest([array_to_string(w[:k - 1], ' '), array_to_string(w[2:], ' ')]) AS part FROM frequent WHERE k >= 3)
  GROUP BY lang, part),
candidates AS (
  SELECT c.* FROM frequent AS c LEFT JOIN longest AS o ON o.lang = c.lang AND o.part = c.phrase
  WHERE c.k >= 2 AND (o.f IS NULL OR 100 * o.f < 100 * c.f)),
cuts AS (SELECT lang, phrase, f, w, k, unnest(range(1, k)) AS c FROM candidates),
scored AS (
  SELECT u.lang, u.phrase, u.f AS a, u.c, x.f AS l, y.f AS r, s.n, (1000::HUGEINT * u.f * s.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts AS u JOIN sizes AS s ON s.lang = u.lang
  JOIN frequent AS x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[:u.c], ' ')
  JOIN frequent AS y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.c + 1:], ' ')),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
  FROM least WHERE place = 1)
WHERE rank <= 2000
"""


@query(_PHRASES)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(spark, docs).drop("words")


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, _table(spark, sf_dir, "embeddings")).drop("deviation_exact")


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
