"""A training corpus from the documents table, in five stages.

Quality rules, near-duplicate removal, removal of repeated passages, benchmark decontamination and
tokenization. Each stage gets what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, minhash_dedup, quality, sentencepiece_codec, suffix_dedup
from lodestrata.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), "text", "lang")
    return quality.judge(rows, each_text_once=True).where("kept").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least doc_id."""
    return minhash_dedup.survivors(spark, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of 200 bytes that occur elsewhere too."""
    cut = suffix_dedup.remove_repeats(spark, docs, returns=["kept_text"])
    found = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[found.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window like a benchmark item."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("node"), "text")
    leaks = decontaminate.find_leaks(rows.select("node", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="node")
    return rows.join(leaks.select("node").distinct(), "node", "left_anti").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, in place of its text."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return sentencepiece_codec.encode_texts(docs, f.read())


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding", tokenize),
]

#: The stages hash, sample registers and merge pieces, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"corpus-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
