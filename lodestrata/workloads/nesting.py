"""Nested records, JSON, XML and delimited text inside columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import array_difference as difference
from ..functions.scalar import delimited_record, join_broken_fields, xml_record
from ..operators.batches import add_column_in_batches
from ..operators.columns import LOAD_COLUMN
from ..operators.nested import relationalize
from ..plans.loads import load_flattened
from ..session import scratch_path
from ..sources.readers import parse_arrivals
from . import table, workload


def _nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of lines, each line a record of words."""
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.length(line).alias("n_chars"), F.split(line, " ").alias("words"))
    )
    about = F.struct("lang", "source", F.col("n_chars").alias("size"))
    return table(spark, sf_dir, "documents").select("doc_id", about.alias("about"), lines.alias("lines"))


_LINES_SQL = r"""
  lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
"""


@workload(
    """
    SELECT doc_id, lang AS about_lang, source AS about_source, n_chars AS about_size, CAST(doc_id AS VARCHAR) AS lines FROM documents
    """
)
def relationalize_root(spark, sf_dir):
    return relationalize(_nested_documents(spark, sf_dir), keys=["doc_id"])["root"]


@workload(
    f"""
    WITH {_LINES_SQL}
    SELECT CAST(doc_id AS VARCHAR) AS id, CAST(i AS INTEGER) AS index, CAST(length(line) AS INTEGER) AS lines_val_n_chars,
           CAST(doc_id AS VARCHAR) || '.' || CAST(i AS VARCHAR) AS lines_val_words FROM lines
    """
)
def relationalize_child(spark, sf_dir):
    return relationalize(_nested_documents(spark, sf_dir), keys=["doc_id"])["root_lines"]


@workload(
    f"""
    WITH {_LINES_SQL},
    words AS (SELECT doc_id, i, unnest(string_split(line, ' ')) AS word, unnest(range(len(string_split(line, ' ')))) AS j FROM lines)
    SELECT CAST(doc_id AS VARCHAR) || '.' || CAST(i AS VARCHAR) AS id, CAST(j AS INTEGER) AS index, word AS lines_val_words_val FROM words
    """
)
def relationalize_grandchild(spark, sf_dir):
    return relationalize(_nested_documents(spark, sf_dir), keys=["doc_id"])["root_lines_val_words"]


@workload(
    f"""
    WITH {_LINES_SQL}
    SELECT doc_id, count(*) AS n_lines, max(CAST(length(line) AS INTEGER)) AS longest FROM lines GROUP BY doc_id
    """
)
def relationalize_staged(spark, sf_dir):
    """Without keys: records are numbered and written once, and the tables joined on the links."""
    tables = relationalize(_nested_documents(spark, sf_dir), staging_path=scratch_path(spark, "relationalize"))
    lines = tables["root_lines"].groupBy("id").agg(F.count(F.lit(1)).alias("n_lines"), F.max("lines_val_n_chars").alias("longest"))
    return tables["root"].join(lines, F.col("lines") == F.col("id")).select("doc_id", "n_lines", "longest")


@workload(
    f"""
    WITH {_LINES_SQL}
    SELECT CAST(doc_id AS VARCHAR) AS id, CAST(i AS INTEGER) AS index, CAST(length(line) AS INTEGER) AS lines_val_n_chars,
           'documents' AS audit_data_source, '20261201_000000' AS load_stamp FROM lines
    """
)
def flattened_load(spark, sf_dir):
    path = f"{scratch_path(spark, 'flattened')}/documents"
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    load_flattened(_nested_documents(spark, sf_dir), path, "20261201_000000", at, "loader", "documents", keys=["doc_id"])
    landed = spark.read.parquet(f"{path}_root_lines")
    return landed.select("id", "index", "lines_val_n_chars", "audit_data_source", F.col(LOAD_COLUMN).cast("string").alias("load_stamp"))


@workload("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select("event_id", "user_id", F.from_json("props", "k int").alias("data"))
    return parsed.select("event_id", "user_id", "data.*")


@workload(
    """
    SELECT source AS bucket, lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS key, n_chars * 200 AS size, 'r' || CAST(doc_id AS VARCHAR) AS receipt
    FROM documents
    UNION ALL SELECT source, lang || '/' || CAST(doc_id AS VARCHAR) || '.json', n_chars, 'r' || CAST(doc_id AS VARCHAR) FROM documents
    """
)
def message_events(spark, sf_dir):
    """Each message announces two files."""

    def record(ending, size):
        key = F.concat("lang", F.lit("/"), "doc_id", F.lit(ending))
        detail = F.struct(F.struct(F.col("source").alias("name")).alias("bucket"), F.struct(key.alias("key"), size.alias("size")).alias("object"))
        return F.struct(F.to_json(F.struct(detail.alias("detail"))).alias("body"), F.concat(F.lit("r"), "doc_id").alias("receiptHandle"))

    records = F.array(record(".txt", F.col("n_chars") * 200), record(".json", F.col("n_chars")))
    return parse_arrivals(table(spark, sf_dir, "documents").select(F.to_json(F.struct(records.alias("Records"))).alias("message")))


@workload(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer
    """
)
def xml_records(spark, sf_dir):
    segment = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("<segment>"), "c_mktsegment", F.lit("</segment>"))).otherwise("<segment/>")
    raw = F.concat(F.lit("<a><id>"), F.col("c_custkey"), F.lit("</id><name>"), "c_name", F.lit("</name>"), segment, F.lit("</a>"))
    rows = table(spark, sf_dir, "customer").select(raw.alias("raw"))
    return rows.select(xml_record("raw", ["id", "name", "segment"]).alias("r")).select("r.*")


@workload(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS id, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS name,
           CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS sal, CAST(o_orderdate AS DATE) AS dt FROM orders
    """
)
def delimited_records(spark, sf_dir):
    fields = [
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).otherwise(""),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice").cast("string")).otherwise("unknown"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    ]
    raw = F.encode(F.concat(F.concat_ws(",", *fields), F.lit("\n")), "UTF-8")
    schema = T.StructType.fromDDL("id int, name string, sal double, dt date")
    rows = table(spark, sf_dir, "orders").select(raw.alias("raw"))
    return rows.select(delimited_record("raw", schema, charset="UTF-8").alias("r")).select("r.*")


@workload(
    r"""
    SELECT doc_id, regexp_replace(regexp_replace(text, '\n,', ',', 'g'), ',\n', ',', 'g') AS text FROM documents
    """
)
def broken_fields(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", join_broken_fields("text").alias("text"))


@workload(
    """
    SELECT a.vec_id, list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) AS difference
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
    """
)
def array_difference(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return vectors.join(following, "vec_id").select("vec_id", difference("embedding", "next").alias("difference"))


def _without_accents(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


@workload("SELECT doc_id, strip_accents(text) AS plain FROM documents")
def map_in_batches(spark, sf_dir):
    """Unicode decomposition, for which there is no built-in expression."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return add_column_in_batches(docs, "plain", T.StringType(), lambda batch: batch["text"].map(_without_accents), needs=["text"]).drop("text")
