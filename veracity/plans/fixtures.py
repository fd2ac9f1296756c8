"""Mappings from the driver tables to the reference's data model.

Each fixture is a DataFrame derived by Spark from the whole tables, and each
has a DuckDB SQL twin in :data:`SQL` (used by the oracle strings):

* text table   = ``documents``; ``label`` = ``labels.quality`` (1 real, 0 fake);
* URL-bearing text = document text plus the page URL with the same id;
* score        = first 8 hex digits of ``md5(salt:id)`` / 2^32 (a stand-in
  model score, exact in both engines);
* annotation   = misinformation = 1 - quality, true = quality * (1 - toxic),
  non-rumour = ``lang <> 'en'``;
* snapshot     = one file per day of ``events.ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.functions.common import snapshot_file_name, unit_hash
from veracity.sources.files import read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Whole driver table."""
    return read_table(spark, f"{d.rstrip('/')}/{name}.parquet")


def documents(spark, d):
    return table(spark, d, "documents")


def labelled(spark, d) -> DataFrame:
    docs = documents(spark, d)
    lab = table(spark, d, "labels")
    return docs.join(lab, "doc_id").select(
        "doc_id", "text", "lang", "source", F.col("quality").alias("label"), "toxic")


def url_texts(spark, d) -> DataFrame:
    docs = documents(spark, d)
    pages = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return docs.join(pages, "doc_id", "left").select(
        "doc_id", F.concat_ws(" ", "text", "url").alias("text"), "lang", "source")


def mixed_score(label_col="label", salt="score"):
    return F.lit(0.6) * unit_hash("doc_id", salt) + F.lit(0.4) * F.col(label_col)


def scored_labelled(spark, d) -> DataFrame:
    """Labelled documents with a label-correlated score."""
    return labelled(spark, d).withColumn("score", mixed_score())


def tied_labelled(spark, d) -> DataFrame:
    """Same, rounded to two digits so that scores tie across classes."""
    return labelled(spark, d).withColumn("score", F.round(mixed_score(), 2))


def reference_scores(spark, d) -> DataFrame:
    return labelled(spark, d).select("doc_id", unit_hash("doc_id", "ref").alias("score"))


def new_scores(spark, d) -> DataFrame:
    h = unit_hash("doc_id", "new")
    return documents(spark, d).select("doc_id", "text", "source", (h * h).alias("score"))


def model_scores(spark, d) -> DataFrame:
    """Long ``(model, doc_id, label, score)`` table for three candidate models."""
    lab = labelled(spark, d)
    return (
        lab.select(F.lit("hash").alias("model"), "doc_id", "label", unit_hash("doc_id", "hash").alias("score"))
        .unionByName(lab.select(F.lit("mixed").alias("model"), "doc_id", "label", mixed_score().alias("score")))
        .unionByName(lab.select(F.lit("tied").alias("model"), "doc_id", "label", F.round(mixed_score(), 2).alias("score")))
    )


def snapshots(spark, d) -> DataFrame:
    """Events as scraped snapshots: one file per day, mtime = last row time."""
    ev = table(spark, d, "events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        snapshot_file_name(F.date_trunc("day", "ts")).alias("file"),
    )


# --- DuckDB twins ---------------------------------------------------------------
def sql_hash(id_expr: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || CAST({id_expr} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def sql_hash32(id_expr: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || CAST({id_expr} AS VARCHAR)), 1, 8))::BIGINT)"


MIXED_SQL = f"(0.6::DOUBLE * {sql_hash('doc_id', 'score')} + 0.4::DOUBLE * label)"

SQL = {
    "labelled": "SELECT d.doc_id, d.text, d.lang, d.source, l.quality AS label, l.toxic "
                "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "url_texts": "SELECT d.doc_id, concat_ws(' ', d.text, p.url) AS text, d.lang, d.source "
                 "FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id",
}
SQL["scored"] = f"SELECT *, {MIXED_SQL} AS score FROM ({SQL['labelled']})"
SQL["tied"] = f"SELECT *, round({MIXED_SQL}, 2) AS score FROM ({SQL['labelled']})"
SQL["ref"] = f"SELECT doc_id, {sql_hash('doc_id', 'ref')} AS score FROM ({SQL['labelled']})"
SQL["new"] = (f"SELECT doc_id, text, source, {sql_hash('doc_id', 'new')} * {sql_hash('doc_id', 'new')} AS score "
              f"FROM documents")
SQL["models"] = (
    f"SELECT 'hash' AS model, doc_id, label, {sql_hash('doc_id', 'hash')} AS score FROM ({SQL['labelled']}) "
    f"UNION ALL SELECT 'mixed', doc_id, label, {MIXED_SQL} FROM ({SQL['labelled']}) "
    f"UNION ALL SELECT 'tied', doc_id, label, round({MIXED_SQL}, 2) FROM ({SQL['labelled']})"
)
SQL["snapshots"] = ("SELECT event_id, ts, user_id, event_type, value, props, "
                    "'news_' || strftime(date_trunc('day', ts), '%Y%m%d_%H%M') || '.csv' AS file FROM events")
