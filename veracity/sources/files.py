"""File sources and sinks.

* S1 ``read_csv_by_header`` - CSV bound by each file's header, with doubled-quote escaping, pandas NA sentinels
  and rejected records; ``read_news_csv`` gives the accepted ones.
* S2 ``read_snapshots``     - a landing directory of ``news_*.csv`` files with file lineage, by the same reader.
* S4 ``read_threads``       - the annotated thread tree in one recursive whole-text read.
* S5 ``write_table``        - Parquet/CSV table sink.
* S6 ``write_report``       - JSON report sink for tiny aggregates.
* S7 ``save/load_reference``- reference score distribution as ``(score, n)`` counts.
* S8 ``save/load_model``    - fitted linear models.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.common import json_int, json_text, snapshot_time_from_name
from veracity.functions.text import canonical_null, event_name, normalise_tweet
from veracity.operators.prepare import thread_label

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("source", T.StringType()),
])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- S1 ----------------------------------------------------------------------------
#: What a row's file brought that couldn't be read, and why: the names of these columns.
RECORD, REASON = "record", "reason"
#: Different headers among the files of one read; each is a scan of its own.
MAX_HEADERS = 64
_HEADER_BYTES = 1 << 20


def file_headers(spark: SparkSession, path: str, glob: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """Column names as the files give them, each with the files that begin so.

    The first line of a file is the first row of its first split, which one
    task reads in order; a row a file reaches the driver, as its name does."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    firsts = lines.filter("start = 0").groupBy("file").agg(F.first(F.substring("value", 1, _HEADER_BYTES)).alias("header")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for r in firsts:
        names = next(csv.reader([r.header.lstrip("\ufeff").rstrip("\r")]), [])
        out.setdefault(tuple(n.strip() for n in names), []).append(r.file)
    return out


def read_csv_by_header(spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT_SCHEMA, glob: str | None = None,
                       multiline: bool = False, null_sentinels: bool = True) -> DataFrame:
    """The columns of ``schema`` by the names in each file's header, whatever their order, with ``file``,
    ``mtime``, and for records that can't be read ``record`` and ``reason``.

    ``"`` quotes and escapes (doubled quotes), pandas NA sentinels are null in
    string columns. A column that a file lacks is null, others it has are left
    out, and of columns of one name the first counts. A record is rejected
    if it has more or fewer fields than its header (``fields``) or a value
    that isn't of the column's type (``value``); it is kept as a row with
    its text, all columns null. Files without a line have no rows. ``multiline``
    handles quoted newlines but makes each file one split."""
    headers = {h: files for h, files in file_headers(spark, path, glob).items() if any(h)}
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"{len(headers)} different headers under {path}")
    kinds = {f.name: f.dataType for f in schema.fields}
    out = [F.col("file"), F.col("mtime"), F.col(RECORD), F.col(REASON)]
    parts = []
    for header, files in sorted(headers.items()):
        names = [n if n in kinds and n not in header[:i] else f"__{i}" for i, n in enumerate(header)]
        own = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names] + [T.StructField("__bad", T.StringType())])
        rows = (spark.read.schema(own).option("header", True).option("enforceSchema", True).option("quote", '"').option("escape", '"')
                .option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad")
                .option("columnPruning", False).csv(files))  # a record is bad or not whichever columns are asked for
        # a value is converted, and found bad, only if its column is asked for: so all are; this part is always true
        bad = F.col("__bad").isNotNull() & (F.length(F.concat_ws("", *[F.col(n).cast("string") for n in names])) >= 0)
        # commas outside quotes part fields; a doubled quote ends one quoted part and begins the next
        fields = F.length(F.regexp_replace(F.regexp_replace("__bad", '"[^"]*"', ""), "[^,]", "")) + 1
        values = []
        for name, kind in kinds.items():
            value = F.col(name) if name in names else F.lit(None).cast(kind)
            if null_sentinels and isinstance(kind, T.StringType):
                value = canonical_null(value)
            values.append(F.when(~bad, value).cast(kind).alias(name))
        parts.append(rows.select(
            *values, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("mtime"),
            F.col("__bad").alias(RECORD), F.when(bad, F.when(fields == len(header), "value").otherwise("fields")).alias(REASON)))
    if not parts:
        empty = T.StructType([*schema.fields, T.StructField("file", T.StringType()), T.StructField("mtime", T.TimestampType()),
                              T.StructField(RECORD, T.StringType()), T.StructField(REASON, T.StringType())])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts).select(*[f.name for f in schema.fields], *out)


def accepted(rows: DataFrame) -> DataFrame:
    """The records of :func:`read_csv_by_header` that could be read."""
    return rows.filter(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """``file, record, reason`` of the others."""
    return rows.filter(F.col(REASON).isNotNull()).select("file", RECORD, REASON)


def read_news_csv(spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT_SCHEMA,
                  multiline: bool = False, null_sentinels: bool = True) -> DataFrame:
    """The records of a file or folder that could be read, the columns of ``schema`` alone."""
    return accepted(read_csv_by_header(spark, path, schema, None, multiline, null_sentinels)).drop("file", "mtime")


# --- S2 ----------------------------------------------------------------------------
def read_snapshots(spark: SparkSession, directory: str, schema: T.StructType = SNAPSHOT_SCHEMA,
                   glob: str = "*.csv", exclude: Sequence[str] = ("all_tweets.csv",)) -> DataFrame:
    """Every snapshot file of a landing directory with its name,
    modification time and the snapshot time parsed from the name."""
    df = accepted(read_csv_by_header(spark, directory, schema, glob))
    if exclude:
        df = df.filter(~F.col("file").isin(list(exclude)))
    return df.withColumn("snapshot_time", snapshot_time_from_name("file"))


# --- S4 ----------------------------------------------------------------------------
_PATH = r"/([^/]+)/(rumours|non-rumours)/([^/]+)/(annotation\.json|source-tweets/[^/]+\.json)$"


def read_threads(spark: SparkSession, root: str) -> DataFrame:
    """S4 + J2 + P8 + F3: ``(text, label, event, thread_id)`` from the
    extracted thread tree ``<event>-all-rnr-threads/{rumours,non-rumours}/
    <thread>/{annotation.json, source-tweets/*.json}``.

    One recursive whole-text read replaces the driver-side directory walk;
    path parts come from ``_metadata.file_path``. Unreadable JSON, empty text
    and unverified or unannotated rumours are dropped."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True) \
        .option("pathGlobFilter", "*.json").text(root)
    p = F.col("_metadata.file_path")
    files = raw.select(
        F.col("value"),
        event_name(F.regexp_extract(p, _PATH, 1)).alias("event"),
        F.regexp_extract(p, _PATH, 2).alias("kind"),
        F.regexp_extract(p, _PATH, 3).alias("thread_id"),
        F.regexp_extract(p, _PATH, 4).alias("leaf"),
    ).filter(F.col("kind") != "")
    ann = files.filter(F.col("leaf") == "annotation.json").select(
        "event", "thread_id",
        json_int("value", "misinformation").alias("misinformation"),
        json_int("value", "true").alias("true"),
        F.lit(True).alias("has_ann"),
    )
    posts = files.filter(F.col("leaf") != "annotation.json").select(
        "event", "thread_id", (F.col("kind") == "rumours").alias("is_rumour"),
        json_text("value", "text").alias("text"),
    ).filter(F.col("text").isNotNull() & (F.col("text") != ""))
    j = posts.join(ann, ["event", "thread_id"], "left")
    # json_int already maps absent keys to 0 and broken documents to null
    lab = F.when(~F.col("is_rumour"), F.lit(1)).when(
        F.col("has_ann").isNull() | F.col("misinformation").isNull() | F.col("true").isNull(), F.lit(None)
    ).otherwise(thread_label(F.col("is_rumour"), F.col("misinformation"), F.col("true"), F.lit(True)))
    out = j.withColumn("label", lab.cast("int")).filter(F.col("label").isNotNull())
    return out.select(normalise_tweet("text").alias("text"), "label", "event", "thread_id")


# --- S5 / S6 -----------------------------------------------------------------------
def write_table(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """A new version goes to a new path; never overwrite a path being read."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("quote", '"').option("escape", '"')
    w.save(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report is a tiny aggregate (one row per model / run), so one
    JSON file is written."""
    df.coalesce(1).write.mode(mode).json(path)


# --- S7 ----------------------------------------------------------------------------
def save_reference(scores: DataFrame, path: str, score: str = "score", mode: str = "errorifexists") -> None:
    """Persist the reference distribution as ``(score, n)`` counts."""
    scores.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    """The stored distribution expanded back to one row per score.

    A count is dealt to rows of at most 10,000 first, so that a score that
    very many rows share is no single huge array."""
    c = spark.read.parquet(path)
    step = 10_000
    parts = c.filter("n > 0").select("score", "n", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(step).cast("long"))).alias("__at"))
    return parts.select(F.explode(F.array_repeat("score", F.least(F.lit(step), F.col("n") - F.col("__at")).cast("int"))).alias("score"))


def reference_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """Read the stored reference if present, else build, store and read it."""
    try:
        return load_reference(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        save_reference(build(), path)
        return load_reference(spark, path)


# --- S8 ----------------------------------------------------------------------------
def save_model(model, path: str, mode: str = "errorifexists") -> None:
    """A :class:`veracity.operators.models.LinearModel` as three small tables."""
    model.vocab.write.mode(mode).parquet(f"{path}/vocabulary")
    model.coef.write.mode(mode).parquet(f"{path}/coefficients")
    parts = [(n, *p) for n, p in enumerate(model.parts)]
    model.vocab.sparkSession.createDataFrame(parts, "part int, intercept double, a double, b double").write.mode(mode).parquet(f"{path}/parts")


def load_model(spark: SparkSession, path: str):
    from veracity.operators.models import LinearModel

    parts = [tuple(r)[1:] for r in spark.read.parquet(f"{path}/parts").orderBy("part").collect()]  # one row per fold
    return LinearModel(spark.read.parquet(f"{path}/vocabulary"), spark.read.parquet(f"{path}/coefficients"), parts)
