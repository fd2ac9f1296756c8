"""Structured Streaming operators.

The reference scrapes a batch of posts per day into a landing folder and
monitors the newest file. Here the landing folder is a file-source stream:

* T1 ``start_ingest``  - clean + length-filter each new file and merge it into
  an all-time master table, first row per text wins. ``mode="all_time"`` does
  the merge in ``foreachBatch`` against the digests of all stored texts, an
  index in buckets (:mod:`veracity.streaming.state`) of which a batch reads the
  ones it meets; ``mode="watermark"`` uses
  ``dropDuplicatesWithinWatermark`` (bounded state, duplicates further apart
  than the watermark delay are kept).
* T2 ``start_monitor`` - tumbling event-time windows of relevancy and
  confidence (mergeable sums), watermark for late rows.
* T3 ``start_drift``   - drift report of every snapshot a micro-batch adds to,
  over all its rows so far, against a stored reference. Batches add counts by
  snapshot and score to the state; rows are read once.

Every ``foreachBatch`` writer is idempotent: batch ``b`` writes only
``.../batch_id=b`` with overwrite, so a replayed batch after a failure
replaces its own output instead of duplicating it. Staging and sink folders
live under the session's ``spark.checkpoint.dir`` (a shared folder).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.functions.text import relevant, strip_tweet
from veracity.operators import drift as D
from veracity.operators.prepare import MIN_TEXT_LEN, fresh_rows, key_digest
from veracity.session import ensure_checkpoint_dir, materialize
from veracity.streaming.state import RunStore


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/veracity-{name}-{uuid.uuid4().hex[:12]}"


def stage_files(df: DataFrame, path: str, file_col: str) -> None:
    """Land ``df`` as Parquet files in a folder for each value of ``file_col``
    (a landing folder of snapshots). Adaptive execution merges small values
    into one task and splits a value that holds many rows over several."""
    # the folder key is a copy, so the data files keep ``file_col`` itself
    staged = df.withColumn("landing_file", F.col(file_col).cast("string"))
    staged.hint("rebalance", F.col("landing_file")).write.mode("overwrite").partitionBy("landing_file").parquet(path)


def read_landing(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def _existing(spark: SparkSession, root: str, before_batch: int) -> DataFrame | None:
    try:
        df = spark.read.parquet(root)
    except AnalysisException as e:  # no batch was written yet
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return df.filter(F.col("batch_id") < before_batch).drop("batch_id")


# --- T1 -------------------------------------------------------------------------
def key_index(spark: SparkSession, path: str) -> RunStore:
    """Digests of stored keys; no key stands in two batches, so runs need no merging but the union."""
    return RunStore(spark, path, "digest binary", ("digest",), lambda rows: rows)


def _digests(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key_digest(key).alias("digest"))


def start_ingest(stream: DataFrame, master_path: str, checkpoint: str, text_col: str = "text",
                 order_cols: Sequence[str] = (), mode: str = "all_time", watermark_col: str | None = None,
                 delay: str = "1 day", min_len: int = MIN_TEXT_LEN):
    """F4 cleaning, P4 length filter, first-wins dedup on the text."""
    cleaned = stream.withColumn(text_col, strip_tweet(text_col)).filter(F.length(text_col) >= min_len)
    if mode == "watermark":
        if not watermark_col:
            raise ValueError("watermark mode needs an event-time column")
        q = (cleaned.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark([text_col])
             .writeStream.format("parquet").option("path", master_path).option("checkpointLocation", checkpoint)
             .outputMode("append"))
        return q

    cols = cleaned.columns

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = key_index(spark, f"{master_path.rstrip('/')}-keys")
        older = index.adopted([])
        if older is None and batch_id == 0 and (master := _existing(spark, master_path, batch_id)) is not None:
            # a master that was written without an index gets one once
            index.adopt(_digests(master, text_col))
        digests = _digests(batch, text_col)
        grains = index.grains(digests)
        known = index.before(batch_id, grains)
        if (older := index.adopted(grains)) is not None:
            known = known.unionByName(older)
        fresh_rows(batch.select(*cols), known, text_col, order_cols).write.mode("overwrite").parquet(_batch_path(master_path, batch_id))
        written = spark.read.schema(batch.select(*cols).schema).parquet(_batch_path(master_path, batch_id))
        index.append(_digests(written, text_col), batch_id)

    return (cleaned.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .outputMode("append"))


# --- T2 -------------------------------------------------------------------------
def start_monitor(stream: DataFrame, out_path: str, checkpoint: str, time_col: str, text_col: str,
                  score_col: str, keywords: Sequence[str], window: str = "1 day", delay: str = "1 day"):
    """Per tumbling window, rows, relevancy rate and mean confidence,
    built from mergeable sums. Rows later than ``delay`` behind the newest
    time seen are dropped, and so is the state of windows that far back. Each
    batch writes the windows it changed into its own folder;
    :func:`read_latest` gives the last state of each."""
    # watermarks need TIMESTAMP; NTZ input is read as session-time wall clock
    stream = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    agg = (stream.withWatermark(time_col, delay)
           .groupBy(F.window(time_col, window).alias("w"))
           .agg(F.count(F.lit(1)).alias("n_articles"),
                F.sum(relevant(text_col, keywords).cast("double")).alias("__rel"),
                F.sum(F.abs(F.col(score_col) - 0.5) * 2.0).alias("__conf")))

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(
            F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n_articles",
            F.round(F.col("__rel") / F.col("n_articles"), 4).alias("relevancy_rate"),
            F.round(F.col("__conf") / F.col("n_articles"), 4).alias("avg_confidence"))
        out.write.mode("overwrite").parquet(_batch_path(out_path, batch_id))

    return agg.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


# --- T3 -------------------------------------------------------------------------
def drift_state(spark: SparkSession, path: str, snapshot_type: str) -> RunStore:
    """Rows ``(snapshot, x, c, relevant)``: articles of a snapshot at a score, and the relevant ones among them."""
    return RunStore(spark, path, f"snapshot {snapshot_type}, x double, c bigint, relevant bigint", ("snapshot",), _summed)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("snapshot", "x").agg(F.sum("c").alias("c"), F.sum("relevant").alias("relevant"))


def start_drift(stream: DataFrame, reference: DataFrame, report_path: str, checkpoint: str, snapshot_col: str,
                text_col: str, score_col: str, keywords: Sequence[str], ks_mode: str = "limit"):
    """Drift report of every snapshot a micro-batch adds rows to, over all
    rows of that snapshot so far: :func:`read_latest` by ``snapshot_col``.

    A batch reduces its rows to counts by snapshot and score, adds those to
    the state and reads the state of the snapshots it met; its articles are
    never read again. The reference is reduced once, here, to bins and to a
    table in ranges of its scores (:class:`~veracity.operators.drift.ReferenceIndex`),
    of which a batch reads the ranges that its scores lie in."""
    state_path, kind = f"{report_path}-state", stream.schema[snapshot_col].dataType.simpleString()
    index = D.ReferenceIndex.stored(reference, f"{report_path}-reference", score_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        state = drift_state(batch.sparkSession, state_path, kind)
        rows = batch.select(F.col(snapshot_col).alias("snapshot"), F.col(score_col).cast("double").alias("x"), F.lit(1).cast("bigint").alias("c"),
                            relevant(text_col, keywords).cast("bigint").alias("relevant"))
        added = materialize(_summed(rows))
        met = F.broadcast if added.count() <= D.BROADCAST_ROWS else (lambda t: t)
        touched = met(added.select(F.col("snapshot").alias("__s")).distinct())
        so_far = state.before(batch_id, state.grains(added)).join(touched, F.col("snapshot").eqNullSafe(F.col("__s")), "left_semi")
        whole = materialize(_summed(so_far.unionByName(added)))
        rep = D.drift_of_counts(whole, index, ks_mode).withColumnRenamed("snapshot", snapshot_col)
        rep.write.mode("overwrite").parquet(_batch_path(report_path, batch_id))
        state.append(added, batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The last row written for each ``key`` of a folder of batches."""
    df = spark.read.parquet(path)
    own = [c for c in df.columns if c != "batch_id"]
    return df.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*own), "batch_id").alias("__r")).select("__r.*")


def run_available(writer, timeout_s: float | None = None) -> None:
    """Process everything currently in the landing folder, then stop.

    Without ``timeout_s`` it runs to the end; past it, ``TimeoutError`` says
    that the output isn't whole."""
    q = writer.trigger(availableNow=True).start()
    try:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError(f"the stream hadn't read all input after {timeout_s} s")
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
