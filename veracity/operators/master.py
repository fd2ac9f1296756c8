"""U1 on a bucketed table: merging never moves or rewrites the master.

The master is a table in buckets of its keys' digests, sorted within them. New
rows are dealt by the same rule, one exchange of the new side alone; first
rows per key are found in their bucket, and those whose key the master has are
left out by a join of bucket with bucket. What remains is appended, bucket by
bucket, so a merge costs the new rows, one scan of the master's digests and no
shuffle of it. A merge that is run again finds its rows and appends none.

Every merge adds a file a bucket; :func:`compacted` writes them as one again.
All null keys are one key. Keys are compared by SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.operators.prepare import key_digest

DIGEST = "key_digest"


def _firsts(rows: DataFrame, key: str, order_cols: Sequence[str], buckets: int) -> DataFrame:
    """The first row of each key, by ``order_cols`` and then the other columns, dealt to ``buckets`` partitions."""
    cols = rows.columns
    order = F.struct(*order_cols, *[c for c in cols if c not in order_cols])
    dealt = rows.withColumn(DIGEST, key_digest(key)).repartition(buckets, DIGEST)
    return dealt.groupBy(DIGEST).agg(F.min_by(F.struct(*cols), order).alias("__r")).select("__r.*", DIGEST)


def _save(rows: DataFrame, name: str, path: str, buckets: int, mode: str) -> None:
    rows.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, DIGEST).sortBy(DIGEST).saveAsTable(name)


def create_master(rows: DataFrame, name: str, path: str, key: str = "text", order_cols: Sequence[str] = (), buckets: int = 200) -> None:
    """A master of the first row of each key, as table ``name`` with its files in ``path``."""
    _save(_firsts(rows, key, order_cols, buckets), name, path, buckets, "errorifexists")


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{name} is not in buckets")
    return int(rows[0].data_type)


def master(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(DIGEST)


def fresh_for_master(new: DataFrame, name: str, key: str = "text", order_cols: Sequence[str] = ()) -> DataFrame:
    """The first row per key of ``new`` whose key the master lacks, with its digest; one exchange, of ``new``."""
    spark = new.sparkSession
    own = _firsts(new.select(*master(spark, name).columns), key, order_cols, buckets_of(spark, name))
    known = spark.table(name).select(F.col(DIGEST).alias("__known")).hint("merge")
    return own.join(known, F.col(DIGEST) == F.col("__known"), "left_anti")


def merge_into_master(new: DataFrame, name: str, path: str, key: str = "text", order_cols: Sequence[str] = ()) -> None:
    """Appends to the master what :func:`fresh_for_master` finds."""
    spark = new.sparkSession
    _save(fresh_for_master(new, name, key, order_cols), name, path, buckets_of(spark, name), "append")


def compacted(spark: SparkSession, name: str, new_name: str, path: str) -> None:
    """The master as another table with one file a bucket; a task reads a bucket and writes it, nothing is exchanged."""
    conf = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")  # Spark would read a bucketed table by files where nothing seems to need its buckets
    try:
        _save(spark.table(name), new_name, path, buckets_of(spark, name), "errorifexists")
    finally:
        spark.conf.set(conf, before)
