"""Keyed state of a stream as sorted-out runs of Parquet files.

Batch ``b`` writes what it adds as run ``b`` of level 0. When the last of
``FAN`` runs of a level is there, they are merged into one run of the next
level, so the state before any batch is a few runs that the batch's number
alone names (its digits to the base ``FAN``): nothing is listed, no pointer is
kept, and a row is rewritten once a level. A replayed batch finds the same
runs and overwrites its own with the same rows, so every step is idempotent.

Within a run rows lie in buckets by the leading bits of their key's hash, and
a run has the more buckets the more rows it has (``buckets=n/bucket=i``, a
power of two). A reader names the buckets it meets at the finest grain, at
most ``GRAIN`` of them; the files of other buckets are pruned by partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.session import materialize

FAN, GRAIN, BUCKET_ROWS = 8, 256, 200_000
PARTS = ("level", "run", "buckets", "bucket")


def grain_of(*keys) -> Column:
    """The finest bucket of a key, whose leading bits are the coarser ones."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - (GRAIN.bit_length() - 1)).cast("int")


def cover(batches: int, fan: int = FAN) -> list[tuple[int, int]]:
    """Runs ``(level, number)`` that hold batches ``0 .. batches - 1``, longest first."""
    out, at, level = [], 0, 0
    while fan ** (level + 1) <= batches:
        level += 1
    while level >= 0:
        size = fan ** level
        while at + size <= batches:
            out.append((level, at // size))
            at += size
        level -= 1
    return out


class RunStore:
    """State of one stream in a folder.

    ``keys`` are the columns that a row's bucket goes by, ``merged`` brings the
    rows of several runs together (for instance sums them by key); it must be
    associative, and runs are merged in no certain order."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], merged: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.keys, self.merged, self.fan = spark, path.rstrip("/"), keys, merged, fan
        self.schema = f"{schema}, {', '.join(f'{p} int' for p in PARTS)}"
        self.columns = [c for c in spark.createDataFrame([], schema).columns]

    def _folder(self, level: int, run: int) -> str:
        return f"{self.path}/level={level}/run={run}"

    def _write(self, stored: DataFrame, level: int, run: int) -> None:
        stored = stored.select(*self.columns)
        n = stored.count()  # from the checkpoint
        buckets = 1
        while buckets < GRAIN and buckets * BUCKET_ROWS < n:
            buckets *= 2
        bucket = F.floor(grain_of(*self.keys) * buckets / GRAIN).cast("int")
        placed = stored.withColumn("buckets", F.lit(buckets)).withColumn("bucket", bucket)
        # a bucket holds about BUCKET_ROWS rows; one with more, of one key, may take several files
        (placed.hint("rebalance", "bucket") if buckets > 1 else placed.coalesce(1)).write.mode("overwrite").partitionBy("buckets", "bucket").parquet(self._folder(level, run))

    def _read(self, runs: list[tuple[int, int]], grains: list[int] | None) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = reader.parquet(*[self._folder(*r) for r in runs])
        if grains is not None:
            met, buckets = F.lit(False), 1
            while buckets <= GRAIN:
                met = met | ((F.col("buckets") == buckets) & F.col("bucket").isin(sorted({g * buckets // GRAIN for g in grains})))
                buckets *= 2
            rows = rows.filter(met)
        return rows.select(*self.columns)

    def grains(self, rows: DataFrame) -> list[int]:
        """Finest buckets that ``rows`` meet: ``GRAIN`` numbers at most."""
        return [r[0] for r in rows.select(grain_of(*self.keys).alias("g")).distinct().collect()]

    def before(self, batch_id: int, grains: list[int] | None = None) -> DataFrame:
        """Rows of the state before a batch, in the buckets of ``grains`` (None: all), as the runs hold them; not merged."""
        return self._read(cover(batch_id, self.fan), grains)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Writes what a batch adds, a table that is stored already, and merges the runs that are complete with it."""
        self._write(rows, 0, batch_id)
        level, size = 1, self.fan
        while (batch_id + 1) % size == 0:
            run = (batch_id + 1) // size - 1
            parts = [(level - 1, run * self.fan + k) for k in range(self.fan)]
            self._write(materialize(self.merged(self._read(parts, None))), level, run)
            level, size = level + 1, size * self.fan

    def adopt(self, rows: DataFrame) -> None:
        """State from before the first batch, written once."""
        self._write(materialize(rows), -1, 0)

    def adopted(self, grains: list[int] | None = None) -> DataFrame | None:
        """What :meth:`adopt` wrote, if it did."""
        try:
            return self._read([(-1, 0)], grains)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
