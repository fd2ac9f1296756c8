"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Add a query, and its DuckDB twin if it has one, to the driver's registry."""

    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


#: Bytes of an Arrow batch that goes to a Python worker; one text may be longer.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of ``BATCH_BYTES``, however long their
    texts are: an executor holds a few copies of a batch for each of its tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(col="text"):
    """Number of words of a text as a native expression; null has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Dense rank of every window of ``width`` consecutive ids, without hashing.

    Equal windows get equal numbers. Widths are built by doubling: the rank of
    a pair of ranks is again below the number of positions, so the combined
    key always fits 64 bits. ``width`` needn't be a power of two: the last
    step overlaps two windows."""
    have, rank = 1, ids.astype(np.int64)
    while have < width and len(rank) > 0:
        step = min(have, width - have)
        left, right = rank[:-step], rank[step:]
        base = int(rank.max()) + 1
        _, rank = np.unique(left * base + right, return_inverse=True)
        have += step
    return rank


def word_ids(words: list[str]) -> np.ndarray:
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def slices(values, rows: int = 256):
    """An Arrow batch or array in small parts: only one part at a time is held as Python objects."""
    for at in range(0, len(values), rows):
        yield values.slice(at, rows)


def arrow_rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns; values are Python's, so ids keep all their digits beside nulls."""
    for b in batches:
        for part in slices(b.select(names)):
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` bytes; ``rows`` yields (row, its rough size)."""

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    held, weight = [], 0
    for row, w in rows:
        held.append(row)
        weight += w + 64
        if weight >= size:
            yield batch(held)
            held, weight = [], 0
    if held:
        yield batch(held)
        held = []
    pa.default_memory_pool().release_unused()  # a worker lives on with the next task
