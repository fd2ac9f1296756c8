"""Distributed prefix sums (running totals) without a single-partition window.

A global running sum written as ``sum(x) OVER (ORDER BY k)`` makes Spark move
every row into one task. Here, whatever the size of the input:

1. rows are range-partitioned by group and order key, tagged with their
   partition and checkpointed, which fixes the tags;
2. per-range totals give each range an offset within its group; as ranges are
   contiguous, there are at most ``groups + ranges`` of them;
3. a window partitioned by ``(groups..., range)`` adds the in-range running
   sum to the offset.

The input must be unique on ``(group_cols..., order_cols...)``, which is what
a preceding ``groupBy`` produces. Partial aggregation upstream already folds a
hot key (a third of all rows on one value) into one row per map task, so no
range holds more than its share of *distinct* keys. Null order keys come
first; a null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.session import materialize, shuffle_partitions

RANGE = "__range"


def ranged(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its range, in the order of the keys."""
    n = n_ranges or shuffle_partitions(df.sparkSession)
    return materialize(df.repartitionByRange(n, *group_cols, *order_cols).withColumn(RANGE, F.spark_partition_id()))


def prefix_sums(
    df: DataFrame,
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    n_ranges: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum of ``c`` ordered by
    ``order_cols`` within ``group_cols`` (global when empty)."""
    cut = ranged(df, order_cols, group_cols, n_ranges)
    totals = cut.groupBy(*group_cols, RANGE).agg(*[F.sum(c).alias(c) for c in sum_cols])
    w_off = Window.partitionBy(*group_cols).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias("__g_" + c) for c in group_cols], F.col(RANGE).alias("__r"),
        *[F.coalesce(F.sum(c).over(w_off), F.lit(0)).alias("__off_" + c) for c in sum_cols],
    )
    if not group_cols:
        # one row per range: a proven bound, so broadcasting is safe
        offsets = F.broadcast(offsets)
    on = F.col(RANGE) == F.col("__r")
    for c in group_cols:
        on = on & F.col(c).eqNullSafe(F.col("__g_" + c))
    w_in = (
        Window.partitionBy(*group_cols, RANGE)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cut.join(offsets, on).select(
        *df.columns,
        *[(F.sum(c).over(w_in) + F.col("__off_" + c)).alias(prefix + c) for c in sum_cols],
    )
