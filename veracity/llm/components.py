"""Connected components of a table of links, as star contractions.

Each pass hangs every node's larger neighbours, then its smaller ones, on the
least node it knows; a component of any shape becomes a star on its least node
in a number of passes that grows with the logarithm of its size. A node with
many links costs one minimum (partial aggregation), which is stored before it
meets the links: as a broadcast while its rows, once counted, are few, and
then links don't move; else in a join whose sides come straight from
exchanges, which adaptive execution can split. Nothing is gathered in one task
or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.operators.features import broadcast_within
from veracity.session import materialize


EDGES_A_PART = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    least = broadcast_within(materialize(both.groupBy("u").agg(F.min("v").alias("m"))))
    return both.join(least, "u").filter("v > u").select(F.least("m", "u").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = broadcast_within(materialize(edges.groupBy("hi").agg(F.min("lo").alias("m"))))
    moved = edges.join(least, "hi").filter("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.unionAll(least.select(F.col("m").alias("lo"), "hi")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp`` for every node that has a link to another; ``comp`` is the least node reachable.

    Null ends and links of a node to itself are left out; repeated links count once."""
    edges = materialize(links.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct())
    state = _state(edges)
    while state[0]:
        # links hardly grow in number: few of them needn't be spread over many files in every pass
        parts = 1 + state[0] // EDGES_A_PART
        edges = materialize(_large_star(edges).coalesce(parts))
        edges = materialize(_small_star(edges).coalesce(parts))
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct())
