"""U1 on a bucketed table: same rows as the plain merge, and no exchange of the master."""

from uuid import uuid4

import pytest

from veracity.operators import master as B
from veracity.operators import prepare as P
from veracity.streaming.monitor import work_dir

SCHEMA = "id long, text string, key_digest2 string"


def made(spark, rows, buckets=4):
    name, path = f"m_{uuid4().hex}", work_dir(spark, "t-master")
    B.create_master(spark.createDataFrame(rows, SCHEMA), name, path, order_cols=["id"], buckets=buckets)
    return name, path


def test_merges_match_the_plain_merge(spark):
    first = [(i, f"text {i % 20}", "x") for i in range(60)] + [(100, None, "x"), (101, None, "y")]
    days = [[(200 + 40 * d + i, f"text {(i * 7 + 5 * d) % 45}", "z") for i in range(40)] + [(999 + d, None, "n"), (500 + d, "", "e")] for d in range(3)]
    name, path = made(spark, first)
    want = spark.createDataFrame(first, SCHEMA)
    for day in days:
        new = spark.createDataFrame(day, SCHEMA)
        B.merge_into_master(new, name, path, order_cols=["id"])
        B.merge_into_master(new, name, path, order_cols=["id"])  # again: nothing is added
        want = P.merge_distinct(want, new, order_cols=["id"])
    rows = lambda t: sorted(map(tuple, t.collect()), key=str)
    assert rows(B.master(spark, name)) == rows(want)
    other, where = f"m_{uuid4().hex}", work_dir(spark, "t-master")
    B.compacted(spark, name, other, where)
    assert rows(B.master(spark, other)) == rows(want) and B.buckets_of(spark, other) == 4
    assert len(spark.table(other).inputFiles()) <= 4 < len(spark.table(name).inputFiles())
    B.merge_into_master(spark.createDataFrame([(1, "text 3", "x"), (2, "new", "x")], SCHEMA), other, where)
    assert B.master(spark, other).count() == want.count() + 1


def test_only_the_new_side_is_exchanged(spark):
    name, _ = made(spark, [(i, f"text {i}", "x") for i in range(50)], buckets=7)
    fresh = B.fresh_for_master(spark.createDataFrame([(1, "text 3", "x"), (2, "new", "x")], SCHEMA), name)
    fresh.collect()
    plan = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert fresh.count() == 1


def test_empty_sides_and_plain_tables(spark):
    name, path = made(spark, [])
    assert B.master(spark, name).count() == 0
    B.merge_into_master(spark.createDataFrame([(1, None, "x"), (2, None, "x")], SCHEMA), name, path, order_cols=["id"])
    B.merge_into_master(spark.createDataFrame([], SCHEMA), name, path)
    assert [r.id for r in B.master(spark, name).collect()] == [1]
    spark.range(3).createOrReplaceTempView("plain_rows")
    with pytest.raises(ValueError):
        B.buckets_of(spark, "plain_rows")
