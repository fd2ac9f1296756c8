"""Streams over a landing folder must equal the batch result."""

import pytest
from pyspark.sql import functions as F

from veracity.operators import drift as D
from veracity.streaming import monitor as S
from veracity.streaming import state as ST


def test_ingest_first_wins_all_time(spark):
    rows = [(1, "aaaaaaaaaaaaaaaaaaaaaaaa one", "f1"), (2, "aaaaaaaaaaaaaaaaaaaaaaaa one", "f2"),
            (3, "short", "f1"), (4, "bbbbbbbbbbbbbbbbbbbbbbbbb @x two", "f2"), (5, "bbbbbbbbbbbbbbbbbbbbbbbbb two", "f3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, f string")
    landing = S.work_dir(spark, "t-landing")
    S.stage_files(df, landing, "f")
    stream = S.read_landing(spark, landing, df.schema, max_files=1)
    master, ckpt = S.work_dir(spark, "t-master"), S.work_dir(spark, "t-ckpt")
    S.run_available(S.start_ingest(stream, master, ckpt, "text", order_cols=["doc_id"]), 300)
    out = spark.read.parquet(master).collect()
    texts = sorted(r.text for r in out)
    assert texts == ["aaaaaaaaaaaaaaaaaaaaaaaa one", "bbbbbbbbbbbbbbbbbbbbbbbbb two"]
    assert len({r.batch_id for r in out}) >= 1


def test_ingest_over_several_runs(spark):
    """Texts that an earlier run stored stay out, also where the master came without its keys."""
    landing, ckpt = S.work_dir(spark, "t-landing"), S.work_dir(spark, "t-ckpt")
    master = S.work_dir(spark, "t-master")
    text = "a text of more than twenty letters {}".format
    days = [[(1, text("a")), (2, text("b"))], [(3, text("b")), (4, text("c")), (5, text("c"))], [(6, text("a")), (7, text("c")), (8, text("d"))]]
    for day in days:
        spark.createDataFrame(day, "id long, text string").coalesce(1).write.mode("append").parquet(landing)
        S.run_available(S.start_ingest(S.read_landing(spark, landing, "id long, text string"), master, ckpt, "text", order_cols=["id"]))
    assert sorted(r.id for r in spark.read.parquet(master).collect()) == [1, 2, 4, 8]
    assert S.key_index(spark, f"{master}-keys").before(3).distinct().count() == 4

    bare = S.work_dir(spark, "t-bare")
    spark.createDataFrame(days[0], "id long, text string").write.parquet(f"{bare}/batch_id=-1")
    stream = S.read_landing(spark, landing, "id long, text string")
    S.run_available(S.start_ingest(stream, bare, S.work_dir(spark, "t-ckpt"), "text", order_cols=["id"]))
    assert sorted(r.id for r in spark.read.parquet(bare).collect()) == [1, 2, 4, 8]


def test_staged_files_hold_all_rows_of_a_hot_value(spark):
    df = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then cast(id as string) end as f").filter("f = 'hot' or f is null or id < 60")
    landing = S.work_dir(spark, "t-landing")
    S.stage_files(df, landing, "f")
    assert sorted(r.id for r in spark.read.option("recursiveFileLookup", True).schema(df.schema).parquet(landing).collect()) == sorted(r.id for r in df.collect())


def test_monitor_equals_batch(spark):
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", "error" if i % 2 else "view", (i % 10) / 10.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, ts string, text string, score double") \
        .withColumn("ts", F.to_timestamp("ts")).withColumn("f", F.date_format("ts", "yyyyMMdd"))
    landing = S.work_dir(spark, "t-landing")
    S.stage_files(df, landing, "f")
    out, ckpt = S.work_dir(spark, "t-out"), S.work_dir(spark, "t-ckpt")
    S.run_available(S.start_monitor(S.read_landing(spark, landing, df.schema, 1), out, ckpt,
                                    "ts", "text", "score", ["error"], delay="30 days"), 300)
    got = {r.window_start: (r.n_articles, r.relevancy_rate) for r in S.read_latest(spark, out, "window_start").collect()}
    exp = df.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("text") == "error").cast("double")), 4).alias("r")).collect()
    assert got == {r.d: (r.n, r.r) for r in exp}


def test_drift_stream_equals_batch(spark):
    rows = [(i, "iran news" if i % 4 == 0 else "other", f"s{i % 3}", ((i * 37) % 100) / 100.0) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    ref = spark.createDataFrame([(((i * 53) % 97) / 97.0,) for i in range(200)], "score double")
    landing = S.work_dir(spark, "t-landing")
    S.stage_files(df, landing, "source")
    out, ckpt = S.work_dir(spark, "t-out"), S.work_dir(spark, "t-ckpt")
    S.run_available(S.start_drift(S.read_landing(spark, landing, df.schema, 2), ref, out, ckpt,
                                  "source", "text", "score", ["iran"]), 300)
    got = sorted(tuple(r) for r in S.read_latest(spark, out, "source").collect())
    exp = sorted(tuple(r) for r in D.drift_by_snapshot(df, ref, "source", "text", "score", ["iran"]).collect())
    assert got == exp


def test_late_rows_are_dropped(spark):
    rows = [(1, "2024-01-01 01:00:00", "a"), (2, "2024-01-30 01:00:00", "b"), (3, "2024-01-01 02:00:00", "c"), (4, "2024-01-30 05:00:00", "c")]
    df = spark.createDataFrame(rows, "id long, ts string, f string").withColumns(
        {"ts": F.to_timestamp("ts"), "text": F.lit("error"), "score": F.lit(0.9)})
    landing, out, ckpt = (S.work_dir(spark, x) for x in ("t-landing", "t-out", "t-ckpt"))
    for f in ("a", "b", "c"):  # one file after the other, by modification time
        df.filter(F.col("f") == f).coalesce(1).write.mode("append").parquet(landing)
        S.run_available(S.start_monitor(S.read_landing(spark, landing, df.schema), out, ckpt, "ts", "text", "score", ["error"], delay="1 day"))
    got = {r.window_start: r.n_articles for r in S.read_latest(spark, out, "window_start").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-30 00:00:00": 2}


def test_snapshot_in_several_batches_is_one_report(spark):
    rows = [(i, "iran news", "s", ((i * 37) % 100) / 100.0, f"f{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score double, f string")
    ref = spark.createDataFrame([(((i * 53) % 97) / 97.0,) for i in range(100)], "score double")
    landing, out, ckpt = (S.work_dir(spark, x) for x in ("t-landing", "t-out", "t-ckpt"))
    S.stage_files(df, landing, "f")
    S.run_available(S.start_drift(S.read_landing(spark, landing, df.schema, 1), ref, out, ckpt, "source", "text", "score", ["iran"]))
    got = [tuple(r) for r in S.read_latest(spark, out, "source").collect()]
    assert got == [tuple(r) for r in D.drift_by_snapshot(df, ref, "source", "text", "score", ["iran"]).collect()] and got[0][1] == 60


def test_unfinished_stream_raises(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 40 as string) as f", "concat('some text of enough length ', id) as text")
    landing, out, ckpt = (S.work_dir(spark, x) for x in ("t-landing", "t-out", "t-ckpt"))
    S.stage_files(df, landing, "f")
    with pytest.raises(TimeoutError):
        S.run_available(S.start_ingest(S.read_landing(spark, landing, df.schema, 1), out, ckpt, "text", order_cols=["id"]), 2)


# --- state in runs and buckets -------------------------------------------------------
@pytest.mark.parametrize("fan", [2, 3, 8])
def test_runs_cover_all_batches_once(fan):
    for batches in range(200):
        runs = ST.cover(batches, fan)
        held = [b for level, run in runs for b in range(run * fan ** level, (run + 1) * fan ** level)]
        assert held == list(range(batches))
        assert len(runs) <= (fan - 1) * (1 + len(runs and bin(batches)))


def test_state_equals_all_batches_and_replays_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ST, "BUCKET_ROWS", 10)  # so that runs have several buckets
    store = ST.RunStore(spark, S.work_dir(spark, "t-state"), "k string, n bigint", ("k",), lambda t: t.groupBy("k").agg(F.sum("n").alias("n")), fan=2)
    want = {}
    for batch in range(7):
        rows = [(f"k{(batch * 13 + i) % 60}" if i else None, 1) for i in range(25)]
        for _ in range(1 + batch % 2):  # every second batch comes twice
            store.append(spark.createDataFrame(rows, "k string, n bigint"), batch)
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        got = {r.k: r.n for r in store.merged(store.before(batch + 1)).collect()}
        assert got == want


def test_a_batch_reads_only_the_buckets_it_meets(spark, monkeypatch):
    monkeypatch.setattr(ST, "BUCKET_ROWS", 100)
    index = S.key_index(spark, S.work_dir(spark, "t-keys"))
    for batch in range(9):
        rows = spark.range(batch * 1000, batch * 1000 + 1000).selectExpr("cast(id as string) as t")
        index.append(S._digests(rows, "t"), batch)
    few = S._digests(spark.createDataFrame([("17",), ("4711",), ("absent",)], "t string"), "t")
    met = index.before(9, index.grains(few))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert met.count() < 9000 / 10
    assert few.join(met, "digest").count() == 2
    assert len(ST.cover(9)) == 2  # eight batches became one run


def test_ingest_over_more_batches_than_a_run_holds(spark):
    """Ten daily files with repeats across them: first wins, whether the first copy lies in a merged run or not."""
    landing, ckpt, master = (S.work_dir(spark, x) for x in ("t-landing", "t-ckpt", "t-master"))
    want, n = {}, 0
    for day in range(10):
        rows = []
        for k in (day, day // 2, 7, 0):
            n += 1
            rows.append((n, f"a text of more than twenty letters {k}"))
            want.setdefault(rows[-1][1], n)
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").parquet(landing)
        S.run_available(S.start_ingest(S.read_landing(spark, landing, "id long, text string"), master, ckpt, "text", order_cols=["id"]))
    assert {r.text: r.id for r in spark.read.parquet(master).collect()} == want


def test_watermark_mode_keeps_copies_that_lie_far_apart(spark):
    day = "2024-01-{:02d} 00:00:00".format
    landing, ckpt, master = (S.work_dir(spark, x) for x in ("t-landing", "t-ckpt", "t-master"))
    for rows in ([(1, "the same text in both files", day(1)), (2, "another text of these files", day(1))], [(3, "the same text in both files", day(2))],
                 [(4, "a text that moves the watermark", day(20))], [(5, "the same text in both files", day(21))]):
        df = spark.createDataFrame(rows, "id long, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(landing)
        stream = S.read_landing(spark, landing, df.schema)
        S.run_available(S.start_ingest(stream, master, ckpt, "text", mode="watermark", watermark_col="ts", delay="3 days"))
    assert sorted(r.id for r in spark.read.parquet(master).collect()) == [1, 2, 4, 5]
    with pytest.raises(ValueError):
        S.start_ingest(stream, master, ckpt, "text", mode="watermark")


def test_drift_state_with_null_scores_null_snapshots_and_an_empty_reference(spark):
    rows = [(i, "iran news" if i % 4 else None, None if i % 5 == 0 else f"s{i % 2}", None if i % 7 == 0 else ((i * 37) % 40) / 39.0, f"f{i % 10}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score double, f string")
    for scores in ([((i * 53) % 50) / 49.0 for i in range(200)] + [None], [None], [0.5] * 300, []):
        ref = spark.createDataFrame([(x,) for x in scores], "score double")
        landing, out, ckpt = (S.work_dir(spark, x) for x in ("t-landing", "t-out", "t-ckpt"))
        S.stage_files(df, landing, "f")
        S.run_available(S.start_drift(S.read_landing(spark, landing, df.schema, 3), ref, out, ckpt, "source", "text", "score", ["iran"]))
        order = lambda t: sorted((tuple(r) for r in t.collect()), key=str)
        assert order(S.read_latest(spark, out, "source")) == order(D.drift_by_snapshot(df, ref, "source", "text", "score", ["iran"]))


def test_reference_index_gives_counts_at_any_score(spark):
    ref = [((i * 53) % 500) / 499.0 for i in range(3000)] + [0.25] * 2000
    index = D.ReferenceIndex.stored(spark.createDataFrame([(x,) for x in ref], "score double"), S.work_dir(spark, "t-ref"), ranges=16)
    values = sorted({-1.0, 0.0, 0.25, 0.2500001, 1.0, 2.0, *[i / 77 for i in range(77)]})
    got = {r.x: (r.r, r.cum_r) for r in index.at(spark.createDataFrame([(v,) for v in values], "x double")).collect()}
    assert got == {v: (sum(x == v for x in ref), sum(x <= v for x in ref)) for v in values}
    near = index.at(spark.createDataFrame([(0.9,)], "x double"))
    filters = near._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "range" in filters and len(index.names) > 8


def test_a_landing_is_one_batch_of_the_drift_query_in_however_many_files(spark, tmpdir_fresh, monkeypatch):
    """A batch reads the state of all snapshots, so more files a landing must not mean more batches."""
    from veracity.plans import catalog
    docs = [(None if i % 40 == 7 else i, f"a nation of many words {i} " * 30, "en", f"s{i % 3}") for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(8).write.parquet(f"{tmpdir_fresh}/documents.parquet")
    spark.range(400).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic").write.parquet(f"{tmpdir_fresh}/labels.parquet")
    read, seen = S.read_latest, []
    monkeypatch.setattr(S, "read_latest", lambda spark, path, key: seen.append(path) or read(spark, path, key))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "2k")
        got = sorted(map(tuple, catalog.QUERIES["stream_drift"](spark, tmpdir_fresh).collect()))
    finally:
        spark.conf.set(size, before)
    assert got == sorted(map(tuple, catalog.QUERIES["drift_by_snapshot"](spark, tmpdir_fresh).collect()))
    assert sum(r[1] for r in got) == 400
    assert spark.read.parquet(seen[0]).select("batch_id").distinct().count() == catalog.LANDINGS
