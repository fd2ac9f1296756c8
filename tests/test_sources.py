"""S1-S8 on files written to a fresh temporary folder."""

import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.sources import files as S


def test_csv_doubled_quotes_and_na(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "news_20260323_1119.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('text,scraped_at,source\n"He said ""no"", twice",2026-03-23 11:19:00,@a\nnan,NULL,@b\n,2026-03-23 11:20:00,\n')
    df = S.read_news_csv(spark, p).collect()
    assert df[0].text == 'He said "no", twice'
    assert df[1].text is None and df[1].scraped_at is None
    assert df[2].text is None and df[2].source is None


def test_snapshot_directory(spark, tmpdir_fresh):
    for name in ("news_20260301_0000.csv", "news_20260302_0600.csv", "all_tweets.csv"):
        with open(os.path.join(tmpdir_fresh, name), "w") as f:
            f.write("text,scraped_at,source\nhello there,2026-03-01 00:00:00,@x\n")
    df = S.read_snapshots(spark, tmpdir_fresh)
    files = sorted(r.file for r in df.select("file").distinct().collect())
    assert files == ["news_20260301_0000.csv", "news_20260302_0600.csv"]
    t = {r.file: str(r.snapshot_time) for r in df.collect()}
    assert t["news_20260302_0600.csv"] == "2026-03-02 06:00:00"


def test_columns_go_by_name_and_bad_records_are_kept(spark, tmpdir_fresh):
    files = {
        "a.csv": 'text,scraped_at,source\none,t1,@a\n"two, ""2""",t2,@b\n',
        "b.csv": '\ufeffsource, n ,text\r\n@c,7,three\r\n@d,x,four\r\n@e,8\r\n',   # a mark in front, white space, Windows line ends
        "c.csv": "text,text,n\nfirst,second,9\na,b,c,d\n",                            # one name twice
        "d.csv": "other\nvalue\n", "e.csv": "", "f.csv": "n,text\n", "g.txt": "text\nnot read\n",
    }
    for name, body in files.items():
        with open(os.path.join(tmpdir_fresh, name), "w", encoding="utf-8", newline="") as f:
            f.write(body)
    rows = S.read_csv_by_header(spark, tmpdir_fresh, T.StructType.fromDDL("text string, n int, source string"), glob="*.csv")
    assert rows.columns == ["text", "n", "source", "file", "mtime", "record", "reason"]
    got = sorted((r.file, r.text or "", r.n, r.source) for r in S.accepted(rows).collect())
    assert got == [("a.csv", "one", None, "@a"), ("a.csv", 'two, "2"', None, "@b"), ("b.csv", "three", 7, "@c"), ("c.csv", "first", 9, None), ("d.csv", "", None, None)]
    bad = sorted((r.file, r.record.rstrip("\r"), r.reason) for r in S.rejected(rows).collect())
    assert bad == [("b.csv", "@d,x,four", "value"), ("b.csv", "@e,8", "fields"), ("c.csv", "a,b,c,d", "fields")]
    assert rows.filter("reason is not null and (text is not null or n is not null or source is not null)").count() == 0
    assert S.accepted(rows).select("file").distinct().count() == 4
    header = S.file_headers(spark, tmpdir_fresh, "*.csv")
    assert len(header[("source", "n", "text")]) == 1 and ("n", "text") in header


def test_a_folder_without_rows(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "e.csv"), "w") as f:
        f.write("")
    rows = S.read_csv_by_header(spark, tmpdir_fresh)
    assert rows.count() == 0 and rows.columns == ["text", "scraped_at", "source", "file", "mtime", "record", "reason"]


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def test_thread_tree(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "all-rnr-annotated-threads")
    ev = os.path.join(root, "germanwings-crash-all-rnr-threads")
    cases = {
        ("rumours", "t1"): ({"misinformation": 1, "true": 0}, "fake @josé http://x.y/z"),
        ("rumours", "t2"): ({"misinformation": "0", "true": "1"}, "true story"),
        ("rumours", "t3"): ({"misinformation": 0}, "unverified"),
        ("rumours", "t4"): ("{not json", "malformed"),
        ("rumours", "t5"): (None, "missing annotation"),
        ("non-rumours", "t6"): (None, "  plain news  "),
        ("non-rumours", "t7"): (None, ""),
        ("rumours", "t8"): ({"misinformation": "x"}, "bad value"),
    }
    for (kind, tid), (ann, text) in cases.items():
        if ann is not None:
            _write(os.path.join(ev, kind, tid, "annotation.json"), ann)
        _write(os.path.join(ev, kind, tid, "source-tweets", f"{tid}.json"), {"text": text, "id": 1})
    got = {r.thread_id: (r.label, r.text, r.event) for r in S.read_threads(spark, root).collect()}
    assert got == {
        "t1": (0, "fake @USER HTTPURL", "germanwings"),
        "t2": (1, "true story", "germanwings"),
        "t6": (1, "plain news", "germanwings"),
    }


def test_reference_store_roundtrip(spark, tmpdir_fresh):
    scores = spark.createDataFrame([(0.1,), (0.1,), (0.7,)], "score double")
    path = os.path.join(tmpdir_fresh, "ref")
    S.save_reference(scores, path)
    back = sorted(r.score for r in S.load_reference(spark, path).collect())
    assert back == [0.1, 0.1, 0.7]


def test_report_and_table_sinks(spark, tmpdir_fresh):
    df = spark.createDataFrame([("m", 0.5)], "model string, auc_roc double")
    S.write_report(df, os.path.join(tmpdir_fresh, "rep"))
    assert spark.read.json(os.path.join(tmpdir_fresh, "rep")).first().auc_roc == 0.5
    S.write_table(df, os.path.join(tmpdir_fresh, "t"), partition_by=["model"])
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "t")).count() == 1


def test_reference_store(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "ref")
    scores = spark.createDataFrame([(0.5,)] * 25_003 + [(0.25,)], "score double")
    got = S.reference_or_build(spark, path, lambda: scores)
    assert {r.score: r["count"] for r in got.groupBy("score").count().collect()} == {0.5: 25_003, 0.25: 1}
    assert S.reference_or_build(spark, path, lambda: 1 / 0).count() == 25_004
    with pytest.raises(Exception):
        S.reference_or_build(spark, os.path.join(tmpdir_fresh, "no", "x*["), lambda: scores.select("absent"))


def test_serving_record(spark):
    from veracity.operators import prepare as P
    rows = spark.createDataFrame([("a", 0.9, "2024-01-02 03:04:05"), ("b", 0.5, "2024-01-02 03:04:05"), (None, 0.9, "2024-01-02 03:04:05")],
                                 "text string, score double, at string").withColumn("at", F.to_timestamp("at"))
    assert tuple(P.serving_status(rows, "at").first()) == ("2024-01-02 03:04", "Healthy", 1, 1)
    assert tuple(P.serving_status(rows.filter("text is null"), "at").first()) == ("2024-01-02 03:04", "Empty file", 0, 0)
    assert tuple(P.serving_status(rows.limit(0), "at").first()) == ("No data yet", "Waiting for scrape", 0, 0)
    top = P.serving_defaults(P.latest_rows(rows, "scraped_at", ["text"], 1)).first()
    assert (top.text, top.scraped_at, top.source) == ("a", "N/A", "NewsAPI")
    files = spark.createDataFrame([("news_1.csv", 2), ("all_tweets.csv", 1)], "f string, m int")
    assert P.latest_snapshot(files, "f", "m").first().f == "news_1.csv"
    assert P.latest_snapshot(files, "f", "m", prefer="all_tweets.csv").first().f == "all_tweets.csv"
