"""M1-M6, A7, O3, J3, F11, F12."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.functions.text import ngram_rows, word_terms
from veracity.operators import features as M

TEXTS = ["The cat sat", "the dog", "a cat a dog the end", "", "Dog dog DOG", "x y z"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")


def test_vocabulary_matches_counter(docs):
    v = {r.word: r.id for r in M.build_vocabulary(docs, "doc_id", "text", max_words=6).collect()}
    counts = Counter(w for t in TEXTS for w in t.lower().split())
    exp = {w: i + 2 for i, (w, _) in enumerate(counts.most_common(4))}
    assert v == exp


def test_encode_sequences(docs):
    vocab = M.build_vocabulary(docs, "doc_id", "text", max_words=6)
    wid = {r.word: r.id for r in vocab.collect()}
    e = {r.doc_id: r.ids for r in M.encode_sequences(docs, vocab, "doc_id", "text", max_len=4).collect()}
    for i, t in enumerate(TEXTS):
        ids = [wid.get(w, 1) for w in t.lower().split()][:4]
        assert e[i] == ids + [0] * (4 - len(ids))
    d = {r.doc_id: r.ids for r in M.encode_drop_oov(docs, vocab, "doc_id", "text", max_len=3).collect()}
    for i, t in enumerate(TEXTS):
        ids = [wid[w] for w in t.lower().split() if w in wid][:3]
        assert d[i] == ids + [0] * (3 - len(ids))


def test_stratified_split_exact(spark):
    rows = [(i, 1 if i % 5 else 0) for i in range(503)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    s = M.stratified_split(df, "doc_id").collect()
    assert len(s) == 503 and len({r.doc_id for r in s}) == 503
    for lab in (0, 1):
        n = sum(1 for _, l in rows if l == lab)
        assert sum(1 for r in s if r.label == lab and r.split == "test") == math.ceil(n * 0.2)
    # independent of partitioning
    s2 = M.stratified_split(df.repartition(7), "doc_id").collect()
    assert {(r.doc_id, r.split) for r in s} == {(r.doc_id, r.split) for r in s2}


def test_exact_cut_boundary_bucket(spark):
    # few buckets force many rows into the boundary bucket
    df = spark.createDataFrame([(i, i * 7919 % 1000) for i in range(300)], "id long, h long")
    q = spark.createDataFrame([(37,)], "quota long")
    got = {r.id for r in M.exact_rank_cut(df, "h", "id", q, [], bucket_bits=2).collect() if r.in_cut}
    exp = {i for _, i in sorted((i * 7919 % 1000, i) for i in range(300))[:37]}
    assert got == exp


def test_random_split(spark):
    df = spark.createDataFrame([(i,) for i in range(101)], "doc_id long")
    s = M.random_split(df, "doc_id").collect()
    assert sum(r.split == "valid" for r in s) == 11


def test_oversample_equalises(spark):
    rows = [(i, 0 if i < 7 else 1) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    o = M.oversample_minority(df, "doc_id").collect()
    c = Counter(r.label for r in o)
    assert c[0] == c[1] == 23


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 2 + [(1,)] * 6, "label int")
    w = {r.label: r.weight for r in M.class_weights(df).collect()}
    assert w == {0: 2.0, 1: 8 / 12}


def np_tfidf(texts, max_features=30000):
    import re
    an = []
    for t in texts:
        toks = re.findall(r"(?u)\b\w\w+\b", t.lower())
        an.append(toks + [" ".join(p) for p in zip(toks, toks[1:])])
    cf = Counter(x for a in an for x in a)
    terms = sorted(cf, key=lambda k: (-cf[k], k))[:max_features]
    df = Counter(x for a in an for x in set(a))
    n = len(texts)
    out = {}
    for i, a in enumerate(an):
        tf = Counter(x for x in a if x in terms)
        w = {k: (1 + math.log(v)) * (math.log((1 + n) / (1 + df[k])) + 1) for k, v in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for k, v in w.items():
            out[(i, k)] = v / norm
    return out


def test_tfidf_matches_reference_formula(docs):
    vocab, w = M.tfidf_fit_transform(docs, "doc_id", "text", max_features=5)
    got = {(r.doc_id, r.term): r.weight for r in w.collect()}
    exp = np_tfidf(TEXTS, 5)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])
    norms = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-12 for r in norms)


def test_tables_beyond_the_bound_are_not_broadcast(spark, docs):
    vocab = M.build_vocabulary(docs, "doc_id", "text", max_words=6)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(M.broadcast_within(vocab, 4)) and "broadcast" not in plan(M.broadcast_within(vocab, 3))


# --- M1-M3: selection by refined histograms ---------------------------------------------
@pytest.mark.parametrize("bits", [1, 2, 16])
def test_cut_by_group_matches_a_sort(spark, bits):
    """Ties in the hash, null groups and ids, quotas of 0, of all and beyond; more groups than are told apart by an expression."""
    rng = random.Random(bits)
    for n_groups in (3, 90):
        rows = [(None if g == 0 else f"g{g}", rng.choice((5, 1 << 31, (1 << 32) - 1, rng.randrange(1 << 32))), i if i % 50 else None)
                for i in range(400) for g in [rng.randrange(n_groups)]]
        groups = sorted({r[0] for r in rows}, key=str)
        quotas = [(g, (0, 1, 7, 10 ** 6)[k % 4] if k else 40) for k, g in enumerate(groups)]
        df = spark.createDataFrame([(*r, "kept") for r in rows], "g string, h long, id long, other string").repartition(3)
        got = M.exact_rank_cut(df, "h", "id", spark.createDataFrame(quotas, "g string, quota long"), ["g"], bucket_bits=bits)
        assert got.columns == ["g", "h", "id", "other", "in_cut"]
        want = []
        for g, quota in quotas:
            mine = sorted(((h, i is not None, i or 0), (g, h, i)) for gg, h, i in rows if gg == g)
            taken = [r for _, r in mine[:quota]]
            want += [(*r, r in taken) for _, r in mine]  # rows that agree in all fall on one side
        assert sorted(map(str, ((r.g, r.h, r.id, r.in_cut) for r in got.collect()))) == sorted(map(str, want))


def test_cut_reads_its_input_twice_and_joins_nothing(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 2 as int) as label", "pmod(hash(id), 4294967296L) as h")
    cut = M.exact_rank_cut(df, "h", "id", spark.createDataFrame([(0, 30), (1, 40)], "label int, quota long"), ["label"])
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Join", "Window", "Exchange", "Sort")) and plan.count("Range") == 1
    assert cut.filter("in_cut").groupBy("label").count().orderBy("label").collect() == [(0, 30), (1, 40)]


# --- A7, M5, M6 -------------------------------------------------------------------------
def test_token_counts_are_hashed_not_sorted(spark):
    docs = spark.createDataFrame([(-3, "b a b"), (7, "a c"), (9_000_000_000_000_000_000, "d D d"), (None, "e a"), (1, None)], "id long, t string")
    freq = M.token_frequency(docs, "id", "t")
    plan = freq._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan
    got = {r.word: (r.n, r.first_doc, r.first_pos) for r in freq.collect()}
    assert got == {"a": (3, -3, 1), "b": (2, -3, 0), "c": (1, 7, 1), "d": (3, 9_000_000_000_000_000_000, 0), "e": (1, None, None)}
    assert freq.schema["first_doc"].dataType.simpleString() == "bigint"
    named = M.token_frequency(docs.filter("id is not null").selectExpr("cast(id as string) as id", "t"), "id", "t")  # ids that are no numbers
    assert {r.word: r.n for r in named.collect()} == {"a": 2, "b": 2, "c": 1, "d": 3}


def test_weights_count_terms_of_the_vocabulary_only(spark):
    docs = spark.createDataFrame([(i, f"alpha beta{i % 3} gamma alpha rare{i}") for i in range(30)] + [(30, None), (31, "rare99")], "id long, t string")
    vocab, weights = M.tfidf_fit_transform(docs, "id", "t", max_features=4)
    assert vocab.count() == 4 and {r.term for r in weights.collect()} <= {r.term for r in vocab.collect()}
    shared = M.term_counts(docs, "id", "t")
    again = M.tfidf_transform(docs, vocab, "id", "t", counts=shared)
    key = lambda t: sorted((r.id, r.term, round(r.weight, 12)) for r in t.collect())
    assert key(weights) == key(again)


def test_terms_are_counted_in_portions_without_an_aggregate_by_document(spark, monkeypatch):
    """Repeated and null ids are one document each; no task groups or sorts the n-grams of its documents."""
    rng = random.Random(3)
    words = ["un", "deux", "dÉjà", "x", "İstanbul", "four", "5", "66", "a_b"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(60)] + [(61, None), (62, ""), (63, "x 5")]
    again = [(3, "un deux un"), (None, "four un"), (None, "un four"), (5, None)]
    plain = spark.createDataFrame(rows, "id long, t string").repartition(3)
    docs = plain.unionByName(spark.createDataFrame(again, "id long, t string"))
    monkeypatch.setattr(M, "COUNTED_BYTES", 300)
    for df, features in ((plain, 7), (plain, 30000), (docs, 9), (docs, 30000)):
        exploded = ngram_rows(df, "id", "t").groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
        row = lambda t, *c: sorted((tuple(r[x] if not isinstance(r[x], float) else round(r[x], 12) for x in c) for r in t.collect()), key=str)
        assert row(M.term_counts(df, "id", "t"), "id", "term", "tf") == row(exploded, "id", "term", "tf")
        vocab, weights = M.tfidf_fit_transform(df, "id", "t", features)
        want = M.tfidf_fit(df, "id", "t", features, counts=exploded)
        assert row(vocab, "term", "index", "df", "idf") == row(want, "term", "index", "df", "idf")
        assert row(weights, "id", "term", "index", "weight") == row(M.tfidf_transform(df, vocab, "id", "t", counts=exploded), "id", "term", "index", "weight")
    plan = M.tfidf_transform(plain, vocab, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Aggregate", "Window", "Sort", "Generate", "Join"))


def test_words_in_arrow_are_those_of_spark(spark):
    """Every character between letters, as a text; and letters whose lower case goes by the word or is longer."""
    texts = [f"aA{chr(c)}Bb" for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3100 or c % 7 == 0 or 0x9F00 < c < 0x11000)]
    texts += ["ΟΔΟΣ ΟΔΟΣ'Α ΣΑΣ", "İSTANBUL İ", "", "_ __ a_", "\u2019s it\u2014is", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(4)
    got = M._by_row(df, "id", "t").toArrow()
    row, words = M._words(got.column("text").combine_chunks())
    found = {i: [] for i in range(len(texts))}
    ids = got.column("id").to_pylist()
    for r, w in zip(row, words.to_pylist(), strict=True):
        found[ids[r]].append(w)
    assert found == {r.id: r.w or [] for r in df.select("id", word_terms("t").alias("w")).collect()}


def test_tasks_that_count_terms_are_more_for_more_texts(spark, monkeypatch):
    monkeypatch.setattr(M, "TASK_TEXTS", 10)
    df = spark.range(95).selectExpr("id", "'a text' as t")
    assert M._by_row(df, "id", "t").rdd.getNumPartitions() == 10
    assert M._by_row(df.limit(5), "id", "t").rdd.getNumPartitions() == max(4, spark.sparkContext.defaultParallelism)
