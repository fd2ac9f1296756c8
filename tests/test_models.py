"""Objectives, calibration, scores, stored models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.operators import models as ML
from veracity.sources import files as S


TEXTS = ["good true fact", "true story told", "fake hoax claim", "hoax fake rumor", "fact true", "rumor claim fake",
         "true true", "fake fake", "true claim", "good story", "hoax story", "rumor told"]
LABELS = [1, 1, 0, 0, 1, 0, 1, 0, 1, 1, 0, 0]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(TEXTS, LABELS))], "doc_id long, text string, label int")


def sample(seed=0, n=300, d=40):
    r = np.random.default_rng(seed)
    x = r.random((n, d)) * (r.random((n, d)) < 0.2)
    y = (x @ r.normal(size=d) + 0.3 * r.normal(size=n) > 0.2).astype(int)
    row, column = np.nonzero(x)
    return x, ML.Sparse(row, column, x[row, column], y, d)


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_gradient_of_the_objective_is_zero_at_the_fit(loss):
    x, s = sample()
    b, c = ML.fit_linear(s, loss)
    y = 2 * s.label - 1
    w = np.where(s.label == 1, len(y) / (2 * s.label.sum()), len(y) / (2 * (1 - s.label).sum()))
    z = y * (x @ b + c)
    slope = -1 / (1 + np.exp(z)) if loss == "logistic" else -2 * np.maximum(0, 1 - z)
    assert np.abs(x.T @ (w * y * slope) + b).max() < 1e-5
    assert abs((w * y * slope).sum() + (c if loss == "squared_hinge" else 0)) < 1e-5


def test_platt_rises_with_the_margin_and_meets_its_targets():
    r = np.random.default_rng(1)
    margin = r.normal(size=500)
    label = (r.random(500) < 1 / (1 + np.exp(-(2 * margin - 0.5)))).astype(int)
    a, b = ML.fit_platt(margin, label)
    assert 1.2 < a < 3 and -1.2 < b < 0.2
    p = 1 / (1 + np.exp(-(a * margin + b)))
    assert p.sum() == pytest.approx(label.sum(), abs=2)


def test_folds_are_stratified():
    label = np.array([0] * 7 + [1] * 50)
    fold = ML.stratified_folds(label)
    assert all(2 <= (fold[label == 0] == k).sum() <= 3 and 16 <= (fold[label == 1] == k).sum() <= 17 for k in range(3))


@pytest.mark.parametrize("fit", [ML.fit_logreg, ML.fit_svm])
def test_scores_of_every_row(spark, labelled, fit, tmpdir_fresh):
    model = fit(labelled, "doc_id", "text")
    docs = labelled.select("doc_id", "text").union(spark.createDataFrame([(90, ""), (91, None), (92, "unseen words")], "doc_id long, text string"))
    got = {r.doc_id: r.score for r in ML.score(model, docs, "doc_id", "text").collect()}
    assert len(got) == 15 and all(0 < p < 1 for p in got.values()) and got[90] == got[91] == got[92]
    assert sum((got[i] > 0.5) == (y == 1) for i, y in enumerate(LABELS)) >= 11
    S.save_model(model, tmpdir_fresh + "/model")
    again = {r.doc_id: r.score for r in ML.score(S.load_model(spark, tmpdir_fresh + "/model"), docs, "doc_id", "text").collect()}
    assert again == pytest.approx(got)


def test_tournament(labelled):
    out = ML.model_tournament(labelled, labelled, "doc_id", "text")
    assert {(r.model, r["count"]) for r in out.groupBy("model").count().collect()} == {(m, 12) for m in ML.MODELS}


def test_linear_score_matches_formula(spark):
    from veracity.operators import features as M
    df = spark.createDataFrame([(0, "aa bb"), (1, "")], "doc_id long, text string")
    vocab, w = M.tfidf_fit_transform(df, "doc_id", "text")
    coef = vocab.select("term", F.lit(1.0).alias("coef"))
    got = {r.doc_id: r.score for r in ML.linear_score(df, w, coef, "doc_id").collect()}
    wt = {r.term: r.weight for r in w.collect()}
    assert got[0] == pytest.approx(1 / (1 + np.exp(-sum(wt.values()))))
    assert got[1] == 0.5


# --- fits on executors ---------------------------------------------------------------
def stored(spark, s, parts=3):
    cells = [([], []) for _ in s.label]
    for r, c, v in zip(s.row.tolist(), s.column.tolist(), s.value.tolist(), strict=True):
        cells[r][0].append(c)
        cells[r][1].append(v)
    rows = [(int(y), i, v) for y, (i, v) in zip(s.label, cells, strict=True)]
    return spark.createDataFrame(rows, "label int, indices array<int>, weights array<double>").repartition(parts)


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_sums_over_executors_equal_those_in_memory(spark, loss, monkeypatch):
    _, s = sample(n=60, d=9)
    monkeypatch.setattr(ML, "FAN_IN", 2)  # so that seven tasks' vectors are added up in three levels
    far, near = ML.SparkRows(stored(spark, s, 7), s.width, loss, 0.5), ML.Local(s, loss, 0.5)
    r = np.random.default_rng(0)
    theta, v = r.normal(size=s.width + 1), r.normal(size=s.width + 1)
    assert far.value(theta) == pytest.approx(near.value(theta), rel=1e-12)
    assert far.slope(theta) == pytest.approx(near.slope(theta), rel=1e-9, abs=1e-12)
    assert far.bend(theta)(v) == pytest.approx(near.bend(theta)(v), rel=1e-9, abs=1e-12)
    got = sorted((round(x.margin, 9), x.label) for x in far.margins(theta).collect())
    assert got == sorted((round(m, 9), int(y)) for m, y in zip(near._margin(theta), s.label, strict=True))


def test_platt_on_executors_equals_that_in_memory(spark):
    r = np.random.default_rng(1)
    margin = r.normal(size=200)
    label = (r.random(200) < 1 / (1 + np.exp(-(2 * margin - 0.5)))).astype(int)
    rows = spark.createDataFrame(list(zip(margin.tolist(), label.tolist(), strict=True)), "margin double, label int")
    assert ML.fit_platt_on_executors(rows) == pytest.approx(ML.fit_platt(margin, label), abs=1e-6)


@pytest.mark.parametrize("fit", [ML.fit_logreg, ML.fit_svm])
def test_all_rows_fit_on_executors_is_a_minimum(spark, labelled, fit, monkeypatch):
    """More rows than a sample may hold: none is left out, and the gradient over all of them is zero."""
    monkeypatch.setattr(ML, "fit_sample", None)
    more = labelled.unionByName(labelled.selectExpr("doc_id + 100 AS doc_id", "concat(text, ' ', text) AS text", "label")).unionByName(
        spark.createDataFrame([(300, None, 1), (301, "", 0), (302, "good", None)], labelled.schema))
    model = fit(more, "doc_id", "text", max_rows=None, tol=1e-6)
    vocab, rows = ML.fit_rows(more, "doc_id", "text")
    assert rows.count() == 26 and rows.filter("size(indices) = 0").count() == 2
    coef = {x.term: x.coef for x in model.coef.collect()}
    terms = [x.term for x in vocab.orderBy("index").collect()]
    loss, c = ("logistic", 1) if fit is ML.fit_logreg else ("squared_hinge", ML.CALIBRATION_FOLDS)
    assert len(model.parts) == c
    for k, part in enumerate(model.parts):
        theta = np.array([coef[t][k] for t in terms] + [part[0]])
        own = rows if c == 1 else rows.filter(F.col("fold") != k)
        gradient = ML.SparkRows(own, len(terms), loss, ML.C_REG).slope(theta) + np.append(np.ones(len(terms)), ML.LOSSES[loss][1]) * theta
        assert np.abs(gradient).max() < 1e-4
    scores = {x.doc_id: x.score for x in ML.score(model, more, "doc_id", "text").collect()}
    assert len(scores) == 27 and scores[6] > scores[7]


def test_scores_and_fits_take_no_aggregate_of_n_grams(spark, labelled, monkeypatch):
    """No table of all counts is stored for a fit or a tournament, and a task that scores keeps sums by document only."""
    from veracity.operators import features as M
    monkeypatch.setattr(M, "_counts_of_rows", None)
    model = ML.fit_logreg(labelled, "doc_id", "text")
    plan = ML.score(model, labelled, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and not any("term" in x.split("functions")[0] for x in plan.split("HashAggregate(keys=")[1:])
    weights = M.tfidf_transform(labelled, model.vocab, "doc_id", "text")
    key = lambda t: {r.doc_id: r.score for r in t.collect()}
    assert key(ML.score(model, labelled, "doc_id", "text", weights)) == pytest.approx(key(ML.score(model, labelled, "doc_id", "text")))
    assert ML.model_tournament(labelled, labelled, "doc_id", "text").count() == 12 * len(ML.MODELS)


def test_linear_score_of_repeated_ids(spark):
    """Rows that share an id, or have none, are one document, whatever task counts them."""
    from veracity.operators import features as M
    df = spark.createDataFrame([(0, "aa bb"), (1, "aa"), (1, "cc aa"), (None, "bb"), (None, "bb cc"), (2, None)], "doc_id long, text string")
    vocab, weights = M.tfidf_fit_transform(df, "doc_id", "text")
    _, want = vocab, M.tfidf_transform(df, vocab, "doc_id", "text", counts=M.term_counts(df, "doc_id", "text"))
    coef = vocab.select("term", (F.col("index") - 1.5).alias("coef"))
    key = lambda w: sorted(((r.doc_id is None, r.doc_id or 0, round(r.score, 12)) for r in ML.linear_score(df, w, coef, "doc_id").collect()))
    assert key(weights) == key(want) and len(key(weights)) == 6
    assert {r.term: r.tf for r in M.term_counts(df, "doc_id", "text").filter("doc_id = 1").collect()} == {"aa": 2, "cc": 1, "cc aa": 1}


# --- whole jobs ----------------------------------------------------------------------
@pytest.mark.parametrize("name", ["logreg_scores", "svm_scores", "model_tournament"])
def test_queries_fit_on_every_labelled_row(spark, labelled, name, monkeypatch):
    """More rows than were once sampled come down to the fit; none is chosen, and none goes to the driver."""
    from veracity.plans import catalog as Q
    n, seen = 10_400, []
    texts = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 7).alias("text"))
    train = texts.withColumn("label", (F.col("doc_id") % 4 != 0).cast("int"))
    monkeypatch.setattr(Q, "_train_test", lambda spark, d: (train, train.filter("doc_id < 40")))
    monkeypatch.setattr(Q.X, "documents", lambda spark, d: texts.filter("doc_id < 40"))
    monkeypatch.setattr(ML, "fit_sample", None)
    init, newton = ML.SparkRows.__init__, ML._newton
    monkeypatch.setattr(ML, "_newton", lambda width, on_intercept, tol, steps: newton(width, on_intercept, tol, 1))  # which rows, not how far

    def noted(self, rows, *rest, **named):
        seen.append(rows.groupBy("fold").count().collect())
        init(self, rows, *rest, **named)
    monkeypatch.setattr(ML.SparkRows, "__init__", noted)
    assert Q.QUERIES[name](spark, "").count() == (len(ML.MODELS) if name == "model_tournament" else 40)
    assert seen and all(sum(r["count"] for r in x) == n and max(r["count"] for r in x) - min(r["count"] for r in x) <= 2 for x in seen)


def test_folds_on_executors_are_those_in_memory(spark):
    """The rows of a class take turns by the hash of the id; the terms of an id that several rows have are held by one of them."""
    ids = [*range(60), 7, 7, 8, None]
    rows = spark.createDataFrame([(i, f"common x{i}", 1 if i is None else int(i % 3 > 0)) for i in ids], "doc_id long, text string, label int")
    _, x = ML.fit_sample(rows, "doc_id", "text", "label", 1000)
    want = sorted(zip(x.label.tolist(), ML.stratified_folds(x.label).tolist(), np.bincount(x.row, minlength=len(x.label)).tolist(), strict=True))
    got = [(r.label, r.fold, len(r.indices)) for r in ML.fit_rows(rows, "doc_id", "text")[1].collect()]
    assert sorted(x[:2] for x in got) == sorted(x[:2] for x in want)
    assert sorted(x[2] for x in got) == sorted(x[2] for x in want) and len(got) == 64


def test_folds_share_passes(spark):
    """Fits that run together end where each ends alone, and take no more passes than the longest."""
    _, s = sample(n=90, d=8)
    fold = ML.stratified_folds(s.label)
    rows = stored(spark, s, 1).withColumn("place", F.monotonically_increasing_id()).join(
        spark.createDataFrame(list(enumerate(fold.tolist())), "place long, fold int"), "place").drop("place").coalesce(1).sortWithinPartitions("fold").localCheckpoint()
    objectives = [ML.SparkRows(rows, s.width, "squared_hinge", 1.0, without=k) for k in range(3)]
    passes = []
    first = objectives[0]
    answers = ML.SparkRows.answers
    first.answers = lambda asked: passes.append(len(asked)) or answers(first, asked)
    for k, theta in enumerate(ML.newton_together(objectives)):
        b, c = ML.fit_linear(s.only(fold != k), "squared_hinge")
        assert theta == pytest.approx(np.append(b, c), abs=1e-6)
    assert passes[0] == 3 and len(passes) < sum(passes) / 2
