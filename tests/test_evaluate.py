"""E1-E12 against recorded arithmetic and brute-force NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.operators import evaluate as E


def expand_counts(spark, tn, fp, fn, tp):
    rows = [(0, 0.1)] * tn + [(0, 0.9)] * fp + [(1, 0.1)] * fn + [(1, 0.9)] * tp
    return spark.createDataFrame(rows, "label int, score double")


def test_recorded_confusion_metrics(spark):
    df = expand_counts(spark, 851, 300, 481, 3008)
    cm = E.confusion_matrix(df).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (851, 300, 481, 3008)
    m = E.classification_metrics(df).first()
    assert (m.accuracy, m.f1_fake, m.f1_real, m.f1_macro) == (0.8317, 0.6855, 0.8851, 0.7853)
    assert (m.precision_macro, m.recall_macro) == (0.7741, 0.8007)


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_auc_matches_bruteforce_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.6 + 0.4 * y, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = E.roc_auc(df, digits=None).first()[0]
    assert got == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_auc_large_path_and_groups(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g in ("a", "b"):
        y = rng.integers(0, 2, 200)
        s = np.round(rng.random(200), 2)
        rows += [(g, int(a), float(b)) for a, b in zip(y, s)]
    df = spark.createDataFrame(rows, "m string, label int, score double")
    got = {r.m: r.auc_roc for r in E.roc_auc(df, group_cols=["m"], digits=None).collect()}
    unscored = df.unionByName(df.selectExpr("m", "label", "cast(null as double) as score"))
    assert got == {r.m: r.auc_roc for r in E.roc_auc(unscored, group_cols=["m"], digits=None).collect()}
    for g in ("a", "b"):
        sub = [(y, s) for m, y, s in rows if m == g]
        y = np.array([a for a, _ in sub]); s = np.array([b for _, b in sub])
        assert got[g] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.8)], "label int, score double")
    assert E.roc_auc(df).first()[0] is None


def test_roc_curve_points(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, score double")
    pts = {r.threshold: (r.fpr, r.tpr) for r in E.roc_curve(df).collect()}
    assert pts == {0.8: (0.0, 0.5), 0.4: (0.5, 0.5), 0.35: (0.5, 1.0), 0.1: (1.0, 1.0)}


def test_error_summary_and_examples(spark):
    df = spark.createDataFrame([(1, 0, 0.9, "a"), (2, 0, 0.6, "b"), (3, 1, 0.2, "c"), (4, 1, 0.7, "d")],
                               "id int, label int, score double, t string")
    s = {r.kind: (r.n, r.mean_confidence) for r in E.error_summary(df).collect()}
    assert s == {"FP": (2, 0.5), "FN": (1, 0.6)}
    ex = E.error_examples(df, "id", "t", k=1).collect()
    assert sorted((r.kind, r.id) for r in ex) == [("FN", 3), ("FP", 1)]


def test_merge_results_prefers_new(spark):
    old = spark.createDataFrame([("a", 0.1, 0.5), ("b", 0.2, 0.6)], "model string, accuracy double, roc_auc double")
    new = spark.createDataFrame([("b", 0.9, 0.9), ("c", 0.3, 0.3)], "model string, accuracy double, auc_roc double")
    got = {r.model: (r.accuracy, r.auc_roc) for r in E.merge_results(old, new).collect()}
    assert got == {"a": (0.1, 0.5), "b": (0.9, 0.9), "c": (0.3, 0.3)}


def test_classification_report_rows(spark):
    df = expand_counts(spark, 851, 300, 481, 3008)
    rep = {r.row: r for r in E.classification_report(df).collect()}
    assert rep["accuracy"].f1 == 0.8317 and rep["fake"].support == 1151 and rep["real"].support == 3489


def test_best_model_tie_goes_first(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "model string, f1_macro double")
    assert E.best_model(df).first().model == "a"


def test_best_epoch_waits_and_stops(spark):
    losses = {
        "falls": [0.9, 0.8, 0.7],
        "stops": [0.9, 0.8, 0.8, 0.9, 0.85, 0.1],  # three epochs without a lower loss: the sixth never ran
        "recovers": [0.9, 0.95, 0.95, 0.5, 0.6],
        "nothing": [None, None, None, None],
        "gap": [None, 0.4, None, 0.3],
    }
    rows = [(m, 10 * i, x) for m, xs in losses.items() for i, x in enumerate(xs)]
    got = {r[0]: tuple(r)[1:] for r in E.best_epoch(spark.createDataFrame(rows, "model string, epoch int, loss double")).collect()}
    assert got == {"falls": (20, 0.7, 3, False), "stops": (10, 0.8, 5, True), "recovers": (30, 0.5, 5, False),
                   "nothing": (None, None, 3, True), "gap": (30, 0.3, 4, False)}


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.3)], "label int, score double")
    exp = -(np.log(0.8) + np.log(0.7)) / 2
    assert E.log_loss(df).first()[0] == pytest.approx(round(exp, 6))
