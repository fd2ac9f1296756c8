"""Evaluation operators over ``(label, score)`` tables.

``label`` is 1 = real / 0 = fake and ``score`` is P(real). Every metric is an
aggregate, optionally per ``group_cols`` (e.g. one row per model), so a model
tournament is one grouped job rather than one job per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.common import as_col
from veracity.operators.prefix import prefix_sums

CLASS_THRESHOLD = 0.5  # p >= 0.5 is class 1 when evaluating
PATIENCE = 3  # epochs without a lower validation loss


def class_counts(df: DataFrame, label: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """A1: total / fake / real rows."""
    lab = F.col(label)
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(lab == 0).alias("n_fake"),
        F.count_if(lab == 1).alias("n_real"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A2: distinct events (``unique()``)."""
    return df.select(col).distinct()


def predicted_class(score, threshold: float = CLASS_THRESHOLD):
    """P10: ``(p >= threshold)`` as int."""
    return (as_col(score) >= F.lit(threshold)).cast("int")


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = CLASS_THRESHOLD, group_cols: Sequence[str] = ()) -> DataFrame:
    """TN / FP / FN / TP with positive = real (label 1)."""
    y = F.col(label)
    p = F.col(score) >= F.lit(threshold)
    return df.groupBy(*group_cols).agg(
        F.count_if((y == 0) & ~p).alias("tn"),
        F.count_if((y == 0) & p).alias("fp"),
        F.count_if((y == 1) & ~p).alias("fn"),
        F.count_if((y == 1) & p).alias("tp"),
    )


def _ratio(num, den):
    """sklearn's zero_division=0: 0 when undefined."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metrics_from_counts(cm: DataFrame, group_cols: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """E2-E4 from E1 counts. Macro averages run over the classes present in
    either the labels or the predictions, as sklearn does."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    f1_real = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_fake = _ratio(2 * tn, 2 * tn + fn + fp)
    prec_real, prec_fake = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    rec_real, rec_fake = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    has_real = (tp + fn + fp > 0).cast("double")
    has_fake = (tn + fp + fn > 0).cast("double")
    k = has_real + has_fake

    def macro(a_fake, a_real):
        return _ratio(a_fake * has_fake + a_real * has_real, k)

    r = lambda c: F.round(c, digits)
    return cm.select(
        *group_cols,
        r(_ratio(tp + tn, n)).alias("accuracy"),
        r(macro(prec_fake, prec_real)).alias("precision_macro"),
        r(macro(rec_fake, rec_real)).alias("recall_macro"),
        r(macro(f1_fake, f1_real)).alias("f1_macro"),
        r(f1_fake).alias("f1_fake"),
        r(f1_real).alias("f1_real"),
    )


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score",
                           threshold: float = CLASS_THRESHOLD, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro precision/recall, F1 fake/real/macro."""
    return metrics_from_counts(confusion_matrix(df, label, score, threshold, group_cols), group_cols)


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = CLASS_THRESHOLD, digits: int = 4) -> DataFrame:
    """E5: per-class precision / recall / F1 / support plus accuracy, macro and
    weighted averages - five rows computed from one E1 aggregate."""
    cm = confusion_matrix(df, label, score, threshold)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    s_fake, s_real = tn + fp, tp + fn
    p_f, p_r = _ratio(tn, tn + fn), _ratio(tp, tp + fp)
    r_f, r_r = _ratio(tn, tn + fp), _ratio(tp, tp + fn)
    f_f, f_r = _ratio(2 * tn, 2 * tn + fn + fp), _ratio(2 * tp, 2 * tp + fp + fn)
    acc = _ratio(tp + tn, n)
    rows = F.array(
        F.struct(F.lit("fake").alias("row"), p_f.alias("precision"), r_f.alias("recall"), f_f.alias("f1"), s_fake.alias("support")),
        F.struct(F.lit("real").alias("row"), p_r.alias("precision"), r_r.alias("recall"), f_r.alias("f1"), s_real.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p_f + p_r) / 2).alias("precision"), ((r_f + r_r) / 2).alias("recall"),
                 ((f_f + f_r) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), _ratio(p_f * s_fake + p_r * s_real, n).alias("precision"),
                 _ratio(r_f * s_fake + r_r * s_real, n).alias("recall"),
                 _ratio(f_f * s_fake + f_r * s_real, n).alias("f1"), n.alias("support")),
    )
    out = cm.select(F.inline(rows))
    return out.select(
        "row",
        F.round("precision", digits).alias("precision"),
        F.round("recall", digits).alias("recall"),
        F.round("f1", digits).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
    )


def _score_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str]) -> DataFrame:
    """Rows without a score have no place on the curve and are left out."""
    y = F.col(label)
    return df.filter(F.col(score).isNotNull()).groupBy(*group_cols, F.col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            group_cols: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """Exact ROC-AUC (Mann-Whitney, ties at half credit).

    ``groupBy(score)`` -> distributed running count of negatives -> one sum.
    A single-class input has no AUC (null)."""
    g = _score_counts(df, label, score, group_cols)
    c = prefix_sums(g, ["score"], ["neg"], group_cols)
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5)
    agg = c.groupBy(*group_cols).agg(
        F.sum(contrib).alias("u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    auc = F.when(den > 0, F.col("u") / den)
    if digits is not None:
        auc = F.round(auc, digits)
    return agg.select(*group_cols, auc.alias("auc_roc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """One ``(threshold, fpr, tpr)`` point per distinct score, where the
    rates count rows with ``score >= threshold`` (no intermediate dropping)."""
    g = _score_counts(df, label, score, group_cols).withColumn("__desc", -F.col("score"))
    c = prefix_sums(g, ["__desc"], ["pos", "neg"], group_cols)
    if group_cols:
        totals = g.groupBy(*group_cols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
        c = c.join(totals, on=list(group_cols), how="inner")
        n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    else:
        # two class counts reach the driver - a bounded result
        row = g.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
        n_pos, n_neg = F.lit(row["p"] or 0), F.lit(row["n"] or 0)
    return c.select(
        *group_cols,
        F.col("score").alias("threshold"),
        F.round(_ratio(F.col("cum_neg").cast("double"), n_neg.cast("double")), digits).alias("fpr"),
        F.round(_ratio(F.col("cum_pos").cast("double"), n_pos.cast("double")), digits).alias("tpr"),
    )


def confidence(score) -> "F.Column":
    """Decision confidence ``2 * |p - 0.5|`` (the monitor's formula)."""
    return F.abs(as_col(score) - F.lit(0.5)) * F.lit(2.0)


def error_kind(label, score, threshold: float = CLASS_THRESHOLD):
    """FP = fake predicted real; FN = real predicted fake; null when correct."""
    y, p = as_col(label), as_col(score) >= F.lit(threshold)
    return F.when((y == 0) & p, F.lit("FP")).when((y == 1) & ~p, F.lit("FN"))


def error_summary(df: DataFrame, label: str = "label", score: str = "score",
                  threshold: float = CLASS_THRESHOLD, digits: int = 4) -> DataFrame:
    """Count and mean confidence per error kind."""
    e = df.select(error_kind(label, score, threshold).alias("kind"), confidence(score).alias("conf"))
    return (
        e.filter(F.col("kind").isNotNull())
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("conf"), digits).alias("mean_confidence"))
    )


def error_examples(df: DataFrame, id_col: str, text_col: str, label: str = "label",
                   score: str = "score", k: int = 10, threshold: float = CLASS_THRESHOLD,
                   digits: int = 6) -> DataFrame:
    """Top-k most confident examples per error kind.

    ``row_number() <= k`` over a window lets Catalyst place a
    ``WindowGroupLimit`` before the shuffle, so a kind holding most rows still
    ships only ``k`` rows per map task."""
    e = df.select(
        id_col, text_col,
        error_kind(label, score, threshold).alias("kind"),
        confidence(score).alias("conf"),
    ).filter(F.col("kind").isNotNull())
    w = Window.partitionBy("kind").orderBy(F.col("conf").desc(), F.col(id_col).asc())
    return (
        e.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("kind", F.col("rank").cast("int").alias("rank"), id_col, text_col,
                F.round("conf", digits).alias("confidence"))
    )


def log_loss(df: DataFrame, label: str = "label", score: str = "score",
             eps: float = 1e-15, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Mean binary cross-entropy of P(real), clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    bce = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.groupBy(*group_cols).agg(F.round(F.avg(bce), digits).alias("log_loss"))


def model_comparison(scored: DataFrame, model_col: str = "model", label: str = "label",
                     score: str = "score", threshold: float = CLASS_THRESHOLD) -> DataFrame:
    """Accuracy / F1 macro / F1 fake / F1 real / AUC per model, from a
    long ``(model, label, score)`` table.

    One ``groupBy(model, score)`` feeds everything: the running count of
    negatives gives the AUC and the same rows, split at the threshold, give
    the confusion counts, so the scored table is read once."""
    g = _score_counts(scored, label, score, [model_col])
    c = prefix_sums(g, ["score"], ["neg"], [model_col])
    hi = F.col("score") >= F.lit(threshold)
    zero = F.lit(0).cast("bigint")
    agg = c.groupBy(model_col).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5)).alias("u"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.when(~hi, F.col("neg")).otherwise(zero)).alias("tn"),
        F.sum(F.when(hi, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(~hi, F.col("pos")).otherwise(zero)).alias("fn"),
        F.sum(F.when(hi, F.col("pos")).otherwise(zero)).alias("tp"),
    )
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    agg = agg.withColumn("auc_roc", F.round(F.when(den > 0, F.col("u") / den), 4))
    m = metrics_from_counts(agg, [model_col, "auc_roc"])
    return m.select(model_col, "accuracy", "f1_macro", "f1_fake", "f1_real", "auc_roc")


def best_model(results: DataFrame, model_col: str = "model", metric: str = "f1_macro",
               order_col: str | None = None) -> DataFrame:
    """Strictly-best metric wins; ties go to the earliest candidate
    (``order_col`` ascending, else the model name)."""
    order = F.col(order_col) if order_col else F.col(model_col)
    ranked = results.select(model_col, metric, order.alias("__o"))
    return ranked.orderBy(F.col(metric).desc(), F.col("__o").asc()).limit(1).select(model_col, metric)


def best_epoch(history: DataFrame, model_col: str = "model", epoch_col: str = "epoch", loss_col: str = "loss",
               patience: int = PATIENCE) -> DataFrame:
    """Per model the epoch of the lowest validation loss, where training
    ends after ``patience`` epochs in a row without a lower one.

    ``history`` has a row for each model and epoch. Later epochs don't count,
    however low; the first of equal losses wins; a null loss is no
    improvement, and a model without any loss has no best epoch. Returns
    ``model, best_epoch, best_loss, epochs_run, stopped_early``."""
    upto = Window.partitionBy(model_col).orderBy(epoch_col)
    place = F.row_number().over(upto)
    lowest = F.min(loss_col).over(upto.rowsBetween(Window.unboundedPreceding, -1))
    lower = F.col(loss_col).isNotNull() & (lowest.isNull() | (F.col(loss_col) < lowest))
    marked = history.select(model_col, F.col(epoch_col).alias("__epoch"), F.col(loss_col).alias("__loss"), place.alias("__place"), lower.alias("__lower"))
    upto = Window.partitionBy(model_col).orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    waited = F.col("__place") - F.coalesce(F.max(F.when(F.col("__lower"), F.col("__place"))).over(upto), F.lit(0))
    ended = marked.withColumn("__waited", waited).withColumn(
        "__end", F.min(F.when(F.col("__waited") >= patience, F.col("__place"))).over(Window.partitionBy(model_col)))
    run = ended.filter(F.col("__end").isNull() | (F.col("__place") <= F.col("__end")))
    best = F.max(F.when(F.col("__lower"), F.struct("__place", "__epoch", "__loss")))
    return run.groupBy(model_col).agg(best.alias("__best"), F.max("__place").cast("bigint").alias("epochs_run"), F.bool_or(F.col("__end").isNotNull()).alias("stopped_early")).select(
        model_col, F.col("__best.__epoch").alias("best_epoch"), F.col("__best.__loss").alias("best_loss"), "epochs_run", "stopped_early")


def merge_results(existing: DataFrame, new: DataFrame, key: str = "model") -> DataFrame:
    """Upsert by key - the new record replaces the old one. A legacy
    ``roc_auc`` column is read as ``auc_roc`` when the latter is absent."""

    def normalise(df: DataFrame) -> DataFrame:
        if "roc_auc" in df.columns and "auc_roc" not in df.columns:
            df = df.withColumnRenamed("roc_auc", "auc_roc")
        return df

    old, nw = normalise(existing), normalise(new)
    metrics = [c for c in nw.columns if c != key]
    for c in old.columns:
        if c != key and c not in metrics:
            metrics.append(c)
    o = old.select(key, F.struct(*[(F.col(c) if c in old.columns else F.lit(None)).alias(c) for c in metrics]).alias("__old"))
    n = nw.select(key, F.struct(*[(F.col(c) if c in nw.columns else F.lit(None)).alias(c) for c in metrics]).alias("__new"))
    j = o.join(n, on=key, how="full_outer")
    rec = F.when(F.col("__new").isNotNull(), F.col("__new")).otherwise(F.col("__old"))
    return j.select(key, *[rec[c].alias(c) for c in metrics])
