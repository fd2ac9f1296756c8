"""Drift monitoring operators.

Everything is an aggregate over score tables: a side is reduced once to its
rows by score, with running counts (:func:`score_table`), and quantiles, bins
and KS all come from that. Only bounded values reach the driver: a row count,
at most eleven quantile edges and bin counts, ``(D, n1, n2)`` for the KS
p-value, and per-range offsets inside :mod:`veracity.operators.prefix`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.common import as_col
from veracity.functions.text import relevant
from veracity.operators import kstest
from veracity.operators.prefix import prefix_sums
from veracity.session import materialize

# --- fixed values that must equal the reference's -----------------------------
RELEVANCY_MIN = 0.30
CONFIDENCE_MIN = 0.30
KS_ALPHA = 0.05
PSI_STABLE = 0.10
PSI_MODERATE = 0.25
PSI_EPS = 1e-4
PSI_BINS = 10
# US political relevancy keywords (monitor)
POLITICAL_KEYWORDS = [
    "iran", "iranian", "irgc", "tehran", "khamenei", "strait of hormuz",
    "airstrike", "us strikes", "nuclear deal", "sanctions", "persian gulf",
    "houthis", "proxy war", "iran missile", "iran attack", "middle east",
    "congress", "white house", "biden", "trump", "senate", "election",
    "democrat", "republican", "washington", "president", "pentagon",
    "legislation", "vote", "ballot", "campaign", "policy",
]


# --- A3-A5 ------------------------------------------------------------------
def relevancy_rate(df: DataFrame, text_col: str, keywords: Sequence[str],
                   group_cols: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """A3: share of rows whose lower-cased text contains any keyword. Null
    text counts as not relevant but stays in the denominator."""
    flag = relevant(text_col, keywords).cast("double")
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.round(F.avg(flag), digits).alias("relevancy_rate"),
    )


def score_summary(df: DataFrame, score: str = "score", group_cols: Sequence[str] = (),
                  digits: int = 4) -> DataFrame:
    """A4/A5: mean decision confidence ``mean(|p-0.5|)*2`` and population std."""
    s = F.col(score)
    return df.groupBy(*group_cols).agg(
        F.count(s).alias("n_scores"),
        F.round(F.avg(F.abs(s - 0.5)) * 2.0, digits).alias("avg_confidence"),
        F.round(F.stddev_pop(s), digits).alias("pred_std"),
    )


# --- A9 quantiles --------------------------------------------------------------
def percentile_positions(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """NumPy 'linear' method: virtual index p*(n-1) -> (lo, hi, gamma)."""
    out = []
    for p in probs:
        v = p * (n - 1)
        lo = int(math.floor(v))
        hi = min(lo + 1, n - 1)
        out.append((lo, hi, v - lo))
    return out


def lerp(a, b, t: float):
    """NumPy's ``_lerp``: ``a + (b-a)*t``, computed from ``b`` when t >= 0.5; of columns or numbers."""
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


def decile_probs(n_bins: int = PSI_BINS) -> list[float]:
    """``np.linspace(0, 100, n_bins + 1) / 100``."""
    return [(100.0 * i / n_bins) / 100.0 for i in range(n_bins + 1)]


def exact_quantiles(df: DataFrame, score: str = "score", probs: Sequence[float] | None = None) -> DataFrame:
    """Exact ``np.percentile(..., method='linear')`` without sorting all
    rows in one task: ``groupBy(score)`` -> distributed running count -> keep
    the rows that cover the ranks ``floor/ceil(p*(n-1))`` -> interpolate.

    Returns ``(q_index int, prob double, quantile double)``; empty input gives
    null quantiles."""
    probs = list(probs if probs is not None else decile_probs())
    spark = df.sparkSession
    g = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    c = prefix_sums(g, ["x"], ["n"])
    n = c.agg(F.max("cum_n").alias("n")).first()["n"] or 0  # one scalar
    if n == 0:
        return spark.createDataFrame(
            [(i, float(p), None) for i, p in enumerate(probs)],
            "q_index int, prob double, quantile double",
        )
    pos = percentile_positions(n, probs)
    ranks = sorted({r for lo, hi, _ in pos for r in (lo, hi)})
    rank_arr = F.array(*[F.lit(r).cast("bigint") for r in ranks])
    hits = c.select(
        "x",
        F.explode(F.filter(rank_arr, lambda r: (r >= F.col("cum_n") - F.col("n")) & (r < F.col("cum_n")))).alias("rank"),
    )
    vals = hits.agg(*[F.max(F.when(F.col("rank") == r, F.col("x"))).alias(f"r{r}") for r in ranks])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("q_index"),
            F.lit(float(p)).alias("prob"),
            lerp(F.col(f"r{lo}"), F.col(f"r{hi}"), gamma).alias("quantile"),
        )
        for i, (p, (lo, hi, gamma)) in enumerate(zip(probs, pos))
    ])
    return vals.select(F.inline(rows))


# --- A10 histogram -------------------------------------------------------------
def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """``np.histogram`` bin of ``x``: half-open bins, the last one closed;
    null outside ``[edges[0], edges[-1]]``."""
    k = len(edges) - 1
    idx = F.lit(0)
    for e in edges[1:-1]:
        idx = idx + (x >= F.lit(float(e))).cast("int")
    inside = (x >= F.lit(float(edges[0]))) & (x <= F.lit(float(edges[-1])))
    return F.when(inside & F.lit(k > 0), idx)


def histogram(df: DataFrame, col: str, edges: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """A10: ``(bin, lower, upper, n)`` for every bin, zero bins included.

    One conditional aggregate per bin: no shuffle of data rows, only partial
    aggregates, so a value holding a third of all rows costs nothing extra."""
    k = len(edges) - 1
    b = bin_index(F.col(col), edges)
    agg = df.groupBy(*group_cols).agg(*[F.count_if(b == j).alias(f"b{j}") for j in range(k)])
    rows = F.array(*[
        F.struct(F.lit(j).alias("bin"), F.lit(float(edges[j])).alias("lower"),
                 F.lit(float(edges[j + 1])).alias("upper"), F.col(f"b{j}").alias("n"))
        for j in range(k)
    ])
    return agg.select(*group_cols, F.inline(rows))


# --- one table of both sides --------------------------------------------------------
def score_table(ref: DataFrame, new: DataFrame | None = None, score: str = "score") -> DataFrame:
    """``x, r_all, w_all, r, w, cum_r, cum_w``: rows of the reference and of the
    new side at each score, and running counts. A row without a score counts
    in ``r_all`` and ``w_all`` only. Either side is read once."""
    sides = ref.select(F.col(score).alias("x"), F.lit(1).alias("r"), F.lit(0).alias("w"))
    if new is not None:
        sides = sides.unionByName(new.select(F.col(score).alias("x"), F.lit(0).alias("r"), F.lit(1).alias("w")))
    counts = sides.groupBy("x").agg(F.sum("r").alias("r_all"), F.sum("w").alias("w_all"))
    scored = {c: F.when(F.col("x").isNotNull(), F.col(f"{c}_all")).otherwise(F.lit(0).cast("bigint")) for c in ("r", "w")}
    return prefix_sums(counts.withColumns(scored), ["x"], ["r", "w"])


class Reference(NamedTuple):
    """What PSI takes from a reference: edges, rows in each bin, and all rows, those without a score too."""

    edges: list[float]
    counts: list[int]
    n: int


def reference_bins(table: DataFrame, n_bins: int = PSI_BINS) -> Reference:
    """Reference deciles with the ends forced to 0 and 1 and duplicates
    removed, and the reference's rows between them, from a :func:`score_table`."""
    total = table.agg(F.sum("r").alias("n"), F.sum("r_all").alias("n_all")).first()
    if not total["n"]:
        return Reference([], [], total["n_all"] or 0)
    places = percentile_positions(total["n"], decile_probs(n_bins))
    ranks = sorted({r for lo, hi, _ in places for r in (lo, hi)})
    covers = [(F.col("cum_r") - F.col("r") <= r) & (F.col("cum_r") > r) for r in ranks]
    at = dict(zip(ranks, table.agg(*[F.max(F.when(c, F.col("x"))) for c in covers]).first(), strict=True))
    inner = [lerp(at[lo], at[hi], gamma) for lo, hi, gamma in places[1:-1]]
    edges = sorted({0.0, *inner, 1.0})
    b = bin_index(F.col("x"), edges)
    zero = F.lit(0).cast("bigint")
    counts = table.agg(*[F.sum(F.when(b == j, F.col("r")).otherwise(zero)) for j in range(len(edges) - 1)]).first()
    return Reference(edges, list(counts), total["n_all"])


# --- D1/D2 PSI -------------------------------------------------------------------
def psi_edges(ref: DataFrame, score: str = "score", n_bins: int = PSI_BINS) -> list[float]:
    """Reference deciles with the ends forced to 0 and 1, duplicates removed."""
    return reference_bins(score_table(ref, score=score), n_bins).edges


def psi_label(psi) -> Column:
    """D2."""
    p = as_col(psi)
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p < PSI_STABLE, F.lit("STABLE"))
        .when(p < PSI_MODERATE, F.lit("MODERATE"))
        .otherwise(F.lit("SIGNIFICANT"))
    )


def _psi_from_counts(cols_ref: list[Column], cols_new: list[Column], n_ref: Column, n_new: Column,
                     eps: float) -> Column:
    total = F.lit(0.0)
    for r, nw in zip(cols_ref, cols_new):
        rf = F.greatest(r.cast("double") / n_ref, F.lit(eps))
        nf = F.greatest(nw.cast("double") / n_new, F.lit(eps))
        total = total + (nf - rf) * F.log(nf / rf)
    return total


def psi(ref: DataFrame, new: DataFrame, score: str = "score", n_bins: int = PSI_BINS,
        eps: float = PSI_EPS, group_cols: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Population stability index of ``new`` (per group) against ``ref``.

    Fractions are over *all* rows of a side, including out-of-range ones."""
    bins = reference_bins(score_table(ref, score=score), n_bins)
    return psi_against(bins, new.withColumn("__c", F.lit(1).cast("bigint")), score, "__c", eps, group_cols, digits)


def psi_against(ref: Reference, new: DataFrame, score: str, count: str, eps: float = PSI_EPS,
                group_cols: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """PSI of rows with a weight ``count`` against a reference's bins."""
    k = len(ref.edges) - 1
    b = bin_index(F.col(score), ref.edges) if k >= 1 else None
    zero = F.lit(0).cast("bigint")
    agg = new.groupBy(*group_cols).agg(
        F.sum(count).alias("__n"), *[F.sum(F.when(b == j, F.col(count)).otherwise(zero)).alias(f"__b{j}") for j in range(k)])
    val = F.lit(None).cast("double")
    if k >= 1:
        raw = _psi_from_counts([F.lit(c) for c in ref.counts], [F.col(f"__b{j}") for j in range(k)],
                               F.lit(float(ref.n)), F.col("__n").cast("double"), eps)
        val = F.when(F.col("__n") > 0, F.round(raw, digits))
    return agg.select(*group_cols, val.alias("psi"), psi_label(val).alias("psi_status"))


# --- D3/D4 KS --------------------------------------------------------------------
def ks_statistic(ref: DataFrame, new: DataFrame, score: str = "score", digits: int | None = 4) -> DataFrame:
    """D3: two-sample KS statistic ``sup |F_ref - F_new|`` plus both sizes.

    One ``max`` over a :func:`score_table`; returns one row
    ``(ks_statistic, n_ref, n_new)``."""
    return ks_of(score_table(ref, new, score), digits)


def ks_of(table: DataFrame, digits: int | None = 4) -> DataFrame:
    """D3 of the two sides of a :func:`score_table`."""
    row = table.agg(F.sum("r").alias("n_ref"), F.sum("w").alias("n_new")).first()
    n_ref, n_new = row["n_ref"] or 0, row["n_new"] or 0
    d = F.lit(None).cast("double")
    if n_ref and n_new:
        d = F.max(F.abs(F.col("cum_r") / F.lit(float(n_ref)) - F.col("cum_w") / F.lit(float(n_new))))
        d = d if digits is None else F.round(d, digits)
    return table.agg(F.count("*"), d.alias("ks_statistic")).select(
        "ks_statistic", F.lit(n_ref).cast("bigint").alias("n_ref"), F.lit(n_new).cast("bigint").alias("n_new"))


def ks_statistic_by_group(ref: DataFrame, new: DataFrame, group_cols: Sequence[str], score: str = "score",
                          digits: int | None = 4) -> DataFrame:
    """D3 per group (D8) without replicating the reference per group; a null group is a group."""
    counts = group_counts(new, group_cols, score)
    return ks_by_group_of(reference_table(ref, counts, score), counts, group_cols, digits)


def group_counts(new: DataFrame, group_cols: Sequence[str], score: str = "score") -> DataFrame:
    """``group, x, c``: rows of each group at each score, those without a score too; checkpointed."""
    return materialize(new.groupBy(*group_cols, F.col(score).alias("x")).agg(F.count(F.lit(1)).alias("c")))


def reference_table(ref: DataFrame, counts: DataFrame, score: str = "score") -> DataFrame:
    """The reference's :func:`score_table` with a row at every score of ``counts`` too."""
    return score_table(ref, counts.select(F.col("x").alias(score)).distinct(), score)


def ks_by_group_of(table: DataFrame, counts: DataFrame, group_cols: Sequence[str], digits: int | None = 4) -> DataFrame:
    """D3 of every group of ``counts`` against the reference side of ``table``.

    ``F_ref`` is evaluated once, globally, at every distinct value seen in the
    reference or in any group; each group's own running count comes from a
    grouped prefix sum; the two meet in an equi-join on the value. At each
    value ``x`` of a group both the right limit and the left limit of
    ``|F_ref - F_g|`` are taken, which covers the supremum between points."""
    return _ks_where(counts, table.select("x", "r", "cum_r"), table.agg(F.sum("r")).first()[0] or 0, group_cols, digits)


def _ks_where(counts: DataFrame, at: DataFrame, n_ref: int, group_cols: Sequence[str], digits: int | None) -> DataFrame:
    """D3 of every group, given ``x, r, cum_r`` of the reference at each of the groups' scores."""
    scored = counts.filter("x is not null")
    own = prefix_sums(scored, ["x"], ["c"], group_cols)
    sizes = scored.groupBy(*[F.col(c).alias(f"__s_{c}") for c in group_cols]).agg(F.sum("c").alias("n_new"))
    same = F.lit(True)
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    j = own.join(at, "x").join(sizes, same)
    d = F.lit(None).cast("double")
    if n_ref:
        fr, fr_l = F.col("cum_r") / F.lit(float(n_ref)), (F.col("cum_r") - F.col("r")) / F.lit(float(n_ref))
        fg, fg_l = F.col("cum_c") / F.col("n_new"), (F.col("cum_c") - F.col("c")) / F.col("n_new")
        d = F.greatest(F.abs(fr - fg), F.abs(fr_l - fg_l))
    return j.groupBy(*group_cols).agg(
        (F.max(d) if digits is None else F.round(F.max(d), digits)).alias("ks_statistic"),
        F.first("n_new").cast("bigint").alias("n_new"),
    ).withColumn("n_ref", F.lit(n_ref).cast("bigint"))


def ks_limit_pvalue(d, en, terms: int = 100) -> Column:
    """Limiting Kolmogorov survival ``2*sum (-1)^(k-1) exp(-2 k^2 lam^2)``,
    ``lam = d*sqrt(en)``, as a Column (D4, 'limit' mode)."""
    lam = as_col(d) * F.sqrt(as_col(en))
    ks = F.sequence(F.lit(1), F.lit(terms))
    s = F.aggregate(
        ks, F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(F.lit(2.0) * s, F.lit(0.0)), F.lit(1.0)))


def ks_pvalue(d, n1, n2, mode: str = "limit") -> Column:
    """D4 under the named law for a table of statistics. The limiting series is
    a native expression; the other laws have no closed form and run in Arrow
    batches, one small computation a row (a row is a snapshot, not an article)."""
    if mode == "limit":
        n1, n2 = as_col(n1).cast("double"), as_col(n2).cast("double")
        return ks_limit_pvalue(d, n1 * n2 / (n1 + n2))
    if mode not in kstest.MODES:
        raise ValueError(f"unknown KS mode {mode!r}")

    @F.pandas_udf("double")
    def law(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) or pd.isna(a) or pd.isna(b) else kstest.two_sample_pvalue(x, int(a), int(b), mode)
                          for x, a, b in zip(d, n1, n2, strict=True)], dtype="float64")

    return law(as_col(d), as_col(n1), as_col(n2))


def ks_test(table: DataFrame, mode: str = "limit") -> dict | None:
    """D3 + D4 of a :func:`score_table`: ``{ks_statistic, p_value, drift_detected}``;
    ``mode`` names the law (:mod:`veracity.operators.kstest`)."""
    row = ks_of(table, digits=None).first()
    if row["ks_statistic"] is None:
        return None
    d, n1, n2 = float(row["ks_statistic"]), int(row["n_ref"]), int(row["n_new"])
    p = kstest.two_sample_pvalue(d, n1, n2, mode=mode)
    return {"ks_statistic": round(d, 4), "p_value": round(p, 4), "drift_detected": bool(p < KS_ALPHA),
            "n_ref": n1, "n_new": n2}


# --- D5-D7 ------------------------------------------------------------------------
def retrain_gate(relevancy, avg_conf, ks_drift, psi_value) -> Column:
    """Null KS/PSI never trigger."""
    return (
        F.coalesce(as_col(relevancy) < RELEVANCY_MIN, F.lit(False))
        | F.coalesce(as_col(avg_conf) < CONFIDENCE_MIN, F.lit(False))
        | F.coalesce(as_col(ks_drift), F.lit(False))
        | F.coalesce(as_col(psi_value) >= PSI_MODERATE, F.lit(False))
    )


def trigger_reasons(relevancy, avg_conf, ks_drift, psi_value) -> Column:
    """Reason codes, in the reference's order."""
    arr = F.array(
        F.when(as_col(relevancy) < RELEVANCY_MIN, F.lit("low_relevancy")),
        F.when(as_col(avg_conf) < CONFIDENCE_MIN, F.lit("low_confidence")),
        F.when(F.coalesce(as_col(ks_drift), F.lit(False)), F.lit("ks_drift")),
        F.when(as_col(psi_value) >= PSI_MODERATE, F.lit("psi_significant")),
    )
    return F.filter(arr, lambda x: x.isNotNull())


def drift_report(new: DataFrame, ref: DataFrame | None, text_col: str = "text", score: str = "score",
                 keywords: Sequence[str] = POLITICAL_KEYWORDS, source_file: str | None = None,
                 ks_mode: str = "limit") -> DataFrame:
    """One-row report. ``ks_*`` and ``psi*`` are null without a reference.

    Texts are read once, for counts, relevancy, confidence and spread; KS and
    PSI come from one table of both sides' scores."""
    s = F.col(score)
    aggs = [
        F.count(F.lit(1)).alias("n_articles"),
        F.round(F.avg(relevant(text_col, keywords).cast("double")), 4).alias("relevancy_rate"),
        F.round(F.avg(F.abs(s - 0.5)) * 2.0, 4).alias("avg_confidence"),
        F.round(F.stddev_pop(s), 4).alias("pred_std"),
    ]
    ks, psi_val = None, F.lit(None).cast("double")
    if ref is not None:
        table = score_table(ref, new, score)
        ks = ks_test(table, ks_mode)
        drifted = psi_against(reference_bins(table), table, "x", "w_all").first()
        psi_val = F.lit(drifted["psi"]).cast("double")
    base = new.agg(*aggs)
    ks_stat = F.lit(ks["ks_statistic"] if ks else None).cast("double")
    ks_p = F.lit(ks["p_value"] if ks else None).cast("double")
    ks_drift = F.lit(ks["drift_detected"] if ks else None).cast("boolean")
    out = base.select(
        F.lit(source_file).cast("string").alias("source_file"),
        "n_articles", "relevancy_rate", "avg_confidence", "pred_std",
        ks_stat.alias("ks_statistic"), ks_p.alias("ks_p_value"), ks_drift.alias("ks_drift_detected"),
        psi_val.alias("psi"), psi_label(psi_val).alias("psi_status"),
    )
    return out.select(
        "*",
        retrain_gate("relevancy_rate", "avg_confidence", "ks_drift_detected", "psi").alias("retrain_needed"),
        F.array_join(trigger_reasons("relevancy_rate", "avg_confidence", "ks_drift_detected", "psi"), ",")
        .alias("reasons"),
    )


def drift_by_snapshot(new: DataFrame, ref: DataFrame, snapshot_col: str, text_col: str = "text",
                      score: str = "score", keywords: Sequence[str] = POLITICAL_KEYWORDS, ks_mode: str = "limit") -> DataFrame:
    """The monitor's metrics for every snapshot in one job family, under
    the same laws (``ks_mode``) and gate as :func:`drift_report`."""
    base = new.groupBy(snapshot_col).agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.round(F.avg(relevant(text_col, keywords).cast("double")), 4).alias("relevancy_rate"),
        F.round(F.avg(F.abs(F.col(score) - 0.5)) * 2.0, 4).alias("avg_confidence"),
        F.round(F.stddev_pop(score), 4).alias("pred_std"),
    )
    counts = group_counts(new, [snapshot_col], score)
    table = reference_table(ref, counts, score)
    ks = ks_by_group_of(table, counts, [snapshot_col], digits=None)
    p = psi_against(reference_bins(table), counts, "x", "c", group_cols=[snapshot_col])
    ks = ks.withColumn("__p", ks_pvalue("ks_statistic", "n_ref", "n_new", ks_mode))
    p_value = F.col("__p")
    ks = ks.select(snapshot_col, F.round("ks_statistic", 4).alias("ks_statistic"),
                   F.round(p_value, 4).alias("ks_p_value"), (p_value < KS_ALPHA).alias("__ks_drift"))
    j = base
    for part in (ks, p):  # a null snapshot is one too
        named = part.withColumnRenamed(snapshot_col, "__s")
        j = j.join(named, F.col(snapshot_col).eqNullSafe(F.col("__s")), "left").drop("__s")
    drift = F.col("__ks_drift")
    return j.select(
        snapshot_col, "n_articles", "relevancy_rate", "avg_confidence", "pred_std",
        "ks_statistic", "ks_p_value", "psi", "psi_status",
        retrain_gate("relevancy_rate", "avg_confidence", drift, "psi").alias("retrain_needed"),
    )


# --- T3: drift from merged counts ---------------------------------------------------
#: Rows of a table that may be broadcast once they were counted, ranges of a stored reference.
BROADCAST_ROWS, REFERENCE_RANGES = 500_000, 64


class ReferenceIndex(NamedTuple):
    """A reference's score table, stored in ranges of its scores, and what PSI takes from it."""

    SCHEMA = "x double, r bigint, r_all bigint, cum_r bigint, range int"

    path: str
    bins: Reference
    n: int
    names: list[int]
    firsts: list[float]
    before: list[int]

    @classmethod
    def stored(cls, ref: DataFrame, path: str, score: str = "score", ranges: int = REFERENCE_RANGES) -> "ReferenceIndex":
        """Writes the table to ``path`` once; a stream that starts again reads what it wrote."""
        spark = ref.sparkSession
        try:
            table = spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            sums = score_table(ref.select(F.col(score).cast("double").alias("x")), score="x").select("x", "r", "r_all", "cum_r")
            total = sums.agg(F.sum("r")).first()[0] or 0
            # equal shares of the rows; a score with more than that is one row, and ranges without any don't exist
            own = F.coalesce(F.floor((F.col("cum_r") - F.col("r")) * ranges / max(total, 1)).cast("int"), F.lit(0))
            sums.withColumn("range", own).repartition("range").write.partitionBy("range").parquet(path)
            table = spark.read.schema(cls.SCHEMA).parquet(path)
        heads = table.filter("x is not null").groupBy("range").agg(F.min("x").alias("x"), F.min(F.col("cum_r") - F.col("r")).alias("b")).orderBy("range").collect()
        bins = reference_bins(table)
        return cls(path, bins, table.agg(F.sum("r")).first()[0] or 0, [r.range for r in heads], [r.x for r in heads], [r.b for r in heads])

    def at(self, values: DataFrame) -> DataFrame:
        """``x, r, cum_r`` for every row of the distinct, non-null scores ``x``: reference rows at it, and up to it.

        A score's range is found among at most ``REFERENCE_RANGES`` first
        scores. Only the ranges that the values lie in are read; values and
        reference rows of a range meet in one window."""
        if not self.firsts:
            return values.select("x", F.lit(0).cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("cum_r"))
        # whole arrays as text: one expression to parse instead of one a number
        firsts, names, before = (f"array({','.join(each.format(v) for v in column)})" for each, column in (
            ("double('{}')", self.firsts), ("{}", self.names), ("{}L", self.before)))
        own = values.select("x", F.expr(f"size(filter({firsts}, f -> f <= x)) - 1").alias("place"))
        met = [self.names[r[0]] for r in own.select("place").distinct().collect() if r[0] >= 0]  # one row a range
        table = own.sparkSession.read.schema(self.SCHEMA).parquet(self.path)
        rows = table.filter(F.col("x").isNotNull() & F.col("range").isin(met))
        both = rows.select("x", F.expr(f"cast(array_position({names}, range) as int) - 1").alias("place"), "r", F.lit(0).alias("w")).unionByName(
            own.select("x", "place", F.lit(0).cast("bigint").alias("r"), F.lit(1).alias("w")))
        cells = both.groupBy("place", "x").agg(F.sum("r").alias("r"), F.max("w").alias("w"))
        running = F.sum("r").over(Window.partitionBy("place").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
        base = F.expr(f"element_at({before}, greatest(place, 0) + 1)")
        return cells.withColumn("cum_r", F.when(F.col("place") < 0, F.lit(0)).otherwise(running + base).cast("bigint")).filter("w = 1").select("x", "r", "cum_r")


def drift_of_counts(counts: DataFrame, index: ReferenceIndex, ks_mode: str = "limit") -> DataFrame:
    """D8 from counts ``(snapshot, x, c, relevant)``: the columns of :func:`drift_by_snapshot`.

    ``counts`` should be stored; it is read for the sums, the KS statistic and the PSI."""
    x, c = F.col("x"), F.col("c").cast("double")
    scored = F.sum(F.when(x.isNotNull(), F.col("c")))
    mean = F.sum(c * x) / scored
    base = counts.groupBy("snapshot").agg(
        F.sum("c").alias("n_articles"), F.round(F.sum("relevant") / F.sum("c"), 4).alias("relevancy_rate"),
        F.round(F.sum(c * F.abs(x - 0.5)) / scored * 2.0, 4).alias("avg_confidence"),
        F.round(F.sqrt(F.greatest(F.sum(c * x * x) / scored - mean * mean, F.lit(0.0))), 4).alias("pred_std"))
    at = index.at(counts.filter("x is not null").select("x").distinct())
    ks = _ks_where(counts, at, index.n, ["snapshot"], None)
    ks = ks.withColumn("__p", ks_pvalue("ks_statistic", "n_ref", "n_new", ks_mode)).select(
        "snapshot", F.round("ks_statistic", 4).alias("ks_statistic"), F.round("__p", 4).alias("ks_p_value"), (F.col("__p") < KS_ALPHA).alias("__drift"))
    p = psi_against(index.bins, counts, "x", "c", group_cols=["snapshot"])
    j = base
    for part in (ks, p):
        j = j.join(part.withColumnRenamed("snapshot", "__s"), F.col("snapshot").eqNullSafe(F.col("__s")), "left").drop("__s")
    return j.select("snapshot", "n_articles", "relevancy_rate", "avg_confidence", "pred_std", "ks_statistic", "ks_p_value", "psi", "psi_status",
                    retrain_gate("relevancy_rate", "avg_confidence", F.col("__drift"), "psi").alias("retrain_needed"))
