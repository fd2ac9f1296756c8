"""A9, A10, D1-D8 against NumPy and exact enumeration."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.operators import drift as D
from veracity.operators import kstest, prefix


# Ten reference values 0.05 .. 0.95: their deciles, with 0 and 1 at the ends, part
# the line at 0.14, 0.23, .. 0.86, and each part holds one value, a share of 0.1.
TEN = [0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95]
# Half of the new values in the first part and half in the last: 2 x 0.4 ln 5, and
# eight empty parts at the floor of 0.0001: 8 x 0.0999 ln 1000.
ENDS, ENDS_PSI = [0.05] * 5 + [0.95] * 5, 6.8082
# Two values in each of the last five parts: 5 x 0.1 ln 2 + 5 x 0.0999 ln 1000.
UPPER, UPPER_PSI = [0.55, 0.55, 0.65, 0.65, 0.75, 0.75, 0.85, 0.85, 0.95, 0.95], 3.797
# One value moves from the first part to the second: 0.1 ln 2 + 0.0999 ln 1000.
MOVED, MOVED_PSI = [0.15] + TEN[1:], 0.7594


def np_ks(a, b):
    x = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), x, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), x, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def frame(spark, xs, col="score"):
    return spark.createDataFrame([(float(v),) for v in xs], f"{col} double")


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(42)
    ref = np.round(rng.random(500), 3)
    new = np.round(rng.random(120) ** 2, 3)
    return ref, new


def test_quantiles_match_numpy(spark, samples):
    ref, _ = samples
    q = D.exact_quantiles(frame(spark, ref)).orderBy("q_index").collect()
    exp = np.percentile(ref, np.linspace(0, 100, 11))
    assert [r.quantile for r in q] == pytest.approx(list(exp), abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 7])
def test_quantiles_small_n(spark, n):
    xs = [0.5 + i for i in range(n)]
    q = D.exact_quantiles(frame(spark, xs)).orderBy("q_index").collect()
    assert [r.quantile for r in q] == pytest.approx(list(np.percentile(xs, np.linspace(0, 100, 11))))


def test_histogram_matches_numpy(spark, samples):
    ref, _ = samples
    edges = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    h = D.histogram(frame(spark, list(ref) + [1.0, 2.0, -1.0]), "score", edges).orderBy("bin").collect()
    exp, _ = np.histogram(list(ref) + [1.0, 2.0, -1.0], bins=edges)
    assert [r.n for r in h] == list(exp)


@pytest.mark.parametrize("new,expected", [(ENDS, ENDS_PSI), (UPPER, UPPER_PSI), (MOVED, MOVED_PSI), (TEN, 0.0), (TEN * 3, 0.0)])
def test_psi_worked_by_hand(spark, new, expected):
    assert D.psi(frame(spark, TEN), frame(spark, new)).first().psi == expected


def test_psi_edges_of_ties(spark):
    # 0.5 eight times of ten: all inner deciles fall together or on it
    assert D.psi_edges(frame(spark, [0.1] + [0.5] * 8 + [0.9])) == pytest.approx([0.0, 0.46, 0.5, 0.54, 1.0])


def test_ks_statistic(spark, samples):
    ref, new = samples
    row = D.ks_statistic(frame(spark, ref), frame(spark, new), digits=None).first()
    assert row.ks_statistic == pytest.approx(np_ks(ref, new))
    assert D.ks_statistic(frame(spark, ref), frame(spark, ref)).first().ks_statistic == 0.0


def test_ks_by_group_matches_per_group(spark, samples):
    ref, new = samples
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(new)]
    nd = spark.createDataFrame(rows, "g string, score double")
    got = {r.g: r.ks_statistic for r in D.ks_statistic_by_group(frame(spark, ref), nd, ["g"]).collect()}
    for g in ("a", "b"):
        sub = np.array([v for k, v in rows if k == g])
        assert got[g] == round(np_ks(ref, sub), 4)


@pytest.mark.parametrize("ranges", [1, 2, 8, 1000])
def test_prefix_sums_independent_of_ranges(spark, ranges):
    rng = np.random.default_rng(3)
    rows = [(float(i), int(v)) for i, v in enumerate(rng.integers(0, 5, 200))]
    df = spark.createDataFrame(rows, "x double, n long")
    got = sorted((r.x, r.cum_n) for r in prefix.prefix_sums(df, ["x"], ["n"], n_ranges=ranges).collect())
    assert [c for _, c in got] == list(np.cumsum([n for _, n in rows]))


def test_prefix_sums_within_groups_and_nulls(spark):
    rows = [(g, x, 1) for g in ("a", None) for x in (None, 3.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    for ranges in (1, 3, 8):
        got = {(r.g, r.x): r.cum_n for r in prefix.prefix_sums(df, ["x"], ["n"], ["g"], ranges).collect()}
        assert got == {(g, x): n for g in ("a", None) for x, n in ((None, 1), (1.0, 2), (2.0, 3), (3.0, 4))}


def test_ranges_are_even(spark):
    rows = spark.range(400_000).selectExpr("pow(rand(1), 4) as x")
    sizes = [r["count"] for r in prefix.ranged(rows, ["x"], n_ranges=200).groupBy(prefix.RANGE).count().collect()]
    assert max(sizes) <= 2 * 400_000 / 200


def brute_ks_pvalue(n1, n2, d):
    """P(D >= d) by enumerating every assignment of ranks to the first sample."""
    total = hit = 0
    for comb in itertools.combinations(range(n1 + n2), n1):
        s = set(comb)
        c1 = c2 = 0
        m = 0.0
        for i in range(n1 + n2):
            if i in s:
                c1 += 1
            else:
                c2 += 1
            m = max(m, abs(c1 / n1 - c2 / n2))
        total += 1
        hit += m >= d - 1e-12
    return hit / total


@pytest.mark.parametrize("n1,n2,d", [(4, 5, 0.55), (5, 5, 0.6), (3, 6, 2 / 3), (6, 4, 0.5)])
def test_exact_pvalue_matches_enumeration(n1, n2, d):
    assert kstest.exact_two_sided(d, n1, n2) == pytest.approx(brute_ks_pvalue(n1, n2, d), abs=1e-12)


@pytest.mark.parametrize("n1,n2", [(200, 300), (1000, 1000), (3980, 10000), (10001, 10000)])
def test_exact_pvalue_falls_and_nears_the_limit(n1, n2):
    root = math.sqrt(n1 * n2 / (n1 + n2))
    ds = [lam / root for lam in (0.5, 0.8, 1.1, 1.36, 1.8, 2.5, 4.0)]
    exact = [kstest.exact_two_sided(d, n1, n2) for d in ds]
    assert all(a > b for a, b in zip(exact, exact[1:])) and all(0.0 <= p <= 1.0 for p in exact)
    for d, p in zip(ds, exact):
        assert p == pytest.approx(kstest.two_sample_pvalue(d, n1, n2, "limit"), abs=1.2 / root, rel=1.0)
    assert kstest.exact_two_sided(0.3, n1, n2) < 1e-8 and kstest.two_sample_pvalue(0.9, n1, n2) < 1e-30


def test_limit_law_values():
    # tabulated points of Kolmogorov's distribution
    assert kstest.limit_sf(1.3581) == pytest.approx(0.05, abs=1e-4)
    assert kstest.limit_sf(1.6276) == pytest.approx(0.01, abs=1e-4)
    assert kstest.limit_sf(0.0) == kstest.limit_sf(0.15) == 1.0
    ps = [kstest.limit_sf(x / 50) for x in range(200)]
    assert all(a >= b - 1e-12 for a, b in zip(ps, ps[1:]))
    with pytest.raises(ValueError):
        kstest.two_sample_pvalue(0.1, 5, 5, "asymptotic")


def test_rows_without_score_or_snapshot(spark):
    # shares are over all rows: the null row takes a tenth from each of them
    nd = spark.createDataFrame([(None, None, v) for v in TEN[:9] + [None]], "s string, text string, score double")
    table = D.score_table(frame(spark, TEN), nd)
    assert D.ks_of(table).first() == (0.1, 10, 9)
    assert D.psi(frame(spark, TEN), nd).first().psi == round(0.0999 * math.log(1000), 4)
    r = D.drift_report(nd, frame(spark, TEN), keywords=["iran"]).first()
    by = D.drift_by_snapshot(nd, frame(spark, TEN), "s", keywords=["iran"]).collect()
    assert len(by) == 1 and by[0].s is None and by[0].n_articles == 10
    assert (by[0].ks_statistic, by[0].psi) == (r.ks_statistic, r.psi) == (0.1, round(0.0999 * math.log(1000), 4))


def test_empty_sides(spark):
    none = frame(spark, [])
    assert D.psi(none, frame(spark, TEN)).first() == (None, None)
    assert D.psi(frame(spark, TEN), none).first() == (None, None)
    assert D.ks_statistic(none, frame(spark, TEN)).first() == (None, 0, 10)


def test_drift_report_gate(spark):
    texts = ["Iran vote today" if i % 2 else "weather" for i in range(10)]
    nd = spark.createDataFrame(list(zip(texts, UPPER)), "text string, score double")
    r = D.drift_report(nd, frame(spark, TEN), keywords=["iran"]).first()
    assert r.n_articles == 10 and r.relevancy_rate == 0.5
    assert r.psi == UPPER_PSI and r.ks_statistic == 0.5
    assert r.retrain_needed is True and "psi_significant" in r.reasons
    by = D.drift_by_snapshot(nd.withColumn("s", F.lit("x")), frame(spark, TEN), "s", keywords=["iran"]).first()
    assert (by.ks_statistic, by.ks_p_value, by.psi, by.retrain_needed) == (r.ks_statistic, r.ks_p_value, r.psi, r.retrain_needed)
    none = D.drift_report(nd, None, keywords=["iran"]).first()
    assert none.psi is None and none.ks_statistic is None


# --- D4: the finite-sample law -------------------------------------------------------
def test_finite_law_of_one_and_two_values():
    """P(D_1 < d) = 2d - 1; P(D_2 < d) = 2 (2d - 1/2)^2 up to 1/2, then 1 - 2 (1 - d)^2."""
    for d in np.linspace(0.5, 1, 11):
        assert kstest.finite_sf(d, 1) == pytest.approx(2 - 2 * d, abs=1e-14)
    for d in np.linspace(0.25, 0.5, 11)[:-1]:
        assert kstest.finite_sf(d, 2) == pytest.approx(1 - 2 * (2 * d - 0.5) ** 2, abs=1e-14)
    for d in np.linspace(0.5, 1, 11):
        assert kstest.finite_sf(d, 2) == pytest.approx(2 * (1 - d) ** 2, abs=1e-14)


def test_finite_law_matches_simulated_uniform_samples():
    rng = np.random.default_rng(1)
    for n in (3, 25):
        x = np.sort(rng.random((200_000, n)), axis=1)
        stat = np.maximum((np.arange(1, n + 1) / n - x).max(1), (x - np.arange(n) / n).max(1))
        for d in (0.15, 0.2, 0.3, 0.45):
            assert kstest.finite_sf(d, n) == pytest.approx((stat >= d).mean(), abs=0.005)


@pytest.mark.parametrize("n", [2, 5, 25, 140, 1000, kstest.MATRIX_N, kstest.MATRIX_N + 1, 10 ** 5, 10 ** 7, 10 ** 12])
def test_finite_law_falls_without_jumps(n):
    """Where one formula follows another the probability goes on, and it never rises with d."""
    at = np.unique(np.concatenate([np.linspace(0, 1, 60), np.linspace(0.2, 4, 80) / math.sqrt(n), 1 / (2 * n) * np.array([1, 2, 3]), [0.5]]))
    p = [kstest.finite_sf(d, n) for d in at]
    assert p[0] == 1 and p[-1] == 0 and all(0 <= x <= 1 for x in p)
    assert all(b <= a + 3e-8 for a, b in itertools.pairwise(p))
    for edge in {1 / n, 0.5, 2 / math.sqrt(n)}:
        if edge < 1:
            below, above = kstest.finite_sf(edge * (1 - 1e-9), n), kstest.finite_sf(edge * (1 + 1e-9), n)
            assert below == pytest.approx(above, abs=2e-7)


def test_matrix_power_and_expansion_agree():
    for z in (0.3, 0.6, 0.9, 1.2, 1.6, 1.9):
        for n, within in ((400, 2e-6), (4000, 3e-8)):
            assert kstest.matrix_cdf(z / math.sqrt(n), n) == pytest.approx(kstest.expanded_cdf(z / math.sqrt(n), n), abs=within)


def test_finite_law_is_near_the_exact_one_for_few_new_rows():
    """25 new rows against a large reference: the usual case. The limit is off by far more."""
    for n_new, n_ref in ((25, 9000), (20, 9973), (60, 8000)):
        for d in (0.15, 0.2, 0.25, 0.3, 0.4):
            exact = kstest.exact_two_sided(d, n_new, n_ref)
            finite, limit = (kstest.two_sample_pvalue(d, n_ref, n_new, mode) for mode in ("finite", "limit"))
            assert finite == pytest.approx(exact, abs=0.006)
            assert abs(finite - exact) < abs(limit - exact)


def test_auto_takes_paths_for_small_and_the_finite_law_for_large_samples():
    assert kstest.two_sample_pvalue(0.3, 25, 10_000, "auto") == kstest.exact_two_sided(0.3, 25, 10_000)
    assert kstest.two_sample_pvalue(0.3, 25, 10_001, "auto") == kstest.finite_sf(0.3, 25)
    assert [kstest.effective_n(a, b) for a, b in ((1, 1), (3, 3), (25, 10 ** 9), (10 ** 18, 10 ** 18))] == [0, 2, 25, 5 * 10 ** 17]
    assert math.isnan(kstest.two_sample_pvalue(0.3, 0, 5, "auto"))
    with pytest.raises(ValueError):
        kstest.two_sample_pvalue(0.3, 5, 5, "other")


@pytest.mark.parametrize("mode", ["limit", "finite", "exact", "auto"])
def test_reports_use_the_named_law(spark, mode):
    ref = frame(spark, [i / 400 for i in range(400)])
    new = spark.createDataFrame([("s", "iran", (i / 30) ** 2) for i in range(30)] + [("t", "x", None)], "s string, text string, score double")
    d = np_ks(np.arange(400) / 400, (np.arange(30) / 30) ** 2)
    want = round(kstest.two_sample_pvalue(d, 400, 30, mode), 4)
    one = D.drift_report(new, ref, ks_mode=mode).first()
    assert one.ks_p_value == pytest.approx(want, abs=1e-4)
    each = {r.s: r for r in D.drift_by_snapshot(new, ref, "s", ks_mode=mode).collect()}
    assert each["s"].ks_p_value == pytest.approx(want, abs=1e-4) and each["t"].ks_p_value is None
