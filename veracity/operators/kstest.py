"""Two-sample Kolmogorov-Smirnov p-values from ``(D, n1, n2)``.

Only three scalars reach this module; the statistic itself is computed by
Spark (:func:`veracity.operators.drift.ks_statistic`). The law is the caller's
choice and never changes with the sample size:

* ``limit`` - the limiting series ``2 sum (-1)^(k-1) exp(-2 k^2 lam^2)`` with
  ``lam = D * sqrt(n1 n2 / (n1 + n2))``; a constant amount of work;
* ``exact`` - the probability that a random lattice path from (0,0) to
  (n1,n2) touches ``|i/n1 - j/n2| >= D``; work grows with ``(n1 + n2)`` times
  the width of the band;
* ``finite`` - Kolmogorov's law of one sample of ``n`` values against a known
  distribution, with ``n = n1 n2 / (n1 + n2)`` rounded to a whole number: the
  usual case of few new rows against a large reference;
* ``auto`` - ``exact`` where both samples have at most ``EXACT_N`` values, else
  ``finite``; the rule that the common two-sample test follows by default.
"""

from __future__ import annotations

import math

import numpy as np

MODES = ("limit", "exact", "finite", "auto")
#: Largest sample that ``auto`` counts lattice paths for; largest n that ``finite`` takes a matrix power for.
EXACT_N, MATRIX_N = 10_000, 4_000


def limit_sf(lam: float, terms: int = 100) -> float:
    if lam <= 0:
        return 1.0
    if lam < 0.2:  # the alternating series needs more terms than that; the value is 1 to 12 digits
        return 1.0
    s = math.fsum((-1.0) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, terms + 1))
    return min(1.0, max(0.0, 2.0 * s))


def exact_two_sided(d: float, n1: int, n2: int) -> float:
    """P(D >= d) under the null hypothesis.

    The path takes a step in the first sample with the share of it among the
    values that are left. Mass that steps out of the band is taken out and
    added up, so a small probability is a sum of small positive numbers and
    never one minus something near one."""
    g = math.gcd(n1, n2)
    a, b = n2 // g, n1 // g  # |i/n1 - j/n2| >= d  <=>  |i*a - j*b| >= h
    h = int(round(d * (n1 // g) * n2))
    if h <= 0:
        return 1.0
    first, mass = 0, np.ones(1)  # mass[k] is at i = first + k of this diagonal
    gone = 0.0
    for step in range(n1 + n2):
        i = np.arange(first, first + len(mass))
        up = (n1 - i) / (n1 + n2 - step)
        out = np.zeros(len(mass) + 1)
        out[:-1] = mass * (1.0 - up)
        out[1:] += mass * up
        i = np.arange(first, first + len(out))
        outside = np.abs(i * a - (step + 1 - i) * b) >= h
        gone += float(out[outside].sum())
        inside = np.flatnonzero(~outside)
        if not len(inside):
            break
        first, mass = first + int(inside[0]), out[inside[0]:inside[-1] + 1]
    return min(1.0, gone)


def one_sided_sf(d: float, n: int) -> float:
    """P(sup (F_n - F) >= d) by Smirnov's sum, in logarithms; its two-term expansion where n terms are too many."""
    if n > 1_000_000:
        return math.exp(-((6.0 * n * d + 1.0) ** 2) / (18.0 * n))
    j = np.arange(int(math.floor(n * (1.0 - d))) + 1, dtype=float)
    j = j[1.0 - d - j / n > 0]
    steps = np.concatenate([[0.0], np.cumsum(np.log(n - j[:-1]) - np.log(j[1:]))])  # log of n over j
    terms = steps + (j - 1) * np.log(d + j / n) + (n - j) * np.log1p(-(d + j / n))
    top = terms.max(initial=-np.inf)
    return min(1.0, math.exp(math.log(d) + top) * math.fsum(np.exp(terms - top))) if len(j) else 0.0


def _scaled(matrix: np.ndarray, exponent: int) -> tuple[np.ndarray, int]:
    """The matrix with its greatest cell between 1/2 and 1, and the power of two taken out."""
    shift = int(math.frexp(float(np.abs(matrix).max()))[1])
    return np.ldexp(matrix, -shift), exponent + shift


def matrix_cdf(d: float, n: int) -> float:
    """P(D_n < d) as a cell of the n-th power of a band matrix (Durbin; Marsaglia, Tsang and Wang).

    The path of the empirical distribution in steps of 1/n stays within a band
    of 2k - 1 places; a step moves up by any number of values, with Poisson
    weights 1/m!, corrected where the band's edges cut a step. The power is by
    squaring; powers of two are taken out of every product, so neither it nor
    n!/n^n over- or underflows."""
    k = int(n * d) + 1
    h, size = k - n * d, 2 * k - 1
    lag = np.arange(size)[:, None] - np.arange(size)[None, :] + 1
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, size + 1)))])
    numerator = (lag >= 0).astype(float)
    edge = h ** np.arange(1, size + 1)
    numerator[:, 0] -= edge
    numerator[-1, :] -= edge[::-1]
    numerator[-1, 0] += max(2.0 * h - 1.0, 0.0) ** size
    step = numerator * np.exp(-log_factorial[np.maximum(lag, 0)])
    (power, out), (square, twos), left = (np.eye(size), 0), _scaled(step, 0), n
    while left:
        if left & 1:
            power, out = _scaled(power @ square, out + twos)
        left >>= 1
        if left:
            square, twos = _scaled(square @ square, 2 * twos)
    cell = float(power[k - 1, k - 1])
    if cell <= 0.0:
        return 0.0
    return min(1.0, math.exp(math.log(cell) + out * math.log(2.0) + math.lgamma(n + 1) - n * math.log(n)))


def expanded_cdf(d: float, n: int, terms: int = 24) -> float:
    """P(D_n < d) with the limit's corrections in powers of 1/sqrt(n) up to the third (Pelz and Good); what is left out is of order 1/n^2."""
    z = math.sqrt(n) * d
    if z < 0.15:  # below 1e-24
        return 0.0
    z2, z4, z6 = z * z, z ** 4, z ** 6
    u = (math.pi * (np.arange(-terms, terms) + 0.5)) ** 2
    v = (math.pi * np.arange(-terms, terms + 1)) ** 2
    half, whole = np.exp(-u / (2 * z2)), np.exp(-v / (2 * z2))
    root = math.sqrt(math.pi / 2)
    k0 = root / z * half.sum()
    k1 = root / (6 * z4) * ((u - z2) * half).sum()
    k2 = (root / (72 * z ** 7) * ((6 * z6 + 2 * z4 + u * (2 * z4 - 5 * z2) + u ** 2 * (1 - 2 * z2)) * half).sum()
          - root / (36 * z ** 3) * (v * whole).sum())
    k3 = (root / (6480 * z ** 10) * ((u ** 3 * (5 - 30 * z2) + u ** 2 * (212 * z4 - 60 * z2) + u * (135 * z4 - 96 * z6) - 30 * z6 - 90 * z ** 8) * half).sum()
          + root / (108 * z6) * ((3 * v * z2 - v ** 2) * whole).sum())
    return min(1.0, max(0.0, k0 + k1 / math.sqrt(n) + k2 / n + k3 / n ** 1.5))


def finite_sf(d: float, n: int) -> float:
    """P(D_n >= d) for the one-sample statistic of ``n`` values.

    Closed forms at the ends; twice the one-sided probability where both sides
    can't or hardly ever exceed d together (from n d^2 = 4 on: 1e-14); between
    them the matrix power up to ``MATRIX_N``, the expansion beyond."""
    if n <= 0:
        return float("nan")
    if 2.0 * n * d <= 1.0:
        return 1.0
    if d >= 1.0:
        return 0.0
    if n * d <= 1.0:
        return -math.expm1(math.lgamma(n + 1) + n * math.log(2.0 * d - 1.0 / n))
    if d >= 0.5 or n * d * d >= 4.0:
        return min(1.0, 2.0 * one_sided_sf(d, n))
    return max(0.0, 1.0 - (matrix_cdf(d, n) if n <= MATRIX_N else expanded_cdf(d, n)))


def effective_n(n1: int, n2: int) -> int:
    """n1 n2 / (n1 + n2) to the nearest whole number, halves to the even one."""
    whole, rest = divmod(n1 * n2, n1 + n2)
    return whole + (2 * rest > n1 + n2 or (2 * rest == n1 + n2 and whole % 2 == 1))


def two_sample_pvalue(d: float, n1: int, n2: int, mode: str = "limit") -> float:
    if n1 <= 0 or n2 <= 0:
        return float("nan")
    if mode == "auto":
        mode = "exact" if max(n1, n2) <= EXACT_N else "finite"
    if mode == "exact":
        return exact_two_sided(d, n1, n2)
    if mode == "finite":
        return finite_sf(d, effective_n(n1, n2))
    if mode == "limit":
        return limit_sf(d * math.sqrt(n1 * n2 / (n1 + n2)))
    raise ValueError(f"unknown KS mode {mode!r}")
