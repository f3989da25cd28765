"""Numeric helpers: log-factorial as a Spark column, binomial probabilities and tails as SQL, and the Student-t tail for one scalar statistic."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Exact factorials fit a bigint up to 20!; above, Stirling's series with three
# correction terms has a relative error below 1e-14.
EXACT_FACTORIAL_MAX = 20


def log_factorial(m: Column) -> Column:
    """ln(m!) for an integer column m ≥ 0 (Spark has no lgamma)."""
    md = m.cast("double")
    stirling = (md * F.log(md) - md + F.lit(0.5) * F.log(F.lit(2.0 * math.pi) * md)
                + F.lit(1.0) / (F.lit(12.0) * md)
                - F.lit(1.0) / (F.lit(360.0) * F.pow(md, 3))
                + F.lit(1.0) / (F.lit(1260.0) * F.pow(md, 5)))
    exact = F.log(F.factorial(F.least(m, F.lit(EXACT_FACTORIAL_MAX)).cast("int")).cast("double"))
    return F.when(m <= EXACT_FACTORIAL_MAX, exact).otherwise(stirling)


# The following are SQL texts over texts: a test mentions the pmf several times,
# and hundreds of Column calls take longer to build than the test to run.

def _stirling_error(m: str) -> str:
    """ln(m!) less Stirling's formula without corrections, for an integer m ≥ 1."""
    d, small = f"CAST({m} AS DOUBLE)", f"CAST(LEAST({m}, {EXACT_FACTORIAL_MAX}) AS INT)"
    inv2 = f"(1 / ({d} * {d}))"
    series = f"({1 / 12!r}D - ({1 / 360!r}D - ({1 / 1260!r}D - {1 / 1680!r}D * {inv2}) * {inv2}) * {inv2}) / {d}"
    exact = f"ln(CAST(factorial({small}) AS DOUBLE)) - (({d} + 0.5D) * ln({d}) - {d} + {0.5 * math.log(2 * math.pi)!r}D)"
    return f"CASE WHEN {m} <= {EXACT_FACTORIAL_MAX} THEN {exact} ELSE {series} END"


def _deviance(x: str, mean: str) -> str:
    """x ln(x / mean) + mean - x for x > 0, without cancellation where x is near the mean."""
    v = f"(({x} - {mean}) / ({x} + {mean}))"
    series = f"{1 / 21!r}D"
    for j in range(19, 1, -2):      # |v| < 0.1: the next term is below 1e-20
        series = f"({1 / j!r}D + {v} * {v} * {series})"
    return (f"CASE WHEN abs({v}) < 0.1D THEN ({x} - {mean}) * {v} + 2 * {x} * {v} * {v} * {v} * {series} "
            f"ELSE {x} * ln({x} / {mean}) - ({x} - {mean}) END")


def binomial_log_pmf(k: str, n: str, p: str) -> str:
    """ln P(X = k) for X ~ Binomial(n, p), 0 < p < 1, as deviances: its error doesn't grow with n."""
    kd, nd, rest = f"CAST({k} AS DOUBLE)", f"CAST({n} AS DOUBLE)", f"({n} - {k})"
    inner = (f"({_stirling_error(n)}) - ({_stirling_error(k)}) - ({_stirling_error(rest)})"
             f" - ({_deviance(kd, f'({nd} * {p})')}) - ({_deviance(f'({nd} - {kd})', f'({nd} * (1 - {p}))')})"
             f" + 0.5D * ln({nd} / ({2 * math.pi!r}D * {kd} * ({nd} - {kd})))")
    return f"CASE WHEN {k} <= 0 THEN {nd} * log1p(-{p}) WHEN {k} >= {n} THEN {nd} * ln({p}) ELSE {inner} END"


def binomial_lower_tail(k: str, n: str, p: str) -> str:
    """P(X ≤ k) for X ~ Binomial(n, p), 0 < p < 1, where k is at most about the mean.

    The tail is an incomplete beta function: the pmf times p times a continued
    fraction, whose 2·√variance + 60 pairs of terms are evaluated from the
    last to the first. k < 0 gives 0, k ≥ n gives 1.
    """
    a, b, m = f"CAST({n} - {k} AS DOUBLE)", f"CAST({k} + 1 AS DOUBLE)", "CAST(j DIV 2 AS DOUBLE)"
    even = f"{m} * ({b} - {m}) / (({a} + 2 * {m} - 1) * ({a} + 2 * {m}))"
    odd = f"-(({a} + {m}) * ({a} + {b} + {m})) / (({a} + 2 * {m}) * ({a} + 2 * {m} + 1))"
    last = f"2 * (CAST(ceil(2 * sqrt(CAST({n} AS DOUBLE) * {p} * (1 - {p}))) AS INT) + 60)"
    fraction = f"aggregate(sequence({last}, 1, -1), 1D, (f, j) -> 1 + CASE WHEN j % 2 = 0 THEN {even} ELSE {odd} END * (1 - {p}) / f)"
    return f"CASE WHEN {k} < 0 THEN 0D WHEN {k} >= {n} THEN 1D ELSE exp({binomial_log_pmf(k, n, p)}) * {p} / {fraction} END"


def _beta_continued_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return h


def regularized_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b) by the continued fraction (Lentz's method)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_continued_fraction(a, b, x) / a
    return 1.0 - front * _beta_continued_fraction(b, a, 1.0 - x) / b


def student_t_two_sided_p(t: float, df: float) -> float:
    """P(|T| ≥ |t|) for Student's t with ``df`` degrees of freedom."""
    if math.isinf(t):
        return 0.0
    return regularized_beta(df / 2.0, 0.5, df / (df + t * t))
