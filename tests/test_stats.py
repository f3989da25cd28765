"""Exact binomial test and Spearman correlation."""

import math

import pytest
from pyspark.sql import functions as F

from ehrspark.functions.mathfn import log_factorial, student_t_two_sided_p
from ehrspark.operators import stats
from ehrspark.operators.ranks import average_ranks


def test_binomial_p_values_match_known_values(spark):
    tests = spark.createDataFrame([(1, 1000, 98514, 0.0102), (2, 50000, 98514, 0.51), (3, 3, 98514, 0.00001)],
                                  "id int, x long, n long, p double")
    got = {r["id"]: r["p_value"] for r in stats.binomial_p_values(tests, "id").collect()}
    assert got[1] == pytest.approx(0.899064, abs=5e-7)
    assert got[2] == pytest.approx(0.122989, abs=5e-7)
    assert got[3] == pytest.approx(0.077588, abs=5e-7)


def test_binomial_edges(spark):
    tests = spark.createDataFrame([(1, 5, 10, 0.5), (2, 0, 10, 0.0), (3, 1, 10, 0.0), (4, 10, 10, 1.0),
                                   (5, 3, 10, None)],
                                  "id int, x long, n long, p double")
    got = {r["id"]: r["p_value"] for r in stats.binomial_p_values(tests, "id").collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0, 4: 1.0, 5: None}


def test_small_binomial_against_direct_sum(spark):
    n, p, x = 20, 0.3, 11
    pmf = [math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(n + 1)]
    want = sum(v for v in pmf if v <= pmf[x] * (1 + 1e-7))
    tests = spark.createDataFrame([(1, x, n, p)], "id int, x long, n long, p double")
    assert stats.binomial_p_values(tests, "id").first()["p_value"] == pytest.approx(want, rel=1e-9)


def test_log_factorial(spark):
    df = spark.range(0, 200).select(F.col("id"), log_factorial(F.col("id")).alias("lf"))
    for r in df.collect():
        assert r["lf"] == pytest.approx(math.lgamma(r["id"] + 1), rel=1e-13, abs=1e-12)


def test_spearman_with_ties(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (2.0, 25.0), (4.0, 5.0)], "a double, b double")
    rho, p, n = stats.spearman(df, "a", "b")
    assert n == 4 and rho == pytest.approx(-0.316228, abs=1e-6)
    t = rho * math.sqrt(2 / ((1 + rho) * (1 - rho)))
    assert p == pytest.approx(student_t_two_sided_p(t, 2))


def test_student_t_tail_known_values():
    # t = 2.0 with 10 degrees of freedom: two-sided p = 0.07338803477074...
    assert student_t_two_sided_p(2.0, 10) == pytest.approx(0.0733880348, abs=1e-9)
    # df = 1 is the Cauchy distribution: P(|T| > 1) = 0.5
    assert student_t_two_sided_p(1.0, 1) == pytest.approx(0.5, abs=1e-12)
    assert student_t_two_sided_p(0.0, 5) == pytest.approx(1.0)


def _summed(n, p, x):
    """The test by the sum over all outcomes."""
    pmf = [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(n + 1)]
    if x < n * p:
        return sum(v for k, v in enumerate(pmf) if k <= x or k >= n * p and v <= pmf[x] * (1 + 1e-7))
    return 1.0 if x == n * p else sum(v for k, v in enumerate(pmf) if k >= x or k <= n * p and v <= pmf[x] * (1 + 1e-7))


def test_binomial_tails_equal_the_sum(spark):
    cases = [(n, p, x) for n in (1, 2, 7, 40, 1000) for p in (0.001, 0.3, 0.5, 0.97) for x in {0, 1, n // 3, n // 2, n - 1, n}]
    tests = spark.createDataFrame([(i, x, n, p) for i, (n, p, x) in enumerate(cases)], "id int, x long, n long, p double")
    got = {r["id"]: r["p_value"] for r in stats.binomial_p_values(tests, "id").collect()}
    for i, (n, p, x) in enumerate(cases):
        assert got[i] == pytest.approx(min(1.0, _summed(n, p, x)), rel=1e-10, abs=1e-300), (n, p, x)


def test_binomial_at_a_hundred_million(spark):
    n, p = 10 ** 8, 0.5
    cases = [50_000_000 - 10_000, 50_000_000 + 10_000, 50_000_000 - 1, 49_000_000, 10_000_000]
    tests = spark.createDataFrame([(i, x, n, p) for i, x in enumerate(cases)] + [(9, 10 ** 8 + 1, n, p)], "id int, x long, n long, p double")
    got = {r["id"]: r["p_value"] for r in stats.binomial_p_values(tests, "id").collect()}
    # Normal tail with continuity correction; its own error is of the order of 1 / n.
    want = math.erfc(9999.5 / 5000 / math.sqrt(2))
    assert got[0] == got[1] == pytest.approx(want, rel=1e-6)
    assert got[2] == pytest.approx(1.0, abs=1e-4) and got[2] <= 1 and got[4] == 0.0 and got[9] == 0.0


def test_ranks_with_ties_nulls_and_many_ranges(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.choice([rng.random(), 7.0, -0.0, 0.0]), rng.choice([None, rng.randint(0, 40)])) for _ in range(3000)] + [(None, 3)]
    df = spark.createDataFrame(rows, "a double, b long")
    kept = [(a + 0.0, b) for a, b in rows if a is not None and b is not None]

    def ranks(values):
        order = sorted(values)
        first, last = {}, {}
        for i, v in enumerate(order, 1):
            first.setdefault(v, i)
            last[v] = i
        return [(first[v] + last[v]) / 2 for v in values]

    ra, rb = ranks([a for a, _ in kept]), ranks([b for _, b in kept])
    got = {r["a"]: r["rank"] for r in average_ranks(spark.createDataFrame([(a, 1) for a, _ in kept], "a double, n long"), "a").collect()}
    assert got == dict(zip([a for a, _ in kept], ra))
    mean = (len(kept) + 1) / 2
    cov = lambda u, v: sum((x - mean) * (y - mean) for x, y in zip(u, v))
    rho, _, n = stats.spearman(df, "a", "b")
    assert n == len(kept) and rho == pytest.approx(cov(ra, rb) / math.sqrt(cov(ra, ra) * cov(rb, rb)), abs=1e-12)
    assert stats.spearman(df.limit(0), "a", "b")[2] == 0 and math.isnan(stats.spearman(df.select(F.lit(1).alias("a"), "b"), "a", "b")[0])
