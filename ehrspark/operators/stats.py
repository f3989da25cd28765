"""Two-population comparison: disease prevalence, exact binomial tests, Spearman."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.mathfn import binomial_log_pmf, binomial_lower_tail, student_t_two_sided_p
from .ranks import rank_correlation

CONCEPT = "condition_concept_id"
REAL = "disease_conut_in_real_patients"     # column names as in the reference
SYNTH = "disease_conut_in_synpuf_patients"

# scipy's relative tolerance for "as likely as the observed count".
PMF_RTOL = 1 + 1e-7

def population_of(person_id: Column) -> Column:
    """Fixture split: even ids are the real population, odd ids the synthetic one."""
    return (person_id % 2) == 0


def disease_counts(conditions: DataFrame, is_real: Column) -> DataFrame:
    """Distinct patients per condition concept in each population.

    Columns: condition_concept_id, disease_conut_in_real_patients,
    disease_conut_in_synpuf_patients. Concepts seen only in the synthetic
    population are left out (the table is keyed by the real ranking).
    One pass: distinct (concept, person) then a conditional count.
    """
    pairs = (conditions.select(CONCEPT, "person_id", is_real.alias("_real"))
             .where(F.col("person_id").isNotNull() & F.col(CONCEPT).isNotNull())
             .distinct())
    return (pairs.groupBy(CONCEPT)
            .agg(F.count_if(F.col("_real")).alias(REAL), F.count_if(~F.col("_real")).alias(SYNTH))
            .where(F.col(REAL) > 0))


def _bisected(lo: str, hi: str, holds: str) -> str:
    """SQL: the least k in [lo, hi] for which ``holds`` (SQL over ``{k}``) is true, where it is true from some k on; hi + 1 if for none."""
    steps = f"sequence(1, CAST(ceil(log2(CAST(greatest({hi} - {lo} + 2, 2) AS DOUBLE))) AS INT) + 1)"
    middle = "s.lo + (s.hi - s.lo) DIV 2"
    half = holds.replace("{k}", f"({middle})")
    step = (f"CASE WHEN s.lo >= s.hi THEN s WHEN {half} THEN named_struct('lo', s.lo, 'hi', {middle})"
            f" ELSE named_struct('lo', {middle} + 1, 'hi', s.hi) END")
    return f"aggregate({steps}, named_struct('lo', CAST({lo} AS BIGINT), 'hi', CAST({hi} + 1 AS BIGINT)), (s, i) -> {step}, s -> s.lo)"


def binomial_p_values(tests: DataFrame, key: str, x: str = "x", n: str = "n", p: str = "p") -> DataFrame:
    """Exact two-sided binomial test per row: (key, p_value).

    Same rule as the usual exact test: sum the probabilities of all outcomes
    no more likely than the observed one (relative tolerance 1e-7), the tail
    on the observed side in full. A test stays one row: the opposite tail's
    first outcome is found by bisection of the pmf, and both tails are
    incomplete beta functions. Nulls give null; p of 0 or 1 gives 0 unless x
    is the mean; x outside 0..n has probability 0.
    """
    rows = (tests.select(key, F.col(x).cast("bigint").alias("_x"), F.col(n).cast("bigint").alias("_n"),
                         F.col(p).cast("double").alias("_p"))
            .withColumn("_mean", F.col("_n").cast("double") * F.col("_p")))
    regular = (F.col("_p") > 0) & (F.col("_p") < 1) & F.col("_x").between(0, F.col("_n")) & (F.col("_x").cast("double") != F.col("_mean"))
    # Seen from the side on which x is below the mean: the other side mirrors k to n - k and p to 1 - p. The
    # mirrored mean is the mean's mirror, as 1 - p loses digits that n would magnify.
    mirrored = F.col("_x").cast("double") > F.col("_mean")
    rows = (rows.select(key, "_x", "_n", "_p", "_mean", regular.alias("_regular"),
                        F.when(mirrored, F.col("_n") - F.col("_x")).otherwise(F.col("_x")).alias("_low"),
                        F.when(mirrored, 1 - F.col("_p")).otherwise(F.col("_p")).alias("_q"),
                        F.ceil(F.when(mirrored, F.col("_n").cast("double") - F.col("_mean")).otherwise(F.col("_mean"))).alias("_from"))
            .withColumn("_limit", F.expr(f"CASE WHEN _regular THEN {binomial_log_pmf('_low', '_n', '_q')} + {math.log(PMF_RTOL)!r}D END")))
    first = _bisected("_from", "_n", f"{binomial_log_pmf('{k}', '_n', '_q')} <= _limit")
    rows = rows.withColumn("_first", F.expr(f"CASE WHEN _regular THEN _n - {first} END"))
    own, opposite = F.expr(binomial_lower_tail("_low", "_n", "_q")), F.expr(binomial_lower_tail("_first", "_n", "(1 - _q)"))
    unknown = F.col("_p").isNull() | F.col("_n").isNull() | F.col("_x").isNull()
    return rows.select(key, F.when(unknown, F.lit(None)).when(F.col("_x").cast("double") == F.col("_mean"), F.lit(1.0))
                       .when(F.col("_regular"), F.least(F.lit(1.0), own + opposite)).otherwise(F.lit(0.0)).alias("p_value"))


def prevalence_binomial(table: DataFrame, n_synthetic: Column, n_real: Column, k: int = 10) -> DataFrame:
    """The prevalence table with a binomial p-value for the top ``k`` diseases.

    For each of the ``k`` most frequent real diseases: x = synthetic patient
    count, n = synthetic population size, p = real count / real population.
    Rows beyond ``k`` keep a NULL p-value.
    """
    top = table.orderBy(F.desc(REAL), F.asc(CONCEPT)).limit(k)
    tests = top.select(CONCEPT, F.col(SYNTH).alias("x"), n_synthetic.alias("n"),
                       F.try_divide(F.col(REAL), n_real).alias("p"))
    pv = binomial_p_values(tests, CONCEPT)
    return table.join(pv, CONCEPT, "left")


def spearman(df: DataFrame, a: str, b: str) -> tuple[float, float, int]:
    """Spearman's rho between two columns, its two-sided p-value and n.

    Ranks (ties averaged) come from distributed histograms, see ``ranks``;
    the driver gets n and rho alone. Rows with a null on either side don't
    count. The p-value uses the t statistic with n - 2 degrees of freedom.
    """
    got = rank_correlation(df, a, b).first()
    n, rho = got["n_rows"], float("nan") if got["rho"] is None else got["rho"]
    if n <= 2 or math.isnan(rho):
        return rho, float("nan"), n
    if abs(rho) >= 1.0:
        return rho, 0.0, n
    t = rho * math.sqrt((n - 2) / ((1.0 + rho) * (1.0 - rho)))
    return rho, student_t_two_sided_p(t, n - 2), n


def spearman_frame(spark: SparkSession, df: DataFrame, a: str, b: str, with_p: bool = True,
                   digits: int = 9) -> DataFrame:
    rho, p, n = spearman(df, a, b)
    rho = round(rho, digits)
    if with_p:
        return spark.createDataFrame([(n, rho, p)], "n_rows long, rho double, p_value double")
    return spark.createDataFrame([(n, rho)], "n_rows long, rho double")
