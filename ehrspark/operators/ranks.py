"""Exact ranks of a column, and their correlation, without a sort in one task.

Values are counted first, so a value that many rows share is one row from then
on. The distinct values are dealt to ranges, each range sums its counts, and a
range's offset is the sum of the ranges before it: only one number for each
range meets in one task. The average rank of a value follows from its offset,
its place in the range and its count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize


def average_ranks(counted: DataFrame, value: str, n: str = "n", name: str = "rank") -> DataFrame:
    """(``value``, ``name``): the average rank, from 1, of each value among rows of which ``counted`` has ``n`` alike.

    A value may occur in several rows of ``counted``; null ones are left out,
    NaN ranks as the greatest and -0.0 as 0.0.
    """
    counts = counted.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(n).alias("_n"))
    # Written, so that a lost executor can't deal the values to other ranges the second time.
    dealt = materialize(counts.repartitionByRange(value).withColumn("_range", F.spark_partition_id()), "ranks")
    sums = dealt.groupBy("_range").agg(F.sum("_n").alias("_s"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)       # one row for each range
    offsets = sums.select("_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return dealt.join(F.broadcast(offsets), "_range").select(value, (smaller + (F.col("_n") + 1) / 2).alias(name))


def rank_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n_rows, rho): Spearman's correlation of two columns over the rows that have both.

    rho is null if a column has one value only. Equal pairs are counted first
    and carry their number, so rows are shuffled once, after partial
    aggregation, and the ranks are joined to distinct pairs.
    """
    plus = lambda c: F.col(c).cast("double") + F.lit(0.0)  # noqa: E731  (-0.0 is 0.0)
    pairs = (df.select(plus(a).alias("_a"), plus(b).alias("_b")).where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
             .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n")))
    pairs = materialize(pairs, "pairs")
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    ranked = (pairs.join(average_ranks(pairs, "_a", name="_ra"), "_a").join(average_ranks(pairs, "_b", name="_rb"), "_b")
              .crossJoin(F.broadcast(total)))        # one row
    # The mean rank is known beforehand, so the sums are of deviations.
    da, db = F.col("_ra") - (F.col("total") + 1) / 2, F.col("_rb") - (F.col("total") + 1) / 2
    sums = ranked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.sum(F.col("n") * da * db).alias("_ab"), F.sum(F.col("n") * da * da).alias("_aa"), F.sum(F.col("n") * db * db).alias("_bb"))
    return sums.select("n_rows", F.try_divide(F.col("_ab"), F.sqrt("_aa") * F.sqrt("_bb")).alias("rho"))
