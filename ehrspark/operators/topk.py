"""Certified top-k: a frequent-items sketch proposes, an exact pass counts, a check proves.

A mergeable sketch of bounded size goes over the keys in one pass. The estimate of a key
it lists is at most ``error`` above the true count and never below it, and a key it
doesn't list occurs 2 · ``error`` times at most, where error = 3.5 · rows / map size.
Keys whose estimate reaches the k-th best lower bound are candidates and are
counted exactly; if the k-th exact count beats every key left out, the list is
proven. Otherwise the sketch is widened, and in the end, where the keys are too even
for any sketch, all keys are counted. Either way the result is exact, ties
go to the smaller key. Only sketches and candidates are shuffled, not the set of keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F

SKETCH_KEYS = 4_096         # keys the first sketch tracks, or 32 k if that is more
WIDEN, MAX_SKETCH_KEYS = 8, 262_144
ERROR_FACTOR = 3.5          # of a frequent-items sketch with a map of 4/3 of the tracked keys, a power of two
MERGE_GROUPS = 64           # sketches are merged in two levels, so no task merges those of all partitions


@dataclass
class Proof:
    """What the last ``certified_top`` did: sketch size (0: all keys were counted), rows, error bound, candidates."""

    size: int
    rows: int
    error: int
    candidates: int


def map_size(tracked: int) -> int:
    """The size of the sketch's map: the power of two that tracks so many keys at a load of 3/4."""
    size = 8
    while size * 3 // 4 < tracked:
        size *= 2
    return size


def _sketch(rows: DataFrame, key: str, tracked: int) -> tuple[int, list[Row]]:
    """(rows with a key, [(item, estimate)] of all keys the merged sketch tracks)."""
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_g")
    sums = [F.count(F.lit(1)).alias("_n"), F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked)).alias("_s")]
    # An empty sketch more, so that there is one to merge where there are no rows.
    parts = rows.groupBy(group).agg(*sums).drop("_g").unionByName(rows.where("false").agg(*sums))
    whole = parts.agg(F.sum("_n").alias("n"), F.call_function("approx_top_k_combine", F.col("_s")).alias("s"))
    found = whole.select("n", F.call_function("approx_top_k_estimate", F.col("s"), F.lit(tracked)).alias("top")).first()
    return found["n"], [r for r in found["top"] if r["item"] is not None]


def certified_top(rows: DataFrame, key: str, k: int, tracked: int | None = None) -> tuple[DataFrame, Proof]:
    """The ``k`` most frequent non-null values of ``key``: ((key, count), most frequent first, ties to the smaller; the proof).

    ``rows`` is read twice, or once more for each widening. At most
    ``MAX_SKETCH_KEYS`` keys and estimates reach the driver.
    """
    rows = rows.select(key).where(F.col(key).isNotNull())
    spark, kind = rows.sparkSession, rows.schema[key].dataType
    order = [F.desc("count"), F.asc(key)]
    size, n = tracked or max(SKETCH_KEYS, 32 * k), 0
    while size <= MAX_SKETCH_KEYS:
        n, found = _sketch(rows, key, size)
        error = int(ERROR_FACTOR * n / map_size(size)) + 1
        lower = sorted((r["count"] - error for r in found), reverse=True)
        floor = lower[k - 1] if len(lower) >= k else 0
        if floor <= 2 * error:                   # a key that isn't listed may be among the first k
            size *= WIDEN
            continue
        names = [r["item"] for r in found if r["count"] >= floor]
        asked = F.broadcast(spark.createDataFrame([(x,) for x in names], f"`{key}` {kind.simpleString()}"))   # MAX_SKETCH_KEYS at most
        exact = rows.join(asked, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("count"))
        return exact.orderBy(*order).limit(k), Proof(size, n, error, len(names))
    everything = rows.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return everything.orderBy(*order).limit(k), Proof(0, n, 0, 0)
