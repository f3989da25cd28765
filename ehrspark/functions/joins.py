"""Join helpers with explicit size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from ..session import scratch_path

# Upper bound (bytes of values) of any side that is broadcast.
MAX_BROADCAST_BYTES = 512 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: strings by length, arrays of numbers and others as 8 each."""
    def size(f):
        if isinstance(f.dataType, StringType):
            return F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        if isinstance(f.dataType, ArrayType):
            return 8 * F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0))
        return F.lit(8)
    return sum([size(f) for f in df.schema.fields], F.lit(0)).cast("long")


def measured(df: DataFrame, max_rows: int | None, max_bytes: int | None = None, name: str = "side") -> tuple[DataFrame, bool]:
    """(``df`` written once and read back, whether it is small enough to broadcast).

    A side is computed once, by a job that runs at once while the plan is
    built; its size is summed over the written files by partial aggregation
    (an observation would leave the session, and with it fitted models, not
    serializable). Every later use reads the files. ``max_rows`` None: only bytes count.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    side = spark.read.schema(df.schema).parquet(path)
    n, size = side.agg(F.count(F.lit(1)), F.sum(_row_bytes(side))).first()
    fits = (max_rows is None or n <= max_rows) and (size or 0) <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)
    return side, fits


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df``, written once, with a broadcast hint if it holds at most ``max_rows`` rows and ``MAX_BROADCAST_BYTES`` bytes.

    Above the bounds the join stays a shuffle join (AQE still splits skewed
    partitions).
    """
    side, fits = measured(df, max_rows)
    return F.broadcast(side) if fits else side


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (e.g. after ``limit(k)``)."""
    return F.broadcast(df)
