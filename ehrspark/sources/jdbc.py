"""Database sources (S4, S5): a query or a table over JDBC.

Credentials are passed as options by the caller (e.g. from a secret store or
environment set up by the cluster), never written in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
               fetchsize: int = 10_000) -> DataFrame:
    """The rows of one SQL query, read by a single JDBC connection."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                     num_partitions: int, properties: dict[str, str] | None = None,
                     fetchsize: int = 10_000) -> DataFrame:
    """A table read in ``num_partitions`` parallel range slices of ``column``.

    Replaces a client-side chunked cursor: each slice is one task with its own
    connection; ``fetchsize`` bounds the rows per round trip.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", num_partitions).option("fetchsize", fetchsize))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
