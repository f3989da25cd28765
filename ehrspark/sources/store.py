"""Person-bucketed storage of the OMOP tables.

Every person-keyed table is written once as a catalog table bucketed (and
sorted) by ``person_id`` with the same bucket count. Spark then plans the
person-level work — per-person aggregates, the visit × death join, cohort
semi-joins, the person-linked drug counts — on the stored bucketing, without
shuffling the tables again. Data files go to an explicit location (shared
storage on a cluster), so the tables are external and survive the session's
catalog.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import STORED_YEAR

LAYOUT = "layout"   # folder of the list of stored tables

PERSON_KEYED = ("person", "visit_occurrence", "death", "condition_occurrence", "drug_exposure",
                "procedure_occurrence", "measurement", "observation", "observation_period")


def store_bucketed(spark: SparkSession, tables: dict[str, DataFrame], database: str, root: str,
                   buckets: int, key: str = "person_id") -> list[str]:
    """Write ``tables`` as ``database.<name>`` bucketed and sorted by ``key``.

    ``buckets`` should give files of a few hundred MB for the largest table
    and be the same for all tables that are joined together.
    """
    location = os.path.join(root, f"_{database}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    written = []
    for name, df in tables.items():
        (df.write.mode("overwrite").format("parquet")
         .option("path", os.path.join(root, name))
         .bucketBy(buckets, key).sortBy(key)
         .saveAsTable(f"{database}.{name}"))
        written.append(f"{database}.{name}")
    return written


def load_tables(spark: SparkSession, database: str, names=PERSON_KEYED) -> dict[str, DataFrame]:
    return {n: spark.table(f"{database}.{n}") for n in names if spark.catalog.tableExists(f"{database}.{n}")}


def store_dated(spark: SparkSession, tables: dict[str, DataFrame], root: str, buckets: int,
                date_columns: dict[str, str], key: str = "person_id") -> None:
    """Write ``tables`` under ``root`` for jobs of other sessions (``attach``): a folder per year of the
    table's date, in it files by person bucket, sorted by date.

    A cut-off skips the files of later years, and inside the last year the row
    groups whose dates are too late; person-level work needs no shuffle. Rows
    meet in the task of their bucket and year, so there are as few files as
    can be; the partitions are rebalanced by size, so the rows of a person who holds a
    large share are split over several tasks and files. Tables without a date have no year.
    """
    listed = []
    database = "stored_while_written"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{os.path.join(root, '_' + database)}'")
    for name, df in tables.items():
        date = date_columns.get(name)
        by = [F.expr(f"pmod(hash(`{key}`), {buckets})").alias("_bucket")]
        if date:
            by.append(F.year(date).alias(STORED_YEAR))
        dealt = df.select("*", *by)
        dealt = dealt.hint("rebalance", *[F.col(c) for c in dealt.columns[len(df.columns):]]).drop("_bucket")
        path = os.path.join(root, name)
        writer = dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key)
        writer = writer.partitionBy(STORED_YEAR).sortBy(date, key) if date else writer.sortBy(key)
        writer.saveAsTable(f"{database}.{name}")
        spark.sql(f"DROP TABLE {database}.{name}")      # of the catalog: the files stay
        listed.append((name, key, buckets, date))
    spark.createDataFrame(listed, "name string, key string, buckets int, date string").coalesce(1).write.mode("overwrite").parquet(os.path.join(root, LAYOUT))


def attach(spark: SparkSession, root: str, database: str) -> dict[str, DataFrame]:
    """The tables that ``store_dated`` wrote under ``root``, as tables of ``database`` in this session's catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{os.path.join(root, '_' + database)}'")
    out = {}
    for t in spark.read.parquet(os.path.join(root, LAYOUT)).collect():      # a row per table
        path, table = os.path.join(root, t.name), f"{database}.{t.name}"
        if not spark.catalog.tableExists(table):
            fields = spark.read.parquet(path).schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            order = f"`{t.date}`, `{t.key}`" if t.date else f"`{t.key}`"
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {f'PARTITIONED BY ({STORED_YEAR})' if t.date else ''} "
                      f"CLUSTERED BY (`{t.key}`) SORTED BY ({order}) INTO {t.buckets} BUCKETS LOCATION '{path}'")
            if t.date:
                spark.sql(f"MSCK REPAIR TABLE {table}")
        out[t.name] = spark.table(table)
    return out
