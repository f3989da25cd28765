"""Sinks: CSV result files, tables, extracted cohorts, models and vocabularies."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, no row-index column.

    ``single_file`` is for small ranked results only (one writer task).
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Materialise a result (e.g. the mapper table) as files."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_extract(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """The extracted cohort tables, one folder per table."""
    for name, df in tables.items():
        target = os.path.join(folder, name)
        if fmt == "csv":
            write_csv(df, target)
        else:
            write_table(df, target, fmt)


def save_vocabulary(vocab: DataFrame, path: str) -> None:
    """The feature vocabulary as (pos, concept_id[, count]); pos is the feature order."""
    vocab.write.mode("overwrite").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
