"""File sources: OMOP tables as CSV or parquet, the code dictionary, concept sets."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StructField

from .. import schemas


def read_table(spark: SparkSession, path: str, name: str | None = None, fmt: str = "csv",
               columns: list[str] | None = None) -> DataFrame:
    """One OMOP table with its fixed schema.

    CSV files are read by header name, not by position: OMOP exports carry
    many more columns, in any order. Every column of the fixed schema is taken
    by name and cast to its type (ANSI casts fail on malformed values; whole
    numbers written as ``8507.0`` are taken); optional columns missing from
    the file become typed NULLs. All other columns follow as they are.
    ``columns`` selects a subset, and Catalyst prunes the scan to it. Large files are split
    into partitions by Spark, which replaces chunked reading.
    """
    df = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
    schema = schemas.OMOP_SCHEMAS.get(name) if name else None
    if schema is not None:
        present = {c.lower(): c for c in df.columns}
        known = {f.name.lower() for f in schema.fields}
        text = {n.lower() for n, t in df.dtypes if t == "string"}
        df = df.select(*[_typed(F.col(f"`{present[f.name.lower()]}`"), f, f.name.lower() in text) if f.name.lower() in present
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
                       *[F.col(f"`{c}`") for c in df.columns if c.lower() not in known])
    return df.select(*columns) if columns else df


def read_omop_folder(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Every OMOP table found as ``<folder>/<table>.<fmt>``."""
    out = {}
    for name in schemas.OMOP_SCHEMAS:
        p = os.path.join(folder, f"{name}.{fmt}")
        if exists(spark, p):
            out[name] = read_table(spark, p, name, fmt)
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system that its URI names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _typed(col: Column, field: StructField, text: bool) -> Column:
    """A column as the field's type; whole numbers in text may have a fraction of zeros."""
    if text and isinstance(field.dataType, IntegralType):
        number = col.cast("decimal(38,6)")
        whole = F.when(number % 1 == 0, number.cast(field.dataType))
        col = F.when(col.isNull(), F.lit(None)).otherwise(F.coalesce(whole, F.raise_error(F.concat(F.lit(f"{field.name} is no whole number: "), col)).cast(field.dataType)))
    return col.cast(field.dataType).alias(field.name)


def read_code_converter(spark: SparkSession, path: str) -> DataFrame:
    """S3: the header-less dictionary file (conversion_id, icd10, convertion_type, icd9).

    An unquoted empty field is NULL. Malformed rows fail the read.
    """
    return (spark.read.schema(schemas.ICDCODE_CONVERTER)
            .option("header", False).option("mode", "FAILFAST").option("nullValue", "")
            .csv(path))


def duplicate_keys(df: DataFrame, key: str = "conversion_id") -> DataFrame:
    """Key check of a loaded table: keys that occur more than once, or are NULL."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | F.col(key).isNull()))


def read_concept_set(spark: SparkSession, path: str, set_name: str) -> DataFrame:
    """A one-column ``concept_id`` list (CRLF tolerated) as (set_name, concept_id).

    Text that is not a number becomes NULL (``try_cast``) and so never
    matches a condition, as text never matched in the original.
    """
    raw = spark.read.option("header", True).csv(path)
    first = raw.columns[0]
    return raw.select(F.lit(set_name).alias("set_name"),
                      F.expr(f"try_cast(trim(`{first}`) AS BIGINT)").alias("concept_id"))


def read_concept_sets(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All concept sets as one (set_name, concept_id) table."""
    out = None
    for name, p in paths.items():
        df = read_concept_set(spark, p, name)
        out = df if out is None else out.unionByName(df)
    return out
