"""Mergeable partial states of condition deliveries.

Conditions arrive in deliveries (files, days, micro-batches). Each is reduced
once to a state table: for every key and bucket of 32,768 person ids the
number of rows and an exact bitmap of the patients. States merge by
adding rows and or-ing bitmaps, in any order and grouping, so totals need no
old delivery to be read again, and a patient in two deliveries counts once. A
delivery that comes again under its name replaces its own state.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import broadcast_if_small
from ..sources.files import exists

PID, CODE, CONCEPT = "person_id", "condition_source_value", "condition_concept_id"
KEYS = (CODE, CONCEPT)
# Concept sets come from small files; above this they are joined by shuffle.
MAX_BROADCAST_SET_ROWS = 1_000_000


def state_of(conditions: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys…, bucket, n_rows, patients): one delivery's state.

    Rows and patients are aggregated map-side into one number and 4 KB for
    each key and bucket, whatever the number of rows of a hot key or patient.
    Rows without a person have a NULL bucket and an empty bitmap.
    """
    person = F.col(PID).cast("long")
    return (conditions.groupBy(*keys, F.bitmap_bucket_number(person).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.bitmap_construct_agg(F.bitmap_bit_position(person)).alias("patients")))


def merge(states: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One state from many: the same columns, one row per (keys…, bucket)."""
    return (states.groupBy(*keys, "bucket")
            .agg(F.sum("n_rows").alias("n_rows"), F.bitmap_or_agg("patients").alias("patients")))


def deliver(conditions: DataFrame, folder: str, name: str, keys: tuple[str, ...] = KEYS) -> None:
    """Write the state of one delivery as ``<folder>/delivery=<name>``; the same name again replaces it."""
    state_of(conditions, keys).write.mode("overwrite").parquet(os.path.join(folder, f"delivery={name}"))


def states(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """The states under ``folder``, of all deliveries or of those named."""
    if names is None:
        return spark.read.parquet(folder).drop("delivery")
    paths = [os.path.join(folder, f"delivery={n}") for n in names]
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"deliveries: {missing}")
    return spark.read.parquet(*paths)


def roll_up(spark: SparkSession, folder: str, names: list[str], into: str, target: str) -> None:
    """Merge the named deliveries into one, ``<target>/delivery=<into>``, so that later merges read less."""
    merge(states(spark, folder, names)).write.mode("overwrite").parquet(os.path.join(target, f"delivery={into}"))


def counts(merged: DataFrame, key: str = CODE) -> DataFrame:
    """(key, count, n_patients): rows and distinct patients, as one run over all deliveries gives them.

    Like the ranking, the NULL key counts 0 rows. Buckets of other keys are or-ed first, so a
    patient with two concepts of one code counts once.
    """
    one = merged.groupBy(key, "bucket").agg(F.sum("n_rows").alias("n_rows"), F.bitmap_or_agg("patients").alias("patients"))
    return one.groupBy(key).agg(F.sum(F.when(F.col(key).isNotNull(), F.col("n_rows")).otherwise(0)).alias("count"),
                                F.sum(F.bitmap_count("patients")).alias("n_patients"))


def distinct_keys(merged: DataFrame, key: str = CODE) -> DataFrame:
    """A12 over all deliveries: one row, the number of distinct non-NULL keys."""
    return merged.agg(F.countDistinct(key).alias("n_keys"))


def set_patients(merged: DataFrame, concept_sets: DataFrame) -> DataFrame:
    """A17 over all deliveries: distinct patients per concept set (set_name, n_patients)."""
    sets = broadcast_if_small(concept_sets.select("set_name", "concept_id").distinct(), MAX_BROADCAST_SET_ROWS)
    hits = merged.join(sets, F.col(CONCEPT) == F.col("concept_id"))
    one = hits.groupBy("set_name", "bucket").agg(F.bitmap_or_agg("patients").alias("patients"))
    return one.groupBy("set_name").agg(F.sum(F.bitmap_count("patients")).alias("n_patients")).where("n_patients > 0")
