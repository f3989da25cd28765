"""Model features: demographics, chronic-disease flags, concept vocabulary and matrix."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import age_years
from ..functions.joins import bounded_broadcast, broadcast_if_small
from ..session import materialize

PID = "person_id"

# Feature concept ids and their order.
# 8532 female; races 8516 Black or African American, 8515 Asian, 8527 White,
# 8557 Native Hawaiian or Other Pacific Islander, 8657 American Indian or Alaska Native.
GENDER_CONCEPTS = (8532,)
RACE_CONCEPTS = (8516, 8515, 8527, 8557, 8657)
# The five chronic-disease concept sets, in feature order.
DISEASE_SETS = ("cancer", "HD", "COPD", "T2DM", "stroke")

DEMOGRAPHIC_COLUMNS = (["scaled_age"] + [f"g_{c}" for c in GENDER_CONCEPTS]
                       + [f"r_{c}" for c in RACE_CONCEPTS])
FIVE_DISEASE_COLUMNS = DEMOGRAPHIC_COLUMNS + list(DISEASE_SETS)

# Concept sets come from small files; above this they are joined by shuffle.
MAX_BROADCAST_SET_ROWS = 1_000_000


def _with_age(dates: DataFrame, person: DataFrame, date_col: str) -> DataFrame:
    p = (person.select(PID, "gender_concept_id", "year_of_birth", "race_concept_id")
         .withColumn("_known", F.lit(True)))
    return dates.join(p, PID, "left").withColumn("_age", age_years(F.col(date_col), F.col("year_of_birth")))


def age_bounds(dates: DataFrame, person: DataFrame, date_col: str = "prediction_date") -> DataFrame:
    """One row (lo, hi): the least and the greatest age over ``dates``."""
    return _with_age(dates, person, date_col).agg(F.min("_age").alias("lo"), F.max("_age").alias("hi"))


def scaled(age: Column, lo: Column, hi: Column) -> Column:
    """``age`` scaled so that [lo, hi] becomes [0, 1] (a constant age: 0), a missing one 0; values outside are not clipped."""
    return F.coalesce(F.when(hi > lo, (age - lo) / (hi - lo)).otherwise(age - lo), F.lit(0.0))


def demographic_features(dates: DataFrame, person: DataFrame, date_col: str = "prediction_date",
                         how: str = "left", bounds: DataFrame | None = None, raw_age: bool = False) -> DataFrame:
    """Scaled age, female flag and five race flags per prediction row.

    ``dates`` holds person_id, ``date_col`` and optionally ``death``. Age is
    days from 1 January of the birth year to the date / 365.25, min-max
    scaled over the rows of ``dates`` themselves (a constant age scales to 0),
    or by ``bounds``, one row (lo, hi) such as ``age_bounds`` gives for the training rows, so
    that a person scores the same alone and in a crowd. ``raw_age`` leaves ``age`` unscaled for a
    model that holds its own scaler.
    ``how="inner"`` drops rows whose person is unknown; with ``"left"`` they
    keep all-zero features. Min and max are one scalar subquery; the person
    join is a shuffle join on the person key. Where the joined rows are read twice
    (bounds, then features), they are written once rather than recomputed.
    """
    j = _with_age(dates, person, date_col)
    if raw_age:
        age = F.col("_age").alias("age")
    else:
        if bounds is None:
            j = materialize(j, "aged")
            bounds = j.agg(F.min("_age").alias("lo"), F.max("_age").alias("hi"))
        ends = bounds.select(F.struct("lo", "hi")).scalar()
        age = scaled(F.col("_age"), ends.getField("lo"), ends.getField("hi")).alias("scaled_age")
    if how == "inner":
        j = j.where(F.col("_known"))
    flags = ([F.when(F.col("gender_concept_id") == c, 1.0).otherwise(0.0).alias(f"g_{c}") for c in GENDER_CONCEPTS]
             + [F.when(F.col("race_concept_id") == c, 1.0).otherwise(0.0).alias(f"r_{c}") for c in RACE_CONCEPTS])
    lead = ["death"] if "death" in dates.columns else []
    return j.select(*lead, PID, age, *flags)


def person_composition(person: DataFrame) -> DataFrame:
    """Persons per gender and per race concept: (attribute, concept_id, n_persons).

    One scan: each person row yields one (attribute, concept) pair per
    attribute, counted in a single aggregation.
    """
    pairs = F.array(F.struct(F.lit("gender").alias("attribute"), F.col("gender_concept_id").alias("concept_id")),
                    F.struct(F.lit("race").alias("attribute"), F.col("race_concept_id").alias("concept_id")))
    return (person.select(F.inline(pairs))
            .groupBy("attribute", "concept_id").agg(F.count(F.lit(1)).alias("n_persons")))


def _set_hits(conditions: DataFrame, concept_sets: DataFrame) -> DataFrame:
    sets = broadcast_if_small(concept_sets.select("set_name", "concept_id").distinct(), MAX_BROADCAST_SET_ROWS)
    return (conditions.select(PID, "condition_concept_id")
            .join(sets, F.col("condition_concept_id") == F.col("concept_id"))
            .select(PID, "set_name").distinct())


def condition_flags(features: DataFrame, conditions: DataFrame, concept_sets: DataFrame,
                    set_names=DISEASE_SETS) -> DataFrame:
    """One 0/1 column per concept set: the person has a condition in the set.

    One scan of the condition table for all sets (the sets are one small
    table), then one row per person.
    """
    hits = _set_hits(conditions, concept_sets)
    per_person = hits.groupBy(PID).agg(
        *[F.max(F.when(F.col("set_name") == s, 1.0)).alias(s) for s in set_names])
    return features.join(per_person, PID, "left").na.fill(0.0, list(set_names))


def condition_patients(conditions: DataFrame, concept_sets: DataFrame) -> DataFrame:
    """Distinct patients per concept set: (set_name, n_patients)."""
    return _set_hits(conditions, concept_sets).groupBy("set_name").agg(F.count(F.lit(1)).alias("n_patients"))


def event_concepts(conditions: DataFrame, drugs: DataFrame, procedures: DataFrame) -> DataFrame:
    """(person_id, concept_id, domain), distinct within each domain.

    A concept id present in two domains stays twice (once per domain).
    """
    parts = [(conditions, "condition_concept_id", "condition"),
             (drugs, "drug_concept_id", "drug"),
             (procedures, "procedure_concept_id", "procedure")]
    out = None
    for df, col, domain in parts:
        d = (df.select(PID, F.col(col).alias("concept_id")).distinct()
             .withColumn("domain", F.lit(domain)))
        out = d if out is None else out.unionByName(d)
    return out


def top_concepts(events: DataFrame, k: int = 1000) -> DataFrame:
    """The ``k`` most frequent concepts: (pos, concept_id, count).

    Frequency is the number of (person, domain) rows; ties go to the smaller
    id. ``pos`` (0-based) is the feature position. The window numbers at most
    ``k`` rows after the limit.
    """
    top = (events.where(F.col("concept_id").isNotNull())
           .groupBy("concept_id").agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.desc("count"), F.asc("concept_id")).limit(k))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), F.asc("concept_id"))
    return top.select((F.row_number().over(w) - 1).cast("int").alias("pos"), "concept_id", "count")


def concept_long(events: DataFrame, vocab: DataFrame) -> DataFrame:
    """X20, long form: (person_id, pos, concept_id) for vocabulary concepts present."""
    v = bounded_broadcast(vocab.select("pos", "concept_id"))
    # Same NULL filter as the vocabulary pass, so both passes over the events
    # plan identical shuffles that AQE can reuse.
    return (events.where(F.col("concept_id").isNotNull()).join(v, "concept_id")
            .select(PID, "pos", "concept_id").distinct())


def concept_wide(events: DataFrame, vocab: DataFrame, k: int) -> DataFrame:
    """X20, wide form for small ``k``: person_id and 0/1 columns f_000 … in vocabulary order.

    Only persons with at least one vocabulary concept appear.
    """
    long = concept_long(events, vocab)
    return long.groupBy(PID).agg(
        *[F.max(F.when(F.col("pos") == i, 1.0).otherwise(0.0)).alias(f"f_{i:03d}") for i in range(k)])


def concept_vectors(events: DataFrame, vocab: DataFrame, output_col: str = "features") -> tuple[DataFrame, list[str]]:
    """(person_id, features) — a sparse 0/1 vector in vocabulary order.

    The vocabulary (k ids, bounded by k) is the only thing brought to the
    driver; CountVectorizerModel maps each person's concept set to positions.
    """
    ids = [str(r["concept_id"]) for r in vocab.orderBy("pos").select("concept_id").collect()]
    terms = (concept_long(events, vocab)
             .groupBy(PID).agg(F.collect_set(F.col("concept_id").cast("string")).alias("_terms")))
    model = CountVectorizerModel.from_vocabulary(ids, inputCol="_terms", outputCol=output_col, binary=True)
    return model.transform(terms).select(PID, output_col), ids
