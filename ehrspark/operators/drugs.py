"""Drug rankings for a disease cohort and the two-population overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.codes import like_family
from ..functions.joins import bounded_broadcast, measured

CODE = "condition_source_value"
DRUG = "drug_concept_id"

# ICD-9 codes that also select the cohort, as listed in the
# reference queries (duplicates included; they do not change the result).
T2_CODES = ("250", "250.2", "250.3", "250.4", "250.5", "250.6", "250.7", "250.8", "250.9", "357.2",
            "366.41", "349.89", "353.5", "355.9", "357.2", "362.01", "362.02", "362.04", "362.03",
            "362.05", "362.06", "362.07", "443.81", "523.8", "536.3", "713.5", "716.8", "785.6",
            "250.22", "250.32", "250.42", "250.52", "250.62", "250.72", "250.82", "250.92")
T1_CODES = ("250.01", "250.03", "250.13", "250.23", "250.11", "250.31", "250.33", "250.41", "250.42",
            "250.43", "250.51", "250.61", "250.71", "250.81", "250.91", "357.2", "366.41", "250.41",
            "250.51", "250.61", "250.71", "349.89", "353.5", "355.9", "357.2", "362.01", "362.02",
            "362.04", "362.05", "362.06", "362.07", "443.81", "523.8", "536.3", "713.5", "716.8",
            "785.4", "250.53", "250.63", "250.73", "250.83", "250.93")
T2_FAMILY = "E11"
T1_FAMILY = "E10"

LINK_KEYS = {"visit": "visit_occurrence_id", "person": "person_id"}

# Upper bound (rows) for broadcasting the cohort's link keys to the drug rows.
# Above it all drug rows are aggregated and shuffled by their key.
MAX_BROADCAST_COHORT = 5_000_000


def cohort_conditions(conditions: DataFrame, family: str, codes, ignore_case: bool = False) -> DataFrame:
    """Condition rows whose code is ``<family>.[A-Z0-9]…`` or one of ``codes``."""
    return conditions.where(like_family(F.col(CODE), family, ignore_case) | F.col(CODE).isin(list(codes)))


def _of_cohort(drugs: DataFrame, cond: DataFrame, key: str, how: str) -> DataFrame:
    """Drug rows of the cohort's keys, ``cond`` being broadcast."""
    keyed = drugs.select(F.col(key).alias("_key"), DRUG)
    return keyed.join(F.broadcast(cond), F.col("_key") == F.col(key), how)


def _weighted(cond: DataFrame, drugs: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, drug, _w): joined rows per cohort key and drug, a key without a drug under the NULL drug.

    ``cond`` holds (key, by…, _n_cond). It is written once, so the conditions
    are read once. A cohort of checked size is broadcast,
    and only its own drug rows are aggregated and shuffled.
    """
    cond, small = measured(cond, MAX_BROADCAST_COHORT, name="cohort")
    if small:
        drug = _of_cohort(drugs, cond, key, "inner").groupBy("_key", *by, DRUG).agg(F.sum("_n_cond").alias("_w"))
        drug = drug.select("_key", *[F.col(c).alias(f"_{c}") for c in by], DRUG, "_w")
        same = F.col(key) == F.col("_key")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return cond.join(drug, same, "left").select(*by, DRUG, F.coalesce("_w", "_n_cond").alias("_w"))
    drug = drugs.groupBy(key, DRUG).agg(F.count(F.lit(1)).alias("_n_drug"))
    weight = F.col("_n_cond") * F.coalesce(F.col("_n_drug"), F.lit(1))
    return cond.join(drug, key, "left").select(*by, DRUG, weight.alias("_w"))


def cohort_drug_counts(conditions: DataFrame, drugs: DataFrame, family: str, codes,
                       link: str = "visit", count: str = "rows", k: int = 100,
                       ignore_case: bool = False) -> DataFrame:
    """Top-``k`` drugs for a disease cohort: (drug_concept_id, count).

    ``link="visit"`` pairs a cohort condition with the drugs of the same
    visit, ``"person"`` with every drug of the same person (left join, so a
    condition without a drug falls in the NULL drug group).
    ``count="rows"`` counts joined rows, ``"patients"`` distinct persons.

    Rows mode never materialises the join: conditions are pre-aggregated per
    link key, drugs per (key, drug), and the joined row count per drug is
    Σ n_cond · n_drug (n_drug = 1 for keys without a drug). A person with many
    conditions and many drugs costs one row per drug. Drug rows are reduced to
    the cohort's keys first if these can be broadcast.
    """
    key = LINK_KEYS[link]
    cohort = cohort_conditions(conditions, family, codes, ignore_case)
    if count == "rows":
        cond = cohort.groupBy(key).agg(F.count(F.lit(1)).alias("_n_cond"))
        counts = _weighted(cond, drugs, key).groupBy(DRUG).agg(F.sum("_w").alias("count"))
    elif count == "patients":
        cond = cohort.select(key, "person_id").distinct() if key != "person_id" else \
            cohort.select(key).distinct()
        drug = drugs.select(key, DRUG)
        cond, small = measured(cond, MAX_BROADCAST_COHORT, name="cohort")
        if small:
            drug = _of_cohort(drugs, cond, key, "left_semi").select(F.col("_key").alias(key), DRUG)
        joined = cond.join(drug.distinct(), key, "left")
        # A person has one row per drug already if persons are the link.
        persons = F.count("person_id") if key == "person_id" else F.countDistinct("person_id")
        counts = joined.groupBy(DRUG).agg(persons.alias("count"))
    else:
        raise ValueError(f"count must be 'rows' or 'patients', not {count!r}")
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(DRUG)).limit(k)


def cohort_drug_counts_by_group(conditions: DataFrame, drugs: DataFrame, family: str, codes,
                                group_of, link: str = "person", k: int = 100,
                                ignore_case: bool = False) -> DataFrame:
    """X9 for several populations of one table in one pass: (group, drug_concept_id, count).

    ``group_of(person_id_column)`` names the population of a person (e.g.
    real / synthetic). Joined rows are counted per (group, drug) as in
    ``cohort_drug_counts(count="rows")``, then the top ``k`` drugs are kept
    per group. The window partition of a group holds one row per distinct
    drug, so it is bounded by the drug vocabulary, not by the data.
    """
    key = LINK_KEYS[link]
    group: Column = group_of(F.col("person_id")).alias("group")
    cohort = cohort_conditions(conditions, family, codes, ignore_case)
    cond = cohort.groupBy(key, group).agg(F.count(F.lit(1)).alias("_n_cond"))
    counts = _weighted(cond, drugs, key, ("group",)).groupBy("group", DRUG).agg(F.sum("_w").alias("count"))
    w = Window.partitionBy("group").orderBy(F.desc("count"), F.asc_nulls_last(DRUG))
    return counts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def name_drugs(counts: DataFrame, concept: DataFrame) -> DataFrame:
    """(drug, count) — ids replaced by concept names; ids without a name drop.

    ``counts`` is a top-k list (bounded by its limit), so it is the broadcast
    side and the concept table is only scanned.
    """
    extra = [c for c in counts.columns if c not in (DRUG, "count")]
    return (concept.join(bounded_broadcast(counts), concept["concept_id"] == counts[DRUG])
            .select(*extra, F.col("concept_name").alias("drug"), F.col("count")))


def drug_overlap(real: DataFrame, synthetic: DataFrame, k: int = 50) -> DataFrame:
    """X11: the top-``k`` real drugs with the synthetic count next to them.

    Columns: drug, count, synpuf_count (NULL when absent from the other list).
    """
    top = real.orderBy(F.desc("count"), F.asc("drug")).limit(k)
    other = synthetic.select("drug", F.col("count").alias("synpuf_count"))
    return top.join(other, "drug", "left")


def overlap_rate(overlap: DataFrame, k: int = 50) -> DataFrame:
    """Share of the top-``k`` real drugs present in the synthetic list.

    The divisor is ``k`` whatever the list length, as in the reference.
    """
    return overlap.agg((F.lit(1.0) - F.count_if(F.col("synpuf_count").isNull()) / F.lit(float(k)))
                       .alias("overlap_rate"))
