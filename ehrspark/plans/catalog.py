"""The named query catalogue: ``name -> callable(spark, sf_dir) -> DataFrame``.

Each entry builds the OMOP views over the driver tables of ``sf_dir`` and runs
one operator on them; names match ``oracle.ORACLES``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from ..functions import idsets
from ..operators import codes, cohort, deliveries, drugs, features, labels, models, stats, topk
from ..session import materialize, scratch_path
from ..sources import rejects, sinks
from ..sources.fixtures import OmopData

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the fixture queries (FIXTURES.md): the default 6-month cut-off
# falls after nearly all fixture dates, so extraction uses 24 months; concept
# ids stay below 900, so the top-k queries use k = 50.
CUTOFF_MONTHS = 6
EXTRACT_MONTHS = 24
TOP_K = 50
VOCAB_K = 1000
DRUG_LIMIT = 100
OVERLAP_K = 50
BINOMIAL_TESTS = 10
CV_FOLDS = 20
CV_CS = 10
RESIDUAL_TOL = 1e-8
DIGITS = 9
P_DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (results are compared across engines)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# -- codes ------------------------------------------------------------------

def _code_map(d: OmopData) -> DataFrame:
    return codes.map_codes(d.condition_occurrence, d.icdcode_converter)


def q_code_map(spark, sf_dir):
    return _code_map(OmopData(spark, sf_dir))


def q_icd_mapper(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.build_mapper(d.condition_occurrence, d.icdcode_converter)


def q_mapper_report(spark, sf_dir):
    return codes.mapper_report(_code_map(OmopData(spark, sf_dir)))


def q_unresolved_codes(spark, sf_dir):
    return codes.unresolved_codes(_code_map(OmopData(spark, sf_dir)))


def q_tier1_nine_hits(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.tier_candidate_hits(d.condition_occurrence, d.icdcode_converter, tier=1, candidate=4)


def q_condition_counts(spark, sf_dir):
    return codes.condition_counts(OmopData(spark, sf_dir).condition_occurrence)


def q_mapped_condition_counts(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.mapped_condition_counts(d.condition_occurrence, d.icdcode_converter, d.code_description)


def q_hierarchy_condition_counts(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.hierarchy_condition_counts(d.condition_occurrence, d.icdcode_converter, d.code_description)


def q_icd9_code_count(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.count_icd9_codes(codes.condition_counts(d.condition_occurrence), d.icdcode_converter)


def q_code_labels(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.code_labels(d.condition_occurrence, d.icdcode_converter)


def q_converted_conditions(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return codes.convert_conditions(d.condition_occurrence, d.icdcode_converter)


def q_converted_distinct(spark, sf_dir):
    return codes.distinct_converted(q_converted_conditions(spark, sf_dir))


# -- deliveries ---------------------------------------------------------------

def _two_deliveries(spark, d: OmopData) -> DataFrame:
    """The merged state of the conditions handed over in two parts, by visit, so that many persons are in both."""
    folder = scratch_path(spark, f"deliveries-{uuid.uuid4().hex}")
    for k in (0, 1):
        deliveries.deliver(d.condition_occurrence.where(F.coalesce(F.pmod("visit_occurrence_id", F.lit(2)), F.lit(0)) == k), folder, f"part-{k}")
    return deliveries.merge(deliveries.states(spark, folder))


def _damaged(cond: DataFrame) -> DataFrame:
    """Condition rows as text, some of them with a fault that their ids decide (FIXTURES.md)."""
    text = lambda c: F.col(c).cast("string")
    return cond.select(
        F.when(F.expr("person_id % 101 = 9"), F.concat(text("person_id"), F.lit("0" * 19))).otherwise(text("person_id")).alias("person_id"),
        F.when(F.expr("visit_occurrence_id % 89 = 7"), F.concat(F.lit("v"), text("visit_occurrence_id"))).otherwise(text("visit_occurrence_id")).alias("visit_occurrence_id"),
        F.when(F.expr("condition_concept_id % 83 = 11"), F.concat(text("condition_concept_id"), F.lit(".5"))).otherwise(text("condition_concept_id")).alias("condition_concept_id"),
        F.when(F.expr("condition_source_concept_id % 2 = 1"), F.concat(text("condition_source_concept_id"), F.lit(".0"))).otherwise(text("condition_source_concept_id")).alias("condition_source_concept_id"),
        "condition_source_value",
        F.when(F.expr("person_id % 97 = 5"), F.date_format("condition_start_date", "dd/MM/yyyy")).otherwise(text("condition_start_date")).alias("condition_start_date"))


def q_rejected_conditions(spark, sf_dir):
    """Faults by column and reason of a delivery with flaws, and the good rows under no column."""
    path = scratch_path(spark, f"delivery-{uuid.uuid4().hex}")
    sinks.write_csv(_damaged(OmopData(spark, sf_dir).condition_occurrence), path)
    got = rejects.read_checked(spark, path, "condition_occurrence")
    good = got.good.agg(F.lit("").alias("column"), F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n_rows"))
    return got.rejected.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n_rows")).unionByName(good)


def q_delivered_counts(spark, sf_dir):
    return deliveries.counts(_two_deliveries(spark, OmopData(spark, sf_dir)))


def q_delivered_distinct(spark, sf_dir):
    return deliveries.distinct_keys(_two_deliveries(spark, OmopData(spark, sf_dir)))


def q_delivered_set_patients(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return deliveries.set_patients(_two_deliveries(spark, d), d.concept_set)


# -- cohort -----------------------------------------------------------------

def q_cutoff(spark, sf_dir):
    return cohort.cutoff_date(OmopData(spark, sf_dir).death, CUTOFF_MONTHS)


def _persons(d: OmopData) -> DataFrame:
    return cohort.select_persons(d.person, d.visit_occurrence, d.death)


def q_persons_selected(spark, sf_dir):
    return _persons(OmopData(spark, sf_dir))


def _extracted(d: OmopData, names) -> dict[str, DataFrame]:
    return cohort.extract_tables({n: d.table(n) for n in names}, _persons(d),
                                 cohort.cutoff_date(d.death, EXTRACT_MONTHS))


def q_extract_conditions(spark, sf_dir):
    return _extracted(OmopData(spark, sf_dir), ["condition_occurrence"])["condition_occurrence"]


def q_cohort_id_buckets(spark, sf_dir):
    """The cohort as bitmaps: how many ids each bucket holds."""
    return idsets.id_set(_persons(OmopData(spark, sf_dir)), "person_id").select("bucket", "n")


def q_extract_row_counts(spark, sf_dir):
    return cohort.extract_row_counts(_extracted(OmopData(spark, sf_dir), list(cohort.DATE_COLUMNS)))


# -- drugs ------------------------------------------------------------------

def _drug_counts(d: OmopData, link: str, count: str, population=None) -> DataFrame:
    family, codes_ = (drugs.T2_FAMILY, drugs.T2_CODES) if link == "visit" else (drugs.T1_FAMILY, drugs.T1_CODES)
    cond, drug = d.condition_occurrence, d.drug_exposure
    if population is not None:
        cond = cond.where(stats.population_of(F.col("person_id")) == population)
        drug = drug.where(stats.population_of(F.col("person_id")) == population)
    return drugs.cohort_drug_counts(cond, drug, family, codes_, link=link, count=count, k=DRUG_LIMIT)


def q_drugs_by_visit(spark, sf_dir):
    return _drug_counts(OmopData(spark, sf_dir), "visit", "rows")


def q_drugs_by_visit_patients(spark, sf_dir):
    return _drug_counts(OmopData(spark, sf_dir), "visit", "patients")


def q_drugs_by_person(spark, sf_dir):
    return _drug_counts(OmopData(spark, sf_dir), "person", "rows")


def q_drugs_by_person_patients(spark, sf_dir):
    return _drug_counts(OmopData(spark, sf_dir), "person", "patients")


def q_drug_names(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return drugs.name_drugs(_drug_counts(d, "visit", "rows"), d.concept)


def _overlap(d: OmopData) -> DataFrame:
    # Both populations live in the same tables here: one cohort pass counts
    # drugs per (population, drug); the named top lists are split afterwards.
    counts = drugs.cohort_drug_counts_by_group(d.condition_occurrence, d.drug_exposure, drugs.T1_FAMILY,
                                               drugs.T1_CODES, stats.population_of, link="person", k=DRUG_LIMIT)
    # The named lists (at most 2 × 100 rows) feed both sides of the overlap;
    # written once so the optimizer cannot push each side's filter into its own
    # copy of the cohort pass.
    named = materialize(drugs.name_drugs(counts, d.concept), "named")
    real = named.where(F.col("group")).drop("group")
    synthetic = named.where(~F.col("group")).drop("group")
    return drugs.drug_overlap(real, synthetic, OVERLAP_K)


def q_drug_overlap(spark, sf_dir):
    return _overlap(OmopData(spark, sf_dir))


def q_drug_overlap_rate(spark, sf_dir):
    return rounded(drugs.overlap_rate(_overlap(OmopData(spark, sf_dir)), OVERLAP_K))


# -- two-population statistics ----------------------------------------------

def _prevalence(d: OmopData) -> DataFrame:
    return stats.disease_counts(d.condition_occurrence, stats.population_of(F.col("person_id")))


def q_prevalence_binomial(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    real = stats.population_of(F.col("person_id"))
    n_real = d.person.select(F.count_if(real)).scalar()
    n_syn = d.person.select(F.count_if(~real)).scalar()
    out = stats.prevalence_binomial(_prevalence(d), n_syn, n_real, BINOMIAL_TESTS)
    return rounded(out, P_DIGITS)


def q_prevalence_spearman(spark, sf_dir):
    return stats.spearman_frame(spark, _prevalence(OmopData(spark, sf_dir)), stats.REAL, stats.SYNTH,
                                with_p=False, digits=DIGITS)


def q_prevalence_spearman_test(spark, sf_dir):
    return rounded(stats.spearman_frame(spark, _prevalence(OmopData(spark, sf_dir)), stats.REAL, stats.SYNTH), P_DIGITS)


# -- labels -----------------------------------------------------------------

def _dates(d: OmopData) -> DataFrame:
    return labels.prediction_dates(d.visit_occurrence, d.death)


def q_prediction_dates(spark, sf_dir):
    return _dates(OmopData(spark, sf_dir))


def q_class_balance(spark, sf_dir):
    return labels.class_balance(_dates(OmopData(spark, sf_dir)))


def q_last_visits(spark, sf_dir):
    return labels.last_visits(OmopData(spark, sf_dir).visit_occurrence)


# -- features ---------------------------------------------------------------

def _demo_train(d: OmopData, how: str = "left") -> DataFrame:
    return features.demographic_features(_dates(d), d.person, how=how)


def _demo_infer(d: OmopData) -> DataFrame:
    return features.demographic_features(labels.last_visits(d.visit_occurrence), d.person,
                                         date_col="last_visit_date")


def q_demographic_train(spark, sf_dir):
    return rounded(_demo_train(OmopData(spark, sf_dir)))


def q_demographic_infer(spark, sf_dir):
    return rounded(_demo_infer(OmopData(spark, sf_dir)))


def q_demographic_infer_train_scaled(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    bounds = features.age_bounds(_dates(d), d.person)
    last = labels.last_visits(d.visit_occurrence)
    return rounded(features.demographic_features(last, d.person, date_col="last_visit_date", bounds=bounds))


def q_person_composition(spark, sf_dir):
    return features.person_composition(OmopData(spark, sf_dir).person)


def _five_train(d: OmopData) -> DataFrame:
    return features.condition_flags(_demo_train(d, "inner"), d.condition_occurrence, d.concept_set)


def q_condition_flags(spark, sf_dir):
    return rounded(_five_train(OmopData(spark, sf_dir)))


def q_condition_patients(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    return features.condition_patients(d.condition_occurrence, d.concept_set)


def _events(d: OmopData) -> DataFrame:
    return features.event_concepts(d.condition_occurrence, d.drug_exposure, d.procedure_occurrence)


def q_event_concepts(spark, sf_dir):
    return _events(OmopData(spark, sf_dir))


def q_top_concepts(spark, sf_dir):
    return features.top_concepts(_events(OmopData(spark, sf_dir)), TOP_K)


def q_top_concepts_certified(spark, sf_dir):
    return topk.certified_top(_events(OmopData(spark, sf_dir)), "concept_id", TOP_K)[0]


def q_top_codes_certified(spark, sf_dir):
    return topk.certified_top(OmopData(spark, sf_dir).condition_occurrence, codes.CODE, DRUG_LIMIT)[0]


def q_concept_long(spark, sf_dir):
    ev = _events(OmopData(spark, sf_dir))
    return features.concept_long(ev, features.top_concepts(ev, TOP_K))


def q_concept_wide(spark, sf_dir):
    ev = _events(OmopData(spark, sf_dir))
    return features.concept_wide(ev, features.top_concepts(ev, TOP_K), TOP_K)


def q_complete_rows(spark, sf_dir):
    demo = _demo_train(OmopData(spark, sf_dir)).na.drop(how="any")
    return rounded(demo.drop("person_id"))


# -- models (rows-only checks) ----------------------------------------------

def q_score_demographic(spark, sf_dir, folds: int = CV_FOLDS, n_c: int = CV_CS):
    d = OmopData(spark, sf_dir)
    train = _demo_train(d).na.drop(how="any")
    model, _, _ = models.train_logistic_cv(train, features.DEMOGRAPHIC_COLUMNS, "l2", n_c, folds, max_iter=100)
    return models.score(model, _demo_infer(d))


def q_demographic_grid(spark, sf_dir):
    train = _demo_train(OmopData(spark, sf_dir)).na.drop(how="any")
    return models.grid_search(train, features.DEMOGRAPHIC_COLUMNS, folds=10)


def q_demographic_folds(spark, sf_dir, folds: int = CV_FOLDS):
    """Rows per class and cross-validation fold."""
    train = _demo_train(OmopData(spark, sf_dir)).na.drop(how="any")
    return models.with_folds(train, folds, col="fold").groupBy("fold", "death").agg(F.count(F.lit(1)).alias("n_rows"))


def q_demographic_fit_check(spark, sf_dir, folds: int = CV_FOLDS, n_c: int = CV_CS):
    """All fits of the cross-validation: training rows, and whether the gradient vanishes at the weights."""
    train = _demo_train(OmopData(spark, sf_dir)).na.drop(how="any")
    found = models.fit_residuals(train, features.DEMOGRAPHIC_COLUMNS, n_c, folds)
    return found.select("fold", "c_index", "n_train", (F.col("residual") < RESIDUAL_TOL).alias("at_optimum"))


def q_score_five(spark, sf_dir):
    d = OmopData(spark, sf_dir)
    model = models.train_logistic(_five_train(d), features.FIVE_DISEASE_COLUMNS, "l2", 1.0, max_iter=1500)
    infer = features.condition_flags(_demo_infer(d), d.condition_occurrence, d.concept_set)
    return models.score(model, infer)


def q_score_concepts(spark, sf_dir, k: int = VOCAB_K):
    d = OmopData(spark, sf_dir)
    # The distinct events feed two passes (vocabulary, then vectors): written
    # once to the shared checkpoint folder instead of recomputed.
    ev = materialize(_events(d), "events")
    vocab = features.top_concepts(ev, k)
    vectors, _ = features.concept_vectors(ev, vocab)
    # One row per person; read by training, scoring and the fallback anti-join.
    vectors = materialize(vectors, "vectors")
    label = _dates(d).select("person_id", "death")
    train = vectors.join(label, "person_id", "left").na.fill(0.0, ["death"])
    model = models.train_logistic(train, None, "l1", 1.0, max_iter=10000)
    return models.score_with_fallback(model, vectors, d.visit_occurrence)


def q_prediction_violations(spark, sf_dir):
    return models.validate_predictions(q_score_five(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "code_map": q_code_map,
    "icd_mapper": q_icd_mapper,
    "mapper_report": q_mapper_report,
    "unresolved_codes": q_unresolved_codes,
    "tier1_nine_hits": q_tier1_nine_hits,
    "condition_counts": q_condition_counts,
    "mapped_condition_counts": q_mapped_condition_counts,
    "hierarchy_condition_counts": q_hierarchy_condition_counts,
    "icd9_code_count": q_icd9_code_count,
    "code_labels": q_code_labels,
    "converted_conditions": q_converted_conditions,
    "converted_distinct": q_converted_distinct,
    "rejected_conditions": q_rejected_conditions,
    "delivered_counts": q_delivered_counts,
    "delivered_distinct": q_delivered_distinct,
    "delivered_set_patients": q_delivered_set_patients,
    "cutoff": q_cutoff,
    "persons_selected": q_persons_selected,
    "cohort_id_buckets": q_cohort_id_buckets,
    "extract_conditions": q_extract_conditions,
    "extract_row_counts": q_extract_row_counts,
    "drugs_by_visit": q_drugs_by_visit,
    "drugs_by_visit_patients": q_drugs_by_visit_patients,
    "drugs_by_person": q_drugs_by_person,
    "drugs_by_person_patients": q_drugs_by_person_patients,
    "drug_names": q_drug_names,
    "drug_overlap": q_drug_overlap,
    "drug_overlap_rate": q_drug_overlap_rate,
    "prevalence_binomial": q_prevalence_binomial,
    "prevalence_spearman": q_prevalence_spearman,
    "prevalence_spearman_test": q_prevalence_spearman_test,
    "prediction_dates": q_prediction_dates,
    "class_balance": q_class_balance,
    "last_visits": q_last_visits,
    "demographic_train": q_demographic_train,
    "demographic_infer": q_demographic_infer,
    "demographic_infer_train_scaled": q_demographic_infer_train_scaled,
    "person_composition": q_person_composition,
    "condition_flags": q_condition_flags,
    "condition_patients": q_condition_patients,
    "event_concepts": q_event_concepts,
    "top_concepts": q_top_concepts,
    "top_concepts_certified": q_top_concepts_certified,
    "top_codes_certified": q_top_codes_certified,
    "concept_long": q_concept_long,
    "concept_wide": q_concept_wide,
    "complete_rows": q_complete_rows,
    "score_demographic": q_score_demographic,
    "demographic_grid": q_demographic_grid,
    "demographic_folds": q_demographic_folds,
    "demographic_fit_check": q_demographic_fit_check,
    "score_five": q_score_five,
    "score_concepts": q_score_concepts,
    "prediction_violations": q_prediction_violations,
}
