"""Features, drug counts and the pre-aggregated join (hand-made frames)."""

import datetime as dt


from ehrspark.operators import drugs, features

D = dt.date
DRUG_COL = "drug_concept_id"


def test_constant_age_scales_to_zero_and_absent_race_is_zero(spark):
    dates = spark.createDataFrame([(1, D(2000, 1, 1), 0.0), (2, D(2000, 1, 1), 1.0), (3, D(2000, 1, 1), 0.0)],
                                  "person_id long, prediction_date date, death double")
    person = spark.createDataFrame([(1, 8532, 1950, 8527), (2, 8507, 1950, 8516)],
                                   "person_id long, gender_concept_id int, year_of_birth int, race_concept_id int")
    rows = {r["person_id"]: r for r in features.demographic_features(dates, person).collect()}
    assert all(r["scaled_age"] == 0.0 for r in rows.values())
    assert all(r["r_8657"] == 0.0 for r in rows.values())
    assert rows[1]["g_8532"] == 1.0 and rows[2]["g_8532"] == 0.0
    assert rows[3]["g_8532"] == 0.0 and rows[3]["scaled_age"] == 0.0   # unknown person, left join
    inner = features.demographic_features(dates, person, how="inner")
    assert sorted(r["person_id"] for r in inner.collect()) == [1, 2]


def test_shared_concept_id_counts_once_per_domain(spark):
    cond = spark.createDataFrame([(1, 0), (1, 0)], "person_id long, condition_concept_id long")
    drug = spark.createDataFrame([(1, 0)], "person_id long, drug_concept_id long")
    proc = spark.createDataFrame([(1, 5)], "person_id long, procedure_concept_id long")
    ev = features.event_concepts(cond, drug, proc)
    top = {r["concept_id"]: r["count"] for r in features.top_concepts(ev, 10).collect()}
    assert top[0] == 2 and top[5] == 1


def test_top_k_tie_goes_to_smaller_id(spark):
    ev = spark.createDataFrame([(1, 7, "drug"), (2, 3, "drug")], "person_id long, concept_id long, domain string")
    top = features.top_concepts(ev, 1).collect()
    assert [(r["pos"], r["concept_id"]) for r in top] == [(0, 3)]


def test_concept_vectors_follow_vocabulary_order(spark):
    ev = spark.createDataFrame([(1, 10, "condition"), (1, 30, "drug"), (2, 20, "drug"), (3, 99, "drug")],
                               "person_id long, concept_id long, domain string")
    vocab = spark.createDataFrame([(0, 30, 5), (1, 10, 4), (2, 20, 3)], "pos int, concept_id long, count long")
    vec, ids = features.concept_vectors(ev, vocab)
    got = {r["person_id"]: r["features"].toArray().tolist() for r in vec.collect()}
    assert ids == ["30", "10", "20"]
    assert got == {1: [1.0, 1.0, 0.0], 2: [0.0, 0.0, 1.0]}   # person 3 has no vocabulary concept


def _plain_join_counts(cond, drug, key, family, codes_):
    c = drugs.cohort_conditions(cond, family, codes_)
    return {r[0]: r[1] for r in c.join(drug, key, "left").groupBy("drug_concept_id").count().collect()}


def test_pre_aggregated_counts_equal_plain_join(spark):
    cond = spark.createDataFrame([
        (1, 10, "E11.9"), (1, 11, "E11.2"), (1, 12, "250"), (2, 20, "E11.1"), (3, None, "E11.5"), (4, 40, "X"),
    ], "person_id long, visit_occurrence_id long, condition_source_value string")
    drug = spark.createDataFrame([
        (1, 10, 100), (1, 10, 100), (1, 11, 200), (1, 13, 300), (2, 21, None), (3, None, 100),
    ], "person_id long, visit_occurrence_id long, drug_concept_id long")
    for link, key in (("visit", "visit_occurrence_id"), ("person", "person_id")):
        got = {r[0]: r[1] for r in drugs.cohort_drug_counts(cond, drug, "E11", drugs.T2_CODES, link=link).collect()}
        assert got == _plain_join_counts(cond, drug, key, "E11", drugs.T2_CODES)


def test_patient_counts(spark):
    cond = spark.createDataFrame([(1, 10, "E11.9"), (1, 11, "E11.9"), (2, 20, "E11.9")],
                                 "person_id long, visit_occurrence_id long, condition_source_value string")
    drug = spark.createDataFrame([(1, 10, 100), (1, 11, 100), (2, 20, 100)],
                                 "person_id long, visit_occurrence_id long, drug_concept_id long")
    got = drugs.cohort_drug_counts(cond, drug, "E11", (), link="visit", count="patients").collect()
    assert [(r[0], r[1]) for r in got] == [(100, 2)]


def test_name_drugs_and_overlap(spark):
    counts = spark.createDataFrame([(1, 10), (2, 5), (None, 3)], "drug_concept_id long, count long")
    concept = spark.createDataFrame([(1, "A"), (3, "C")], "concept_id long, concept_name string")
    named = drugs.name_drugs(counts, concept).collect()
    assert [(r["drug"], r["count"]) for r in named] == [("A", 10)]
    real = spark.createDataFrame([("A", 10), ("B", 5)], "drug string, count long")
    syn = spark.createDataFrame([("A", 7)], "drug string, count long")
    ov = drugs.drug_overlap(real, syn, k=50)
    assert drugs.overlap_rate(ov, 50).first()[0] == 1 - 1 / 50


def test_grouped_counts_equal_per_population_counts(spark):
    from ehrspark.sources.fixtures import OmopData
    from ehrspark.operators import stats
    from pyspark.sql import functions as F
    d = OmopData(spark, "/root/testdata/sf0.001")
    cond, drug = d.condition_occurrence, d.drug_exposure
    grouped = drugs.cohort_drug_counts_by_group(cond, drug, drugs.T1_FAMILY, drugs.T1_CODES, stats.population_of,
                                                link="person", k=100)
    for pop in (True, False):
        sel = stats.population_of(F.col("person_id")) == pop
        one = drugs.cohort_drug_counts(cond.where(sel), drug.where(sel), drugs.T1_FAMILY, drugs.T1_CODES,
                                       link="person", k=100)
        got = {(r[DRUG_COL], r["count"]) for r in grouped.where(F.col("group") == pop).collect()}
        assert got == {(r[DRUG_COL], r["count"]) for r in one.collect()}

