"""Sources, sinks and models: round trips and solver parity."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixture_paths import REFERENCE, SF_SMALL
from ehrspark.operators import features, labels, models
from ehrspark.plans import catalog
from ehrspark.sources import files, jdbc, sinks
from ehrspark.sources.fixtures import OmopData


def test_csv_table_round_trip(spark, tmp_path):
    d = OmopData(spark, SF_SMALL)
    visits = d.visit_occurrence
    sinks.write_csv(visits, str(tmp_path / "visit_occurrence.csv"))
    back = files.read_table(spark, str(tmp_path / "visit_occurrence.csv"), "visit_occurrence")
    assert back.schema == files.schemas.VISIT_OCCURRENCE
    assert back.count() == visits.count()
    assert back.exceptAll(visits).count() == 0
    sub = files.read_table(spark, str(tmp_path / "visit_occurrence.csv"), "visit_occurrence",
                           columns=["person_id"])
    assert sub.columns == ["person_id"]


def test_code_converter_load_and_key_check(spark, tmp_path):
    p = tmp_path / "icdconverter.csv"
    p.write_text("1,E11.9,1,25000\n2,,9,2500\n3,E10.1,10,\n3,X,4,777\n")
    conv = files.read_code_converter(spark, str(p))
    rows = {(r["conversion_id"], r["convertion_type"]): r for r in conv.collect()}
    assert rows[(2, 9)]["icd10"] is None and rows[(3, 10)]["icd9"] is None
    assert [r["conversion_id"] for r in files.duplicate_keys(conv).collect()] == [3]


def test_concept_set_crlf_and_text(spark, tmp_path):
    p = tmp_path / "cancer_condition_id.csv"
    p.write_bytes(b"concept_id\r\n133725\r\n133726\r\nnot-a-number\r\n")
    got = [r["concept_id"] for r in files.read_concept_set(spark, str(p), "cancer").collect()]
    assert got == [133725, 133726, None]


def _committed_csvs(header: str) -> list[str]:
    """CSV files under the reference folder whose first line is ``header``."""
    out = []
    for root, _, names in os.walk(REFERENCE):
        for n in names:
            if n.endswith(".csv"):
                p = os.path.join(root, n)
                with open(p, encoding="utf-8", errors="replace") as fh:
                    if fh.readline().strip() == header:
                        out.append(p)
    return sorted(out)


@pytest.mark.skipif(not os.path.isdir(REFERENCE), reason="reference folder absent")
def test_committed_concept_sets_are_disjoint(spark):
    paths = {os.path.basename(p).split("_")[0]: p for p in _committed_csvs("concept_id")}
    sets = files.read_concept_sets(spark, paths)
    sizes = {r[0]: r[1] for r in sets.groupBy("set_name").agg(F.countDistinct("concept_id")).collect()}
    assert sizes == {"cancer": 404, "HD": 76, "COPD": 11, "T2DM": 104, "stroke": 153}
    assert sets.groupBy("concept_id").agg(F.countDistinct("set_name").alias("n")).where("n > 1").count() == 0


def test_jdbc_round_trip_in_process_derby(spark):
    url = "jdbc:derby:memory:ehrtest;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(1, 101).select(F.col("id").alias("person_id"), (F.col("id") % 7).alias("concept_id"))
    df.write.jdbc(url, "EVENTS", mode="overwrite", properties=props)
    q = jdbc.read_query(spark, url, 'SELECT * FROM EVENTS WHERE "concept_id" = 3', props)
    assert q.count() == len([i for i in range(1, 101) if i % 7 == 3])
    parts = jdbc.read_partitioned(spark, url, "EVENTS", "person_id", 1, 100, 4, props)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 100


def test_model_and_vocabulary_round_trip(spark, tmp_path):
    d = OmopData(spark, SF_SMALL)
    train = catalog._five_train(d)
    model = models.train_logistic(train, features.FIVE_DISEASE_COLUMNS, "l2", 1.0, max_iter=1500)
    models.save_model(model, str(tmp_path / "model"))
    again = models.load_model(str(tmp_path / "model"))
    a = {r[0]: r[1] for r in models.score(model, train).collect()}
    b = {r[0]: r[1] for r in models.score(again, train).collect()}
    assert a == b
    assert models.validate_predictions(models.score(model, train)).first()[1:] == (0, 0)
    vocab = features.top_concepts(catalog._events(d), 20)
    sinks.save_vocabulary(vocab, str(tmp_path / "vocab"))
    back = sinks.load_vocabulary(spark, str(tmp_path / "vocab")).orderBy("pos").collect()
    assert [r["concept_id"] for r in back] == [r["concept_id"] for r in vocab.orderBy("pos").collect()]


def _newton_l2(X, y, C, iters=100):
    """sklearn's objective: 0.5·||w||² + C·Σ log-loss, intercept not penalised."""
    n, k = X.shape
    Xb = np.hstack([X, np.ones((n, 1))])
    w = np.zeros(k + 1)
    reg = np.eye(k + 1)
    reg[-1, -1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = C * Xb.T @ (p - y) + reg @ w
        H = C * (Xb.T * (p * (1 - p))) @ Xb + reg
        w -= np.linalg.solve(H, g)
    return w


def test_l2_coefficients_match_newton_solution(spark):
    d = OmopData(spark, "/root/testdata/sf0.01")
    train = catalog._five_train(d)
    cols = features.FIVE_DISEASE_COLUMNS
    model = models.train_logistic(train, cols, "l2", 1.0, max_iter=1500, tol=1e-10)
    lr = model.stages[-1]
    pdf = train.select(*cols, "death").toPandas()
    w = _newton_l2(pdf[cols].to_numpy(), pdf["death"].to_numpy(), 1.0)
    np.testing.assert_allclose(np.append(lr.coefficients.toArray(), lr.intercept), w, atol=1e-3)


def test_cross_validation_picks_a_grid_value(spark):
    d = OmopData(spark, SF_SMALL)
    train = catalog._demo_train(d).na.drop()
    model, best_c, acc = models.train_logistic_cv(train, features.DEMOGRAPHIC_COLUMNS, "l2", Cs=3, folds=3)
    assert best_c in models.c_grid(3) and 0.0 <= acc <= 1.0
    scores = models.score(model, catalog._demo_infer(d))
    assert models.validate_predictions(scores).first()[1:] == (0, 0)


def test_concept_scores_cover_every_visiting_person(spark):
    d = OmopData(spark, SF_SMALL)
    scores = catalog.q_score_concepts(spark, SF_SMALL, k=50)
    visiting = labels.last_visits(d.visit_occurrence).select("person_id")
    assert scores.select("person_id").distinct().count() == scores.count()
    assert visiting.join(scores, "person_id", "left_anti").count() == 0


def test_training_rows_are_parted_by_their_features(spark, monkeypatch):
    """As many partitions as the values need, from fewer as from more; one task held all rows up to a million before."""
    monkeypatch.setattr(models, "VALUES_PER_PARTITION", 1_000)
    rows = spark.range(0, 90, 1, 3).select(F.col("id").alias("person_id"), F.array(*[F.col("id").cast("double")] * 100).alias("x"))
    for parts in (1, 3, 40):
        data, n = models.cached_training_set(rows.repartition(parts), F.size("x"))
        assert n == 90 and data.rdd.getNumPartitions() == 9 and data.agg(F.sum("person_id")).first()[0] == 45 * 89
        assert max(data.rdd.glom().map(len).collect()) <= 30
        data.unpersist()
    assert models.cached_training_set(rows.limit(0), F.size("x"))[1] == 0


def test_zero_vector_score_for_persons_without_vocabulary(spark):
    import math
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    schema = StructType([StructField("person_id", LongType()), StructField("features", VectorUDT()),
                         StructField("death", DoubleType())])
    train = spark.createDataFrame([(1, Vectors.sparse(2, [0], [1.0]), 1.0), (2, Vectors.sparse(2, [1], [1.0]), 0.0),
                                   (3, Vectors.sparse(2, [0, 1], [1.0, 1.0]), 1.0), (4, Vectors.sparse(2, [], []), 0.0)],
                                  schema)
    model = models.train_logistic(train, None, "l1", 1.0, max_iter=100)
    vectors = train.where("person_id < 4").select("person_id", "features")
    visits = spark.createDataFrame([(1,), (4,), (5,), (5,)], "person_id long")
    got = {r[0]: r[1] for r in models.score_with_fallback(model, vectors, visits).collect()}
    b = model.stages[-1].intercept
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[4] == pytest.approx(1 / (1 + math.exp(-b))) and got[5] == got[4]


@pytest.mark.skipif(not os.path.isdir(REFERENCE), reason="reference folder absent")
def test_committed_drug_lists_overlap(spark):
    from ehrspark.operators import drugs
    first, second = _committed_csvs("drug,count")
    read = lambda p: (spark.read.option("header", True).csv(p)
                      .select("drug", F.col("count").cast("long").alias("count")))
    t1, t2 = read(first), read(second)
    assert t1.count() == 50 and t2.count() == 50
    ov = drugs.drug_overlap(t1, t2, k=50)
    assert drugs.overlap_rate(ov, 50).first()[0] == pytest.approx(0.88)


def test_csv_read_by_header_with_extra_columns(spark, tmp_path):
    p = tmp_path / "visit_occurrence.csv"
    p.write_text("visit_start_date,care_site_id,person_id,visit_occurrence_id\n2001-02-03,9,7,1\n2002-03-04,9,8,2\n")
    df = files.read_table(spark, str(p), "visit_occurrence")
    assert df.columns == ["visit_occurrence_id", "person_id", "visit_start_date", "care_site_id"]
    rows = sorted(tuple(r)[:3] for r in df.collect())
    import datetime as dt
    assert rows == [(1, 7, dt.date(2001, 2, 3)), (2, 8, dt.date(2002, 3, 4))]
    death = tmp_path / "death.csv"
    death.write_text("person_id,death_date\n7,2003-01-01\n")
    d = files.read_table(spark, str(death), "death")
    assert d.first()["death_datetime"] is None and d.schema == files.schemas.DEATH


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(0, 5003).select(F.col("id").alias("person_id"),
                                     F.when(F.col("id") % 7 == 0, 1.0).otherwise(0.0).alias("death"))
    a = models.with_folds(df, 20)
    per = a.groupBy("death", "_fold").count().groupBy("death").agg(F.min("count").alias("lo"),
                                                                    F.max("count").alias("hi"),
                                                                    F.countDistinct("_fold").alias("k"))
    for r in per.collect():
        assert r["k"] == 20 and r["hi"] - r["lo"] <= 1
    b = models.with_folds(df.repartition(7), 20)
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_whole_numbers_with_a_fraction_of_zeros_and_uris(spark, tmp_path):
    (tmp_path / "death.csv").write_text("person_id,death_date,cause\n7.0,2003-01-01,x\n,2003-01-02,y\n")
    found = files.read_omop_folder(spark, tmp_path.as_uri())
    assert set(found) == {"death"} and "cause" in found["death"].columns
    assert sorted(r.person_id or 0 for r in found["death"].collect()) == [0, 7]
    (tmp_path / "death.csv").write_text("person_id,death_date\n7.5,2003-01-01\n")
    with pytest.raises(Exception, match="no whole number"):
        files.read_omop_folder(spark, str(tmp_path))["death"].collect()


def test_stored_mode_names_a_missing_table(spark):
    from ehrspark.sources.fixtures import OmopData
    with pytest.raises(KeyError, match="death"):
        OmopData.from_tables(spark, {}).table("death")


def _spark_fit(rows, penalty, c, n):
    """One fit by itself, to a tight tolerance."""
    from pyspark.ml.functions import array_to_vector
    _, lr = models._estimator(None, penalty, 2000, 1e-14)
    lr.setRegParam(1.0 / (c * n))
    m = lr.fit(rows.select(array_to_vector("_x").alias("features"), F.col("_y").alias("death")))
    return np.append(m.coefficients.toArray(), m.intercept)


def test_shared_fits_equal_separate_fits(spark):
    from ehrspark.operators import shared_fits
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.random(900), rng.random((900, 3)) < [0.5, 0.1, 0.02], rng.normal(size=900), np.zeros(900)]).astype(float)
    y = (rng.random(900) < 1 / (1 + np.exp(1.5 - 3 * x[:, 0] + 2 * x[:, 2] - x[:, 4]))).astype(float)
    rows = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "person_id long, _x array<double>, _y double")
    rows = models.with_folds(rows, 4, label="_y").cache()
    fits = [shared_fits.Fit(c, f, p) for p in ("l2", "l1") for c in (0.01, 1.0, 100.0) for f in (None, 0, 3)]
    passes = shared_fits.newton_fits(rows, fits, 6)
    assert passes < 40 and shared_fits.residuals(rows, fits, 6)[:, 1].max() < 1e-9
    for f in fits:
        own = rows if f.fold is None else rows.where(F.col("_fold") != f.fold)
        n = own.count()
        near = dict(atol=1e-6) if f.penalty == "l2" else dict(atol=1e-4)
        np.testing.assert_allclose(f.weights, _spark_fit(own, f.penalty, f.c, n), **near)
    hits = shared_fits.held_out_hits(rows, [f.weights for f in fits if f.fold is not None], [f.fold for f in fits if f.fold is not None], 6)
    held = rows.where("_fold = 3").collect()
    w = fits[2].weights
    right = sum((np.dot(r["_x"], w[:-1]) + w[-1] > 0) == (r["_y"] > 0.5) for r in held)
    assert hits[1].tolist() == [len(held), right]
    rows.unpersist()


def test_steps_of_a_path_are_the_points_of_the_grid(spark):
    from ehrspark.operators import shared_fits
    rows = spark.createDataFrame([(i, [i / 40.0], float(i % 3 == 0), i % 2) for i in range(40)], "person_id long, _x array<double>, _y double, _fold int")
    long, short = shared_fits.Fit(1.0, None, "l2", 50), shared_fits.Fit(1.0, None, "l2", 1)
    shared_fits.newton_fits(rows, [long], 1)
    shared_fits.newton_fits(rows, [short], 1)
    np.testing.assert_allclose(long.weights_after(1), short.weights)
    np.testing.assert_allclose(long.weights_after(1000), long.weights)
    one_class = shared_fits.Fit(1.0, None, "l2", 20)
    shared_fits.newton_fits(rows.withColumn("_y", F.lit(0.0)), [one_class], 1)
    assert one_class.done and one_class.weights[-1] < -5
    empty = shared_fits.Fit(1.0, None, "l1")
    shared_fits.newton_fits(rows.where("false"), [empty], 1)
    assert empty.done and not empty.weights.any()
