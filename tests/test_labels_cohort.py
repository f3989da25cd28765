"""Labels, cohort rules and cut-off dates (hand-made frames)."""

import datetime as dt

from ehrspark.operators import cohort, labels

D = dt.date


def _visits(spark, rows):
    return spark.createDataFrame(rows, "visit_occurrence_id long, person_id long, visit_start_date date")


def _deaths(spark, rows):
    return spark.createDataFrame([(p, d, dt.datetime(d.year, d.month, d.day)) for p, d in rows],
                                 "person_id long, death_date date, death_datetime timestamp")


def test_prediction_dates_rules(spark):
    death_day = D(2020, 6, 30)
    visits = _visits(spark, [
        (1, 1, death_day + dt.timedelta(days=10)),     # visit after death: positive
        (2, 2, death_day - dt.timedelta(days=180)),    # 180 days before: positive
        (3, 3, death_day - dt.timedelta(days=181)),    # 181 days before: negative
        (4, 5, death_day - dt.timedelta(days=100)),    # two qualifying visits
        (5, 5, death_day - dt.timedelta(days=20)),
        (6, 6, D(2019, 1, 1)), (7, 6, D(2019, 5, 1)),  # no death: last visit
    ])
    deaths = _deaths(spark, [(1, death_day), (2, death_day), (3, death_day), (4, death_day), (5, death_day)])
    got = {r["person_id"]: (r["prediction_date"], r["death"])
           for r in labels.prediction_dates(visits, deaths).collect()}
    assert got[1] == (death_day + dt.timedelta(days=10), 1.0)
    assert got[2][1] == 1.0
    assert got[3] == (death_day - dt.timedelta(days=181), 0.0)
    assert 4 not in got                                  # death without visit
    assert got[5] == (death_day - dt.timedelta(days=100), 1.0)
    late = labels.prediction_dates(visits, deaths, order="latest").where("person_id = 5").first()
    assert late["prediction_date"] == death_day - dt.timedelta(days=20)
    assert got[6] == (D(2019, 5, 1), 0.0)


def test_cutoff_month_end(spark):
    deaths = _deaths(spark, [(1, D(2020, 8, 31)), (2, D(2019, 1, 1))])
    assert cohort.cutoff_date(deaths, 6).first()[0] == D(2020, 2, 29)


def test_select_persons_rules(spark):
    person = spark.createDataFrame([
        (1, 8532, 1990, 5, 10, 8527),   # first visit before birth
        (2, 8507, 1950, 1, 1, 8527),    # visit after death
        (3, 8507, 1950, 1, 1, 8527),    # only 2 visits
        (4, 8532, 1950, 1, 1, 8516),    # passes
        (5, 8532, 1950, 1, 1, 8516),    # no visits
    ], "person_id long, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int, "
       "race_concept_id int")
    visits = _visits(spark, [
        (1, 1, D(1990, 5, 9)), (2, 1, D(2000, 1, 1)), (3, 1, D(2001, 1, 1)),
        (4, 2, D(2000, 1, 1)), (5, 2, D(2001, 1, 1)), (6, 2, D(2010, 1, 1)),
        (7, 3, D(2000, 1, 1)), (8, 3, D(2001, 1, 1)),
        (10, 4, D(2000, 1, 1)), (11, 4, D(2001, 1, 1)), (12, 4, D(2002, 1, 1)),
    ])
    deaths = _deaths(spark, [(2, D(2005, 1, 1)), (4, D(2002, 1, 1))])
    got = [r["person_id"] for r in cohort.select_persons(person, visits, deaths).collect()]
    assert got == [4]


def test_extract_tables_filters_members_and_dates(spark):
    visits = _visits(spark, [(1, 1, D(2000, 1, 1)), (2, 1, D(2001, 1, 1)), (3, 2, D(2000, 1, 1))])
    persons = spark.createDataFrame([(1,)], "person_id long")
    cut = spark.createDataFrame([(D(2000, 6, 1),)], "cutoff_date date")
    out = cohort.extract_tables({"visit_occurrence": visits}, persons, cut)
    assert [r["visit_occurrence_id"] for r in out["visit_occurrence"].collect()] == [1]


def test_extract_without_broadcast_matches(spark, monkeypatch):
    from ehrspark.functions import joins
    from ehrspark.plans import catalog
    from ehrspark.sources.fixtures import OmopData
    d = OmopData(spark, "/root/testdata/sf0.001")
    fast = catalog._extracted(d, list(cohort.DATE_COLUMNS))
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    slow = catalog._extracted(d, list(cohort.DATE_COLUMNS))
    for name in fast:
        assert fast[name].count() == slow[name].count()
        assert fast[name].exceptAll(slow[name]).count() == 0


def test_date_helpers(spark):
    from pyspark.sql import functions as F
    from ehrspark.functions.dates import age_years, parse_date, year_start
    df = spark.createDataFrame([("2000-07-02", 1950)], "d string, y int")
    r = df.select(parse_date(F.col("d")).alias("d"), year_start(F.col("y")).alias("ys"),
                  age_years(parse_date(F.col("d")), F.col("y")).alias("age")).first()
    assert r["d"] == D(2000, 7, 2) and r["ys"] == D(1950, 1, 1)
    assert r["age"] == (D(2000, 7, 2) - D(1950, 1, 1)).days / 365.25


def test_write_extract_round_trip(spark, tmp_path):
    from ehrspark.sources import files, sinks
    visits = _visits(spark, [(1, 1, D(2000, 1, 1)), (2, 2, D(2001, 1, 1))])
    sinks.write_extract({"visit_occurrence": visits}, str(tmp_path))
    back = files.read_table(spark, str(tmp_path / "visit_occurrence"), "visit_occurrence")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, visits.collect()))


def test_prediction_dates_min_days_option(spark):
    death_day = D(2020, 6, 30)
    visits = _visits(spark, [(1, 1, death_day + dt.timedelta(days=10)), (2, 2, death_day - dt.timedelta(days=30))])
    deaths = _deaths(spark, [(1, death_day), (2, death_day)])
    got = {r["person_id"]: r["death"] for r in labels.prediction_dates(visits, deaths, min_days=0).collect()}
    assert got == {1: 0.0, 2: 1.0}     # a visit after death no longer counts
