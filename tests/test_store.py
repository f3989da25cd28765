"""Person-bucketed tables: same results, no shuffle for person-level work."""

import uuid

from fixture_paths import SF_SMALL
from ehrspark.operators import cohort, labels
from ehrspark.sources.fixtures import OmopData
from ehrspark.sources.store import load_tables, store_bucketed


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_tables_avoid_shuffles(spark, tmp_path):
    d = OmopData(spark, SF_SMALL)
    db = f"omop_{uuid.uuid4().hex[:8]}"
    names = ("person", "visit_occurrence", "death")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle-join path
    try:
        store_bucketed(spark, {n: d.table(n) for n in names}, db, str(tmp_path), buckets=4)
        t = load_tables(spark, db, names)
        dates = labels.prediction_dates(t["visit_occurrence"], t["death"])
        plan = _final_plan(dates)
        assert "Exchange hashpartitioning" not in plan, plan
        ref = labels.prediction_dates(d.visit_occurrence, d.death)
        assert dates.count() == ref.count() and dates.exceptAll(ref).count() == 0
        persons = cohort.select_persons(t["person"], t["visit_occurrence"], t["death"])
        assert "Exchange hashpartitioning" not in _final_plan(persons)
        assert persons.exceptAll(cohort.select_persons(d.person, d.visit_occurrence, d.death)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
