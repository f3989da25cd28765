"""A person holding most of the rows: results stay whole and exact."""

import datetime as dt
import random

import pandas as pd

from ehrspark.operators import drugs, labels

D = dt.date


def _hot_visits(spark):
    rnd = random.Random(7)
    rows, vid = [], 0
    for _ in range(3000):                      # person 1: 3000 visits on ~1000 days
        vid += 1
        rows.append((vid, 1, D(2000, 1, 1) + dt.timedelta(days=rnd.randrange(1000))))
    for p in range(2, 202):                    # 200 others: 10 visits each
        for _ in range(10):
            vid += 1
            rows.append((vid, p, D(2000, 1, 1) + dt.timedelta(days=rnd.randrange(1000))))
    return rows


def test_prediction_dates_with_a_hot_person(spark):
    visits = _hot_visits(spark)
    deaths = [(1, D(2002, 6, 1)), (5, D(2001, 3, 1)), (9, D(2010, 1, 1))]
    v = spark.createDataFrame(visits, "visit_occurrence_id long, person_id long, visit_start_date date")
    d = spark.createDataFrame([(p, x, dt.datetime(x.year, x.month, x.day)) for p, x in deaths],
                              "person_id long, death_date date, death_datetime timestamp")
    got = {r[0]: (r[1], r[2]) for r in labels.prediction_dates(v, d).collect()}
    pv = pd.DataFrame(visits, columns=["vid", "person_id", "day"])
    death = dict(deaths)
    want = {}
    for pid, g in pv.groupby("person_id"):
        q = [x for x in g["day"] if pid in death and (death[pid] - x).days <= 180]
        want[pid] = (min(q), 1.0) if q else (max(g["day"]), 0.0)
    assert got == want


def test_person_linked_drug_counts_with_a_hot_person(spark):
    cond = [(1, i, "E10.1") for i in range(1000)] + [(p, 10_000 + p, "E10.2") for p in range(2, 50)]
    drug = [(1, i, i % 7) for i in range(1000)] + [(p, 20_000 + p, p % 5) for p in range(2, 40)]
    c = spark.createDataFrame(cond, "person_id long, visit_occurrence_id long, condition_source_value string")
    g = spark.createDataFrame(drug, "person_id long, visit_occurrence_id long, drug_concept_id long")
    got = {r[0]: r[1] for r in drugs.cohort_drug_counts(c, g, "E10", (), link="person", k=1000).collect()}
    # Brute force: the plain condition × drug join per person (1,000,000 rows for person 1).
    pc, pg = pd.DataFrame(cond, columns=["p", "v", "code"]), pd.DataFrame(drug, columns=["p", "v", "drug"])
    joined = pc.merge(pg, on="p", how="left")
    want = joined.groupby("drug", dropna=False).size().to_dict()
    want = {(None if pd.isna(k) else int(k)): int(v) for k, v in want.items()}
    assert got == want and sum(got.values()) == len(joined)


def test_both_sides_of_the_broadcast_bounds_agree(spark, monkeypatch):
    """Deaths and cohort keys above their bounds go by shuffle, with the same rows; null keys included."""
    visits = _hot_visits(spark) + [(9001, None, D(2001, 1, 1))]
    deaths = [(1, D(2002, 6, 1)), (1, D(2002, 7, 1)), (5, D(2001, 3, 1)), (None, D(2001, 1, 1)), (999, D(2001, 1, 1))]
    v = spark.createDataFrame(visits, "visit_occurrence_id long, person_id long, visit_start_date date")
    d = spark.createDataFrame(deaths, "person_id long, death_date date")
    cond = [(1, i, "E10.1") for i in range(50)] + [(p, 10_000 + p, "E10.2") for p in range(2, 20)] + [(None, None, "E10.3"), (None, 7, "E10.3"), (3, None, "E10.4")]
    drug = [(1, i, i % 7) for i in range(40)] + [(p, 10_000 + p, p % 5) for p in range(2, 15)] + [(None, None, 3), (2, 7, None), (None, 10_005, 4)]
    c = spark.createDataFrame(cond, "person_id long, visit_occurrence_id long, condition_source_value string")
    g = spark.createDataFrame(drug, "person_id long, visit_occurrence_id long, drug_concept_id long")

    def results():
        out = [labels.prediction_dates(v, d, order=order, min_days=m) for order in ("earliest", "latest") for m in (None, 30)]
        for link in ("visit", "person"):
            out += [drugs.cohort_drug_counts(c, g, "E10", (), link=link, count=count, k=1000) for count in ("rows", "patients")]
            out.append(drugs.cohort_drug_counts_by_group(c, g, "E10", (), lambda p: p % 2 == 0, link=link, k=1000))
        return [sorted(map(str, df.collect())) for df in out]

    small = results()
    monkeypatch.setattr(labels, "MAX_BROADCAST_DEATHS", 0)
    monkeypatch.setattr(drugs, "MAX_BROADCAST_COHORT", 0)
    assert results() == small and all(small)
