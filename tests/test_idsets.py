"""Sets of ids as bitmaps: exact for dense, scattered, negative and null ids, on both sides of the bound."""

import random

import pytest
from pyspark.sql import functions as F

from ehrspark.functions import idsets, joins
from ehrspark.operators import cohort


def _sets():
    rnd = random.Random(3)
    yield list(range(1, 70_000))
    yield [0, 1, 32768, 32769, 65536, 65537, -1, -32767, -32768, -32769, 2**63 - 1, -(2**62)]
    yield [rnd.randrange(-(10**15), 10**15) for _ in range(300)]
    yield rnd.sample(range(40_000), 9_000) + [5, 5, 5, None]
    yield [k * 64 for k in range(129)] + [40_000 + k * 64 for k in range(127)]
    yield []


@pytest.mark.parametrize("broadcast", [True, False])
def test_members_are_exactly_the_ids(spark, broadcast):
    rnd = random.Random(4)
    for ids in _sets():
        held = idsets.id_set(spark.createDataFrame([(i,) for i in ids], "p long"), "p").cache()
        known = {i for i in ids if i is not None}
        assert sum(r.n for r in held.collect()) == len(known)
        asked = [*known][:5000] + [rnd.randrange(-70_000, 70_000) for _ in range(3000)] + [i + 1 for i in [*known][:500] if i < 2**63 - 1] + [None, None]
        rows = spark.createDataFrame([(i, k) for k, i in enumerate(asked)], "p long, bucket int")
        got = sorted(r.bucket for r in idsets.members(rows, "p", held, broadcast).collect())
        assert got == [k for k, i in enumerate(asked) if i in known]
        held.unpersist()


def test_a_dense_cohort_takes_an_eighth_of_a_byte_for_each_id(spark):
    held, small = idsets.measured_set(spark.range(1, 4_000_001), "id")
    size = held.agg(F.sum(joins._row_bytes(held))).first()[0]
    assert small and held.count() == 123
    assert size / 4e6 * 1e8 < 16e6, "so 100 million ids fit a broadcast of 16 MB"


def test_extraction_beyond_the_bound_is_the_same(spark, monkeypatch):
    import datetime as dt
    persons = spark.createDataFrame([(p,) for p in range(0, 90_000, 3)], "person_id long")
    visits = spark.createDataFrame([(p % 100_000 if p % 11 else None, dt.date(2000 + p % 12, 1, 1), p) for p in range(5000)],
                                   "person_id long, visit_start_date date, n long").withColumn("person_id", F.col("person_id") * 17)
    cut = spark.createDataFrame([(dt.date(2006, 1, 1),)], "cutoff_date date")
    extract = lambda: sorted(r.n for r in cohort.extract_tables({"visit_occurrence": visits}, persons, cut)["visit_occurrence"].collect())
    small = extract()
    assert small == [p for p in range(5000) if p % 11 and p * 17 < 90_000 and p * 17 % 3 == 0 and p % 12 < 6]
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    assert extract() == small
