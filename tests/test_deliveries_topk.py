"""Merged delivery states and certified top-k lists against one run over everything."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from ehrspark.operators import deliveries, features, topk
from ehrspark.sources.fixtures import OmopData
from ehrspark.streaming import chunked

ROWS = "person_id long, condition_source_value string, condition_concept_id int"


def _rows(n, seed):
    rnd = random.Random(seed)
    out = [(rnd.choice([None, 1, 7, 32768, 32769, -5, 10**12, rnd.randrange(100_000)]), rnd.choice([None, "A", "B", "C.1"]), rnd.choice([None, 1, 2, 3])) for _ in range(n)]
    return out + [(1, "A", 1)] * n          # one patient and code hold half of the rows


def _one_run(rows):
    n = Counter(c for _, c, _ in rows if c is not None)
    return {c: (n[c], len({p for p, x, _ in rows if x == c and p is not None})) for c in {r[1] for r in rows}}


def test_deliveries_merge_to_one_run_in_any_order_and_grouping(spark, tmp_path):
    parts = [_rows(120, s) for s in range(4)] + [[]]
    folder, rolled = str(tmp_path / "states"), str(tmp_path / "rolled")
    for k, part in enumerate(parts):
        deliveries.deliver(spark.createDataFrame(part, ROWS), folder, f"d{k}")
    got = lambda m: {r[0]: (r["count"], r["n_patients"]) for r in deliveries.counts(m).collect()}
    everything = [r for p in parts for r in p]
    assert got(deliveries.merge(deliveries.states(spark, folder))) == _one_run(everything)
    # Roll two of them up, then merge with the others.
    deliveries.roll_up(spark, folder, ["d0", "d3"], "d0-d3", rolled)
    both = deliveries.states(spark, rolled).unionByName(deliveries.states(spark, folder, ["d1", "d2", "d4"]))
    assert got(deliveries.merge(both)) == _one_run(everything)
    # The same delivery again replaces itself; a changed one replaces the old.
    deliveries.deliver(spark.createDataFrame(parts[1], ROWS), folder, "d1")
    deliveries.deliver(spark.createDataFrame(parts[0][:50], ROWS), folder, "d0")
    assert got(deliveries.merge(deliveries.states(spark, folder))) == _one_run(parts[0][:50] + [r for p in parts[1:] for r in p])
    with pytest.raises(FileNotFoundError, match="d9"):
        deliveries.states(spark, folder, ["d9"])
    sets = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 99)], "set_name string, concept_id long")
    left = parts[0][:50] + [r for p in parts[1:] for r in p]
    want = {s: len({p for p, _, c in left if c in ids and p is not None}) for s, ids in (("x", {1, 2}), ("y", {3}))}
    assert {r[0]: r[1] for r in deliveries.set_patients(deliveries.merge(deliveries.states(spark, folder)), sets).collect()} == want


def test_micro_batches_become_states(spark, tmp_path):
    cond = OmopData(spark, SF_SMALL).condition_occurrence
    source, folder = str(tmp_path / "conditions"), str(tmp_path / "states")
    cond.repartition(3).write.parquet(source)
    run = lambda: chunked.run_to_states(spark, chunked.condition_rows_stream(spark, source), folder, str(tmp_path / "ckpt"))
    run()
    further = spark.createDataFrame([tuple(r) for r in cond.where("condition_source_value is not null").limit(100).collect()], cond.schema)
    further.coalesce(1).write.mode("append").parquet(source)        # only the new file is read
    run()
    got = deliveries.counts(deliveries.merge(deliveries.states(spark, folder))).collect()
    want = cond.groupBy("condition_source_value").agg(F.countDistinct("person_id").alias("n")).collect()
    assert {r[0]: r["n_patients"] for r in got} == {r[0]: r["n"] for r in want}
    assert sum(r["count"] for r in got) == cond.where("condition_source_value is not null").count() + 100


def _exact(keys, k):
    n = Counter(x for x in keys if x is not None)
    return sorted(n.items(), key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("k", [1, 5, 20])
def test_certified_lists_equal_the_sort(spark, k):
    rnd = random.Random(k)
    skewed = [min(int(rnd.paretovariate(0.7)), 10**6) for _ in range(20_000)] + [None] * 500
    ties = [x for x in range(30) for _ in range(40)] + [1000 + x for x in range(3000)]     # many keys tie at the k-th place
    even = list(range(6000))
    for keys, tracked in ((skewed, 512), (skewed, None), (ties, 256), (ties, None), (even, 64), ([], None), ([None], None), ([3, 3, 1], None)):
        rows = spark.createDataFrame([(x,) for x in keys], "c long").repartition(5)
        got, proof = topk.certified_top(rows, "c", k, tracked)
        assert [tuple(r) for r in got.collect()] == _exact(keys, k), (k, tracked, proof)
        if keys is skewed and tracked is None:
            assert proof.size and proof.candidates < len(set(skewed))


def test_sketch_bounds_hold(spark):
    rnd = random.Random(1)
    keys = [min(int(rnd.paretovariate(0.4)), 10**7) for _ in range(60_000)]
    n, found = topk._sketch(spark.createDataFrame([(x,) for x in keys], "c long").repartition(7), "c", 96)
    true, error = Counter(keys), topk.ERROR_FACTOR * len(keys) / topk.map_size(96) + 1
    assert n == len(keys) and len(found) <= 96
    for r in found:
        assert true[r["item"]] <= r["count"] <= true[r["item"]] + error
    assert max(c for x, c in true.items() if x not in {r["item"] for r in found}) <= 2 * error


def test_certified_vocabulary_is_the_vocabulary(spark):
    d = OmopData(spark, SF_SMALL)
    ev = features.event_concepts(d.condition_occurrence, d.drug_exposure, d.procedure_occurrence)
    got = [tuple(r) for r in topk.certified_top(ev, "concept_id", 50)[0].collect()]
    assert got == [(r["concept_id"], r["count"]) for r in features.top_concepts(ev, 50).orderBy("pos").collect()]
