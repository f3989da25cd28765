"""Nearest neighbours against brute force, the SQL of the queries, and the pipeline's stages."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ehrspark.llm import blockmatrix, queries
from ehrspark.llm.graph import components

SF_SMALL = "/root/testdata/sf0.001"


def dot(v, w):
    out = 0.0  # sum() of floats isn't a plain sum in new versions of Python
    for a, b in zip(v, w):
        out += a * b
    return out


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    out = []
    for q, v in ok.items():
        if q % 20 == 0:
            score = sorted((-dot(v, w), c) for c, w in ok.items() if c != q and len(w) == len(v))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(score[:k])]
    return sorted(out)


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(int(i), rows[5][1]) for i in range(300, 420)]  # copies tie
    rows += [rows[7], (7, [9.0] * 8), (None, [1.0] * 8), (500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [1.0] * 6), (504, [float("nan")] * 8), (505, [float("inf")] * 8), (520, [1.0, 2.0]), (521, [2.0, 1.0]), (540, [1e-40] * 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, query_id string")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = blockmatrix.nearest(df, F.col("vec_id") % 20 == 0, k=7, query_rows=8, candidate_rows=64, held_blocks=2).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 7)
    assert blockmatrix.nearest(df.limit(0), F.lit(True)).count() == 0


def test_blocks_sent_grow_with_the_power_of_one_and_a_half(spark):
    def sent(n_query, n_candidate):
        block = lambda n: spark.range(n).select(F.col("id").alias("block"), F.lit(4).alias("dim"))
        got = blockmatrix.cells(block(n_query), block(n_candidate), round(n_query ** 0.5), round(n_candidate ** 0.5))
        pairs = got.where("kind = 0").alias("q").join(got.where("kind = 1").alias("c"), ["dim", "grp", "stripe"])
        assert pairs.select("q.block", "c.block").distinct().count() == pairs.count() == n_query * n_candidate
        return got.count()

    assert sent(36, 36) <= 8 * sent(9, 9)


def test_rounding_bound_holds():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 16)) * rng.choice([1e-3, 1, 50], (60, 1))
    scale = np.abs(v).max(1) / 127
    small = np.rint(v / scale[:, None])
    side = (np.arange(60), small.astype(np.float32), scale, np.linalg.norm(v - small * scale[:, None], axis=1), v)
    a, b = blockmatrix.survivors(side, side, 5, np.full(60, -np.inf))
    found = set(zip(a.tolist(), b.tolist()))
    exact = v @ v.T
    np.fill_diagonal(exact, -np.inf)
    assert all((q, int(c)) in found for q in range(60) for c in np.argsort(-exact[q])[:5])


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200)] + [(300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 140)}, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as from '{SF_SMALL}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF_SMALL).select(*want.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline
    from ehrspark.llm.common import table

    docs = table(spark, SF_SMALL, "documents").withColumn("score", F.lit("own")).withColumn("lang_pred", F.lit(1))
    docs = docs.unionByName(docs.limit(1)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(-5).cast("long")).withColumn("text", F.lit("12 !")))
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        sizes.append((docs.count(), out.count()))
        docs = out
    assert sizes[0][0] - sizes[0][1] == 1 and sizes[2][1] < sizes[2][0]
    last = corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL)
    assert last.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_pipeline_keeps_what_it_cannot_judge(spark, tmp_path):
    """No lang to learn from; no label, none that matches, or labels of one kind."""
    import corpus_pipeline
    from ehrspark.llm.common import table

    docs = table(spark, SF_SMALL, "documents").limit(60)
    bad = docs.limit(2).withColumn("doc_id", F.col("doc_id") + 10_000_000).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit("12 !")))
    docs = corpus_pipeline.materialize(docs.unionByName(bad), "test-no-judge")
    letters = docs.where(F.col("text").rlike(r"\p{L}")).count()
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert 0 < letters == docs.count() - 2 == corpus_pipeline.language(spark, none, SF_SMALL).count()
    ids = docs.select("doc_id")
    one = lambda d, toxic: d.select("doc_id", F.lit(1).alias("quality"), F.lit(toxic).cast("int").alias("toxic"))
    for k, labels in enumerate((one(ids.limit(0), 0), one(ids.withColumn("doc_id", -F.col("doc_id") - 1), 1), one(ids, 1), one(ids, 0), one(ids, None))):
        labels.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        out = corpus_pipeline.harmless(spark, docs, f"{tmp_path}/{k}")
        assert out.columns == docs.columns and out.count() == docs.count()


def test_rows_of_one_id_are_judged_each_by_its_own_text(spark, frame):
    import corpus_pipeline

    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    near, b = a + " more", "quite another text that is like nothing else in this small collection of rows at all"
    rows = [(1, a, None, "s"), (3, a, None, "s"), (3, b, None, "s"), (3, b, None, "t"), (4, near, None, "s"), (None, b + " x y", None, "s"), (None, None, None, None), (5, None, None, "s"), (5, "", None, "s"), (None, None, None, None), (6, " ", "x", "s")]
    out = corpus_pipeline.distinct(spark, frame(rows), "")
    got = sorted((str(r.doc_id), str(r.text)) for r in out.collect())
    # B's rows lose to the null id's near copy of B; of the rows with one id and no text one stays.
    assert got == sorted([("1", a), ("None", b + " x y"), ("None", "None"), ("5", "None"), ("5", ""), ("6", " ")])
    assert out.columns == frame([]).columns
    alone = corpus_pipeline.distinct(spark, frame(rows[:3]), "").collect()
    assert sorted((r.doc_id, r.text) for r in alone) == [(1, a), (3, b)]
    twins = corpus_pipeline.distinct(spark, frame([(7, a, None, "s"), (7, near, None, "s"), (8, near, None, "s")]), "").collect()
    assert len(twins) == 1 and twins[0].doc_id == 7


def test_pipeline_on_empty_tables_nulls_and_an_unknown_language(spark, frame, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], [(None, None, None, None), (None, None, None, None), (1, "Plain words in a row. And a second sentence.", "en", None), (None, "Other words here, also in a row.", "en", "b")]):
        docs = frame(rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.where("doc_id is not null").count() >= (1 if rows else 0) and (rows or docs.count() == 0)
    english = [(i, f"The cat number {i} sat on the mat and looked at the other cats in the house.", "en", "a") for i in range(50)]
    mixed = english + [(100, "知らない言語で書かれた文章です、全部この通り。", None, "a"), (101, "12 34 !!", "en", "a")]
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, frame(mixed), "").collect()) == [i for i, *_ in english]


def test_pipeline_result_holds_the_sequences(spark):
    import corpus_pipeline
    from ehrspark.llm import packing
    from ehrspark.llm.common import table

    docs = table(spark, SF_SMALL, "documents").limit(20)
    last = corpus_pipeline.materialize(corpus_pipeline.packed(spark, docs.unionByName(docs), SF_SMALL), "test-packed")
    sizes = {r.sequence_id: r.n for r in last.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(last).collect()} == sizes
    assert last.where(F.crc32("ids") != F.col("ids_crc32")).count() == 0


def test_registered():
    import __spark_entry__ as e
    names = set(e.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names and len([n for n in names if n.startswith("op")]) == 13
