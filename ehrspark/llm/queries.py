"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import broadcast_if_small
from ..session import scratch_path
from . import blockmatrix, guesses, hmm, imatch, langid, licenses, mixing, neardup, packing, rans, squares, toxicity, turns
from .common import bucket_of, table

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
#: Labels are broadcast up to so many rows (about 30 MB), beyond that the join is a shuffle.
SMALL_LABELS = 2_000_000


def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id")) == 1)


def op2_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"rans-{uuid.uuid4().hex}")
    return rans.token_file(table(spark, sf_dir, "documents"), path, WORD_BPE).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockmatrix.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, keep_ids=True)
    return placed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, bucket_of(F.col("doc_id")) != 0)
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (bucket_of(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return langid.predict(asked, model).drop("text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the documents with a label; of repeated labels the greatest counts."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(broadcast_if_small(one, SMALL_LABELS), "doc_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels")), bucket_of(F.col("doc_id")) != 0)
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (bucket_of(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return toxicity.score(asked, model, spans=True).drop("text")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = squares.runs(table(spark, sf_dir, "documents"), 12, squares.repeating)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guesses.scan(table(spark, sf_dir, "documents"), WORD_BPE)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    costs = F.transform("spans", lambda s: s["cost"]).alias("costs")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"), of("guess"), costs)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = turns.repair(turns.damaged(table(spark, sf_dir, "conversations")))
    return fixed.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


QUERIES = {f.__name__: f for f in (op1_hmm_scores, op2_rans_tokens, op3_near_duplicates, op4_imatch, op5_nearest, op6_packing, op7_language, op8_mixing, op9_licenses, op10_toxicity,
                                   op11_periodic_runs, op12_guess_cost_secrets, op13_turn_repair)}

ORACLES = {
    "op3_near_duplicates": r"""
with recursive words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents),
sets as (
    select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as shingle
    from words),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
links as (
    select a.doc_id as a, b.doc_id as b
    from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    where 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
    group by a.doc_id, b.doc_id, x.n, y.n
    having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach as (select doc_id as a, doc_id as b from words union select r.a, l.b from reach r join links l on l.a = r.b)
select w.doc_id, coalesce(s.n, 0) as n_shingles, min(r.b) as component_id, w.doc_id = min(r.b) as kept
from words w left join sizes s on s.doc_id = w.doc_id join reach r on r.a = w.doc_id
group by w.doc_id, s.n""",
    "op5_nearest": """
with fit as (
    select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
    from fit q join fit c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scored qualify rank <= 20""",
}
