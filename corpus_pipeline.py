"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next one. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ehrspark.llm import langid, mixing, neardup, packing, queries, toxicity
from ehrspark.llm.common import bucket_of, table
from ehrspark.session import materialize


def kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], good: Column) -> DataFrame:
    """Rows of ``docs`` that ``judge``, which adds columns, finds good. Other columns than the text go by
    numbers meanwhile, so that none clashes with those of the judge."""
    names = {c: "text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    numbered = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return judge(numbered).where(good).select(*[F.col(n).alias(c) for c, n in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learnt from the documents' own lang. Texts without a language go: null, without a letter, or such that
    their n-grams are less likely in the most likely language than by chance. If no document to learn from has a lang,
    only null texts and those without a letter go."""
    model = langid.fit(docs, bucket_of(F.col("doc_id")) != 0)
    spoken = F.col("n_grams") > 0
    return kept(docs, lambda d: langid.predict(d, model, counted=True), spoken & (F.col("evidence") >= 0) if model.languages else spoken)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity, learnt from the labels of these documents. Those that score 0.5 or more go.

    Where the labels to learn from don't hold both 0 and 1 nothing can be judged and every document stays.
    """
    model = toxicity.fit(queries.labelled(docs, table(spark, sf_dir, "labels")), bucket_of(F.col("doc_id")) != 0)
    if not model.learnt:
        return docs
    return kept(docs, lambda d: toxicity.score(d, model), F.col("predicted") == 0)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-duplicates: of each component one row stays, that with the least id (null first), of several with that id
    the one whose text has the least digest. Each row is judged by its own text, whatever else has its id; of rows that
    share an id and a text one stays.
    """
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    numbered = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).withColumn(
        "said", F.coalesce(F.sha2(F.col(names["text"]).cast("string").cast("binary"), 256), F.lit("")))
    judged = neardup.near_duplicates(numbered.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"), "said"), carry=("said",))
    rows = materialize(judged.groupBy("doc_id", "said").agg(F.first("component").alias("component"), F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "judged")
    # Several rows of a component may have its least id.
    firsts = rows.where("kept and component is not null").groupBy("component").agg(F.min("said").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    rows = rows.join(firsts, "component", "left").withColumn("kept", F.col("kept") & (F.col("first").isNull() | (F.col("said") == F.col("first"))))
    decided = materialize(rows.where("not kept or n > 1").select("doc_id", F.col("said").alias("_said"), "kept"), "decided")
    same = F.col(names["doc_id"]).cast("long").eqNullSafe(F.col("doc_id")) & (F.col("said") == F.col("_said"))
    most = numbered.join(decided, same, "left_anti")
    repeated = numbered.join(decided.where("kept"), same, "left_semi").dropDuplicates([names["doc_id"], "said"])
    return most.unionByName(repeated).select(*[F.col(n).alias(c) for c, n in names.items()])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' mixture at its target weights: documents, copies and ranges of words as taken."""
    return mixing.mixed(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens: pieces with their ids, of which ``packing.sequences`` makes the sequences."""
    return packing.pack(docs, queries.BYTE_BPE, keep_ids=True)


STAGES = [("language_id", language), ("toxicity", harmless), ("near_duplicates", distinct), ("mixing", mixture), ("packing", packed)]

#: Models, hashes and tokenizers stand between the documents and the result: SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
