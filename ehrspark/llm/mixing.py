"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 8).

Native: DataFrame functions only. Documents are sized in words. Targets by
source come from water-filling; blocks of ``block`` words are the seats, which
Sainte-Laguë gives to the sources, and within a source to its shards, by
highest quotients t / (2 s + 1). A shard is a hash share of a source's
documents, laid end to end in a seeded order and cut into blocks; its quota is
filled by whole passes over its blocks and a seeded choice of the rest.

Rules: a null text is empty (size 0, taken 0); a null source is a source of
its own, last; repeated rows are documents of their own; ties in seeded orders
fall to the id, then to equal sizes, where either order gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import WORD

WEIGHTS = (3, 1, 2)
CAP = 2  # times its size that a source, and a document, may be taken


def targets(sources: DataFrame, share: float) -> DataFrame:
    """(source, size, target) of (source, size): the shares of ``share`` times
    all words by repeating weights, no source above CAP times its size.

    The sources that stop at their cap are those with the least cap / weight:
    in that order, a source stops if an even filling of what the ones before it
    leave would reach its cap. One row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1)
    rows = sources.withColumn("weight", weight).withColumn("cap", CAP * F.col("size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.partitionBy()
    rows = rows.withColumn("left", F.lit(share) * F.sum("size").over(every) - (F.sum("cap").over(order) - F.col("cap")))
    rows = rows.withColumn("level", F.col("left") / (F.sum("weight").over(every) - F.sum("weight").over(order) + F.col("weight")))
    rows = rows.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    # The level of the first source that doesn't fill holds for all after it.
    level = F.min(F.when(~F.col("full"), F.struct("cap_by", "level"))).over(every)["level"]
    rows = rows.withColumn("cap_by", F.col("cap") / F.col("weight")).withColumn("even", level)
    return rows.select("source", "size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("even") * F.col("weight")).alias("target"))


def seats(rows: DataFrame, group: list[str], unit: list[str], claim: str, total: Column, most: str) -> DataFrame:
    """``rows`` with ``seats``: ``total`` (per group) shared by ``claim`` with
    Sainte-Laguë, no unit above ``most``.

    By the final divisor a unit's seats differ from its even part of the seats
    by p (n + 1) / 2 + 1/2 at most, for its share p of the claims of n units.
    So that many seats are sure, and only the next few quotients compete.
    """
    every = Window.partitionBy(*group)
    rows = rows.withColumn("_p", F.when(F.sum(claim).over(every) > 0, F.col(claim) / F.sum(claim).over(every)).otherwise(F.lit(0.0)))
    rows = rows.withColumn("_total", total).withColumn("_slack", F.ceil(F.col("_p") * (F.count(F.lit(1)).over(every) + 1) / 2).cast("long") + 1)
    rows = rows.withColumn("_sure", F.greatest(F.lit(0), F.floor(F.col("_p") * F.col("_total")).cast("long") - F.col("_slack")))
    rows = rows.withColumn("_open", F.col("_total") - F.sum("_sure").over(every))
    tries = rows.where(F.col(claim) > 0).select(*group, *unit, claim, "_open", F.explode(F.sequence(F.col("_sure"), F.col("_sure") + 2 * F.col("_slack") + 2)).alias("_s"))
    rank = Window.partitionBy(*group).orderBy(F.desc(F.col(claim) / (2 * F.col("_s") + 1)), *[F.asc_nulls_last(c) for c in unit], "_s")
    won = tries.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= F.col("_open"))
    won = won.groupBy(*group, *unit).agg(F.count(F.lit(1)).alias("_won"))
    keys = [*group, *unit]
    same = won.select(*[F.col(c).alias(f"_{c}") for c in keys], "_won")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    rows = rows.join(same, match, "left").withColumn("seats", F.least(F.col(most), F.col("_sure") + F.coalesce(F.col("_won"), F.lit(0))))
    return rows.drop("_p", "_total", "_slack", "_sure", "_open", "_won", *[f"_{c}" for c in keys])


def mix(docs: DataFrame, share: float = 1.5, seed: int = 7, block: int = 128, shard_words: int = 1 << 21) -> DataFrame:
    """Sizes and takings of all documents, and the places that are taken.

    One row for each document: doc_id, size, source_size, target and taken, and
    what is taken: passes (whole copies) and ranges (null, or the word ranges
    ``from``, ``n`` that are taken once more). It holds no texts.

    ``block`` is lowered for small sources, to a 64th of the smallest one, but
    not below a 16th of the mean size, so that the blocks number at most about
    17 for each document.
    """
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    sized = materialize(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    facts = by_source.agg(F.sum("size"), F.sum("n"), F.min(F.when(F.col("size") > 0, F.col("size")))).first()
    words, n, least = (v or 0 for v in facts)
    block = max(1, -(-words // (16 * n)) if n else 1, min(block, least // 64))
    shards = max(1, -(-words // shard_words))
    goals = targets(by_source.select("source", "size"), share)

    # Quotas: seats of a source, then of its shards.
    shard = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(shards)) if shards > 1 else F.lit(0).cast("long")
    placed = sized.withColumn("shard", shard)
    by_shard = placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).where(F.col("words") > 0).withColumn("blocks", F.ceil(F.col("words") / block).cast("long"))
    room = by_shard.groupBy("source").agg((CAP * F.sum("blocks")).alias("most")).withColumnRenamed("source", "_source")
    goals = goals.join(room, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").fillna(0, ["most"])
    # A source at its cap takes every block CAP times; the others share the rest.
    goals = goals.withColumn("capped", F.col("target") >= CAP * F.col("size")).withColumn("claim", F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("target")))
    goals = goals.withColumn("open", F.round(F.sum("claim").over(Window.partitionBy()) / block).cast("long"))
    goals = seats(goals, [], ["source"], "claim", F.col("open"), "most").withColumn("quota", F.when(F.col("capped"), F.col("most")).otherwise(F.col("seats")))
    quotas = goals.select(F.col("source").alias("_source"), "quota")
    shared = by_shard.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("claim", F.col("words").cast("double")).withColumn("most", CAP * F.col("blocks"))
    shared = seats(shared, ["source"], ["shard"], "claim", F.col("quota"), "most")
    shared = materialize(shared.select("source", "shard", "words", "blocks", F.expr("seats div blocks").alias("passes"), F.expr("seats % blocks").alias("more")), "quotas")

    # The seeded choice of blocks, by rank within the shard.
    lots = shared.where("more > 0").select("source", "shard", "more", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    draw = Window.partitionBy("source", "shard").orderBy(F.xxhash64("source", "shard", "block", F.lit(seed)), "block")
    chosen = lots.withColumn("_rank", F.row_number().over(draw)).where(F.col("_rank") <= F.col("more")).select("source", "shard", "block")

    # The stream of a shard, and the blocks that a document lies in.
    laid = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size", "row")
    stream = placed.where("size > 0").withColumn("end", F.sum("size").over(laid)).withColumn("start", F.col("end") - F.col("size"))
    lies = stream.select("row", "source", "shard", "size", "start", "end", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(end - 1) div {block}"))).alias("block"))
    left = lies.withColumn("_s", F.coalesce(F.hash("source"), F.lit(0)))
    right = chosen.select(F.col("source").alias("c_source"), F.coalesce(F.hash("source"), F.lit(0)).alias("c_s"), F.col("shard").alias("c_shard"), F.col("block").alias("c_block"))
    on = (F.col("_s") == F.col("c_s")) & (F.col("shard") == F.col("c_shard")) & (F.col("block") == F.col("c_block")) & F.col("source").eqNullSafe(F.col("c_source"))
    low, high = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("end"), (F.col("block") + 1) * block)
    hits = left.join(right, on).select("row", (low - F.col("start")).alias("from"), (high - low).alias("n"))
    hits = hits.groupBy("row").agg(F.sum("n").alias("extra"), F.array_sort(F.collect_list(F.struct("from", "n"))).alias("ranges"))

    passes = F.broadcast(shared.select(F.col("source").alias("p_source"), F.col("shard").alias("p_shard"), "passes")) if shards == 1 else shared.select(F.col("source").alias("p_source"), F.col("shard").alias("p_shard"), "passes")
    known = placed.join(passes, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("shard") == F.col("p_shard")), "left")
    known = known.join(goals.select(F.col("source").alias("g_source"), F.col("size").alias("source_size"), "target"), F.col("source").eqNullSafe(F.col("g_source")))
    known = known.join(hits, "row", "left")
    passes = F.coalesce(F.col("passes"), F.lit(0).cast("long"))
    taken = passes * F.col("size") + F.coalesce(F.col("extra"), F.lit(0).cast("long"))
    return materialize(known.select("doc_id", "size", "source_size", "target", taken.alias("taken"), passes.alias("passes"), "ranges"), "mix")


def mixed(docs: DataFrame, takings: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, as ``takings`` (of ``mix``) says.

    A whole copy keeps its text. Of ranges of words, those that touch become
    one row, whose text is these words with the white space after each. Rows
    that share an id meet their takings in the order of their sizes.
    """
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rank = Window.partitionBy("_key").orderBy("_size")
    left = docs.withColumn("_key", F.xxhash64(F.col("doc_id").cast("long"))).withColumn("_size", size).withColumn("_k", F.row_number().over(rank))
    # A range of the first one's first word on: it starts a row, or goes on with the last one's.
    joined = F.aggregate("ranges", F.expr("cast(array() as array<struct<`from`: bigint, n: bigint>>)"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["from"] + F.try_element_at(acc, F.lit(-1))["n"] == x["from"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["from"].alias("from"), (F.try_element_at(acc, F.lit(-1))["n"] + x["n"]).alias("n"))))).otherwise(F.concat(acc, F.array(x))))
    right = takings.select(F.xxhash64("doc_id").alias("_key"), F.col("size").alias("_size"), "passes", joined.alias("_ranges")).withColumn("_k", F.row_number().over(rank)).drop("_size")
    both = left.join(right, ["_key", "_k"])
    whole = F.struct(F.lit(0).cast("long").alias("from"), F.col("_size").alias("n"))
    part = F.explode(F.concat(F.array_repeat(whole, F.col("passes").cast("int")), F.coalesce(F.col("_ranges"), F.expr("cast(array() as array<struct<`from`: bigint, n: bigint>>)"))))
    some = both.withColumn("_part", part)
    words = F.regexp_extract_all("text", F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, F.col("_part")["from"].cast("int") + 1, F.col("_part")["n"].cast("int")), "")
    text = F.when(F.col("_part")["n"] == F.col("_size"), F.col("text")).otherwise(cut)
    return some.withColumn("text", text).select(*docs.columns)
