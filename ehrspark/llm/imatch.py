"""I-Match fingerprints with randomised lexicons (operator 4).

Native: DataFrame functions only. The lexicon holds the terms whose inverse
document frequency lies in a band. A signature hashes the sorted distinct
terms of a text that are in one random subset of the lexicon. The subsets come
in sizes 1/8, 1/32, 1/128 and 1/1024, so that texts of any length have
signatures of few terms, which survive edits elsewhere. The likeness of two
fingerprints is the share of equal signatures among those that either has.

The band's ends are shares of the documents, so the lexicon has at most
(mean distinct terms) / ``least`` terms, however many documents there are. It
is broadcast up to 20 million terms and 512 MB, and joined by a shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.joins import broadcast_if_small
from ..session import materialize
from .common import documents

SPACE = r"[\x20\x09-\x0D]+"
#: Subsets of 1 / 2**rate of the lexicon, (rate, number): a hash's 64 bits have groups enough.
SUBSETS = [(rate, k) for rate, n in ((3, 16), (5, 12), (7, 8), (10, 6)) for k in range(n)]
EMPTY = "0000"  # a signature without terms


def terms(text: Column) -> Column:
    """Distinct words, in lower case, without the punctuation of the prose around them."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != ""))


def lexicon(docs: DataFrame, least: float, most: float) -> DataFrame:
    """(term, h): terms found in a share of ``least`` to ``most`` of the rows (in at least 2), with their hash."""
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    low, high = F.greatest(F.lit(2), F.ceil(least * F.col("n"))), F.greatest(F.lit(3), F.col("n") * most)
    return counts.join(F.broadcast(n), F.col("df").between(low, high)).select("term", F.xxhash64("term").alias("h"))


def with_signatures(rows: DataFrame, hashes: str, text_hash: str, name: str) -> DataFrame:
    """``rows`` with the hex signatures of all subsets, one after another, in ``name``, from an array of lexicon hashes.

    A subset holds the terms in whose hash a certain group of bits has a
    certain value. Where no subset holds any term of the text, all signatures
    come from the terms as a whole or, without terms, from the whole text, so
    that only equal ones have equal fingerprints.
    """
    # Steps of their own, as Spark would repeat what one step mentions twice.
    subsets = F.array(*[F.struct(F.lit(r * k).alias("off"), F.lit((1 << r) - 1).cast("long").alias("mask"), F.lit((k * 37 + 11) % (1 << r)).alias("value")) for r, k in SUBSETS])
    rows = rows.withColumn("_sorted", F.sort_array(hashes))
    some = F.transform(subsets, lambda s: F.filter("_sorted", lambda h: F.call_function("shiftright", h, s["off"]).bitwiseAND(s["mask"]) == s["value"]))
    rows = rows.withColumn("_found", F.array_join(F.transform(some, lambda x: F.when(F.size(x) == 0, F.lit(EMPTY)).otherwise(hex4(F.xxhash64(x)))), ""))
    whole = F.when(F.size("_sorted") > 0, F.xxhash64("_sorted")).otherwise(F.col(text_hash))
    rest = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(len(SUBSETS))), lambda i: hex4(F.xxhash64(whole, i))), "")
    return rows.withColumn(name, F.when(F.col("_found") == EMPTY * len(SUBSETS), rest).otherwise(F.col("_found"))).drop("_sorted", "_found")


def hex4(h: Column) -> Column:
    """Four hex digits, never EMPTY."""
    return F.lower(F.lpad(F.hex(F.pmod(h, F.lit(65535)) + 1), 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Equal signatures as a share of those that either fingerprint has."""
    n = len(SUBSETS)
    at = F.sequence(F.lit(0), F.lit(n - 1))
    sig = lambda x, i: F.substr(x, 4 * i + 1, F.lit(4))
    some = F.size(F.filter(at, lambda i: (sig(a, i) != EMPTY) | (sig(b, i) != EMPTY)))
    same = F.size(F.filter(at, lambda i: (sig(a, i) != EMPTY) & (sig(a, i) == sig(b, i))))
    return F.when(some > 0, same / some).otherwise(F.lit(0.0))


def ordered_buckets(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with ``ord`` (the id; null is least), ``t`` (the text's hash) and ``bucket``: ranges of (ord, t) with
    about equal numbers of rows, numbered in their order.

    Buckets depend on quantiles of the ids, found in one pass; ``n`` bounds
    their number, not their rows. An id at which several quantiles lie (null
    ids, say) is split by the hash into as many buckets.
    """
    docs = docs.withColumn("ord", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))).withColumn("t", F.xxhash64("text"))
    found = docs.agg(F.percentile_approx("ord", [(i + 1) / n for i in range(n - 1)] or [1.0], 20 * n)).first()[0] or []
    ends = sorted(set(found))
    if not ends:
        return docs.withColumn("bucket", F.lit(0))
    steps = F.array(*[F.lit(1 << k) for k in range(len(ends).bit_length() - 1, -1, -1)])
    limits = F.lit(ends).cast("array<bigint>")
    # Binary search: the number of ends below ord.
    below = F.aggregate(steps, F.lit(0), lambda lo, s: F.when((lo + s <= len(ends)) & (F.try_element_at(limits, lo + s) < F.col("ord")), lo + s).otherwise(lo))
    docs = docs.withColumn("_range", below)
    # Of a range, ids before its end come first, then those of an end that is met several times, by their hash.
    times = F.lit([found.count(e) for e in ends] + [1])
    parts = F.try_element_at(times, F.col("_range") + 1)
    share = F.col("t").cast("double") / float(1 << 64) + 0.5
    at_end = F.col("ord") == F.coalesce(F.try_element_at(limits, F.col("_range") + 1), F.lit(None))
    sub = F.when(at_end & (parts > 1), 1 + F.least(F.floor(share * parts).cast("int"), parts - 1)).otherwise(0)
    return docs.withColumn("bucket", F.col("_range").cast("long") * (n + 1) + sub).drop("_range")


def next_buckets(buckets: DataFrame) -> DataFrame:
    """(bucket, next_bucket): for each bucket that has rows the one after it, after the last the first. A short row for each bucket."""
    order = Window.orderBy("bucket")
    wrapped = F.first("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return buckets.select("bucket", F.coalesce(F.lead("bucket").over(order), wrapped).alias("next_bucket"))


def fingerprints(docs: DataFrame, least: float = 0.0005, most: float = 0.02, most_buckets: int = 20_000) -> DataFrame:
    """doc_id, n_chars, fingerprint of each text; of its edited text edited_sha256 and edited_fingerprint; near_edited and near_next.

    The edited text's last half is the beginning of the next document's text,
    by ascending id, after the last the first. A null text is empty. Rows that
    share an id go in the order of their texts' hashes; a document alone follows
    itself. Documents are dealt to at most ``most_buckets`` ranges of the order.
    """
    spark = docs.sparkSession
    docs = documents(docs)
    words = lexicon(docs, least, most).unionByName(spark.sql("select '' as term, cast(null as bigint) as h"))
    words = broadcast_if_small(words, 20_000_000)
    n = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), most_buckets)
    placed = ordered_buckets(docs, n)

    # The first text of each bucket also stands, as a row that is no document, at the end of the bucket before.
    least_of = materialize(placed.groupBy("bucket").agg(F.min(F.struct("ord", "t")).alias("least")).select("bucket", "least.*"), "heads")  # a row for each bucket
    firsts = placed.join(F.broadcast(least_of), ["bucket", "ord", "t"]).groupBy("bucket").agg(F.min("text").alias("text"))
    order = F.broadcast(next_buckets(least_of.select("bucket")))
    ends = firsts.withColumnRenamed("bucket", "next_bucket").join(order, "next_bucket")
    columns = [F.col(c) for c in ("bucket", "doc_id", "ord", "t", "text")]
    rows = placed.select(F.lit(0).alias("end"), *columns).unionByName(ends.select(F.lit(1).alias("end"), "bucket", "text"), allowMissingColumns=True)
    in_order = Window.partitionBy("bucket").orderBy("end", "ord", "t", "text")
    half = F.expr("n_chars div 2")
    both = (rows.withColumn("next", F.lead("text").over(in_order)).where("end = 0")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substr("next", F.lit(1), half.cast("int"))))
            .select("bucket", F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "t", F.xxhash64("edited").alias("e"), F.unhex(F.sha2("edited", 256)).alias("sha"), "text", "edited"))

    # Terms of both texts meet the lexicon where they are: rows of a bucket stay in their partition.
    sides = both.select("bucket", "row", "doc_id", "n_chars", "t", "e", "sha", F.posexplode(F.array("text", "edited")).alias("side", "body"))
    # The empty term, in every text and in the lexicon without a hash, keeps texts that have no other.
    spread = sides.select("bucket", "row", "doc_id", "n_chars", "t", "e", "sha", "side", F.explode(F.concat(terms(F.col("body")), F.array(F.lit("")))).alias("term"))
    met = spread.join(F.broadcast(words), "term")
    sets = met.groupBy("bucket", "row").agg(*[F.first(c).alias(c) for c in ("doc_id", "n_chars", "t", "e", "sha")], F.collect_set(F.when(F.col("side") == 0, F.col("h"))).alias("own"), F.collect_set(F.when(F.col("side") == 1, F.col("h"))).alias("new"))
    made = with_signatures(with_signatures(sets, "own", "t", "fingerprint"), "new", "e", "edited_fingerprint")
    made = materialize(made.select("bucket", "row", "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint"), "fingerprints")
    # Rows number the documents of a bucket in their order.
    first = made.join(F.broadcast(made.groupBy("bucket").agg(F.min("row").alias("row"))), ["bucket", "row"]).select(F.col("bucket").alias("next_bucket"), F.col("fingerprint").alias("after"))
    heads = first.join(order, "next_bucket").select("bucket", "after")  # a fingerprint for each bucket
    lead = F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("row"))
    out = made.withColumn("next", lead).join(F.broadcast(heads), "bucket")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.coalesce("next", "after")).alias("near_next"))
