"""Exact sets of integer ids as bitmaps by bucket.

Spark's bitmap functions put 32,768 neighbouring ids in a bucket of 4 KB, so
100 million dense ids take 3,052 rows and 12.5 MB, which are broadcast, and no
table is shuffled to find the cohort's rows. Of a bucket that holds few ids only the 64-bit
words that aren't zero are kept (12 bytes each), so scattered ids cost less
than twice their own size and a row for each. A set too large to broadcast is
joined by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import joins

WORDS, WORD_BITS = 512, 64      # of a bucket
SPARSE_WORDS = 128              # up to so many non-zero words a bucket keeps only these


def _word(bitmap: Column, i: Column) -> Column:
    """The i-th eight bytes of a bitmap as a bigint, first byte highest."""
    half = lambda at: F.conv(F.hex(F.substr(bitmap, 8 * i + F.lit(at), F.lit(4))), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(5))


def id_set(ids: DataFrame, column: str) -> DataFrame:
    """(bucket, n, at, words): the distinct non-null ids of ``column``, one row per bucket that holds any.

    ``words`` holds all 512 words of the bucket and ``at`` is null, or the
    non-zero ones and ``at`` their places. Buckets are aggregated map-side, so repeated ids don't travel.
    """
    found = (ids.select(F.col(column).cast("long").alias("_id")).where(F.col("_id").isNotNull())
             .groupBy(F.bitmap_bucket_number("_id").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bitmap")))
    found = found.select("bucket", F.bitmap_count("_bitmap").alias("n"),
                         F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: _word(F.col("_bitmap"), i)).alias("_all"))
    some = F.filter(F.transform("_all", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda s: s["word"] != 0)
    found = found.withColumn("_some", some)
    sparse = F.size("_some") <= SPARSE_WORDS
    return found.select("bucket", "n", F.when(sparse, F.col("_some.at")).alias("at"),
                        F.when(sparse, F.col("_some.word")).otherwise(F.col("_all")).alias("words"))


def _holds(position: Column, at: Column, words: Column) -> Column:
    """Whether the bit at ``position`` of a bucket is set."""
    place = F.floor(position / WORD_BITS).cast("int")
    index = F.when(at.isNull(), place).otherwise((F.array_position(at, place) - 1).cast("int"))
    bit = ((7 - F.floor((position % WORD_BITS) / 8)) * 8 + position % 8).cast("int")
    return (index >= 0) & (F.getbit(F.get(words, F.greatest(index, F.lit(0))), bit) == 1)


def members(df: DataFrame, column: str, ids: DataFrame, broadcast: bool) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the ``id_set`` ``ids``; a null is in no set."""
    side = ids.select(F.col("bucket").alias("_bucket"), F.col("at").alias("_at"), F.col("words").alias("_words"))
    side = F.broadcast(side) if broadcast else side
    bucket = F.bitmap_bucket_number(F.col(column).cast("long"))
    joined = df.join(side, bucket == F.col("_bucket"))
    return joined.where(_holds(F.bitmap_bit_position(F.col(column).cast("long")), F.col("_at"), F.col("_words"))).select(*df.columns)


def measured_set(ids: DataFrame, column: str) -> tuple[DataFrame, bool]:
    """An ``id_set`` written once, and whether its bytes fit a broadcast."""
    return joins.measured(id_set(ids, column), None, name="ids")
