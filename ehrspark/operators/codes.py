"""ICD-9 → ICD-10 mapping and condition-code rankings.

The tiered lookup is one branch of the plan: the fact table is aggregated to
the keys that matter (distinct codes, or distinct (concept id, code) pairs),
each key row explodes into its five candidate keys, the candidates are
left-joined with the deduplicated dictionary, and the best hit is chosen by
``min(struct(tier, candidate, icd10))`` grouped by the same keys. Grouping by
the keys the input is already hash-partitioned on adds no shuffle, and the fact
table is read once. Tier beats candidate: a one-to-one hit on any candidate
wins over a many-to-one hit on the exact code.

Row-level rewriting (X6c) does not aggregate at all: with a dictionary of
checked size, the five candidate keys of every row are looked up with five
broadcast hash joins against the dictionary pivoted to one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.codes import candidate_keys, code_candidates, icd10_category
from ..functions.joins import broadcast_if_small, measured

CODE = "condition_source_value"

# Relationship type of a dictionary row → lookup tier.
# 1 one-to-one, 9 many-to-one, 10 one-to-many; type 4 (no relationship) is
# never used.
TIER_BY_TYPE = {1: 1, 9: 2, 10: 3}
TIERS = tuple(TIER_BY_TYPE.values())

# Upper bound (rows) for broadcasting a dictionary-sized table. Real code
# systems have tens of thousands of codes; above the bound the joins stay
# shuffle joins.
MAX_BROADCAST_CODES = 2_000_000

PAIR = ("condition_source_concept_id", CODE)


def _tier(type_col: Column) -> Column:
    expr = None
    for type_, tier in TIER_BY_TYPE.items():
        expr = F.when(type_col == type_, tier) if expr is None else expr.when(type_col == type_, tier)
    return expr


def dictionary(converter: DataFrame) -> DataFrame:
    """One entry per (icd9, tier): the row with the smallest ``conversion_id``.

    The pick happens before NULL targets are removed, so a first row with a
    NULL ``icd10`` makes the whole key a miss for that tier.
    Columns: key, tier, icd10.
    """
    return (converter
            .where(F.col("convertion_type").isin(list(TIER_BY_TYPE)) & F.col("icd9").isNotNull())
            .groupBy("icd9", "convertion_type")
            .agg(F.min(F.struct("conversion_id", "icd10")).alias("pick"))
            .where(F.col("pick.icd10").isNotNull())
            .select(F.col("icd9").alias("key"), _tier(F.col("convertion_type")).alias("tier"),
                    F.col("pick.icd10").alias("icd10")))


def dictionary_by_key(converter: DataFrame) -> DataFrame:
    """The dictionary pivoted to one row per key: key, t1, t2, t3 (icd10 per tier)."""
    return (dictionary(converter).groupBy("key")
            .agg(*[F.max(F.when(F.col("tier") == t, F.col("icd10"))).alias(f"t{t}") for t in TIERS]))


def icd9_codes(converter: DataFrame) -> DataFrame:
    """The ICD-9 dictionary: every distinct source code of the converter."""
    return converter.select(F.col("icd9").alias(CODE)).where(F.col(CODE).isNotNull()).distinct()


def _icd9_flags(converter: DataFrame, checked_broadcast: bool = False) -> DataFrame:
    """(code, is_icd9 = true) per dictionary code. Joined to fact rows it is
    broadcast after a size check; joined to code-level aggregates the planner
    (and AQE, from runtime sizes) picks the join."""
    flags = icd9_codes(converter).withColumn("is_icd9", F.lit(True))
    return broadcast_if_small(flags, MAX_BROADCAST_CODES) if checked_broadcast else flags


def _code_base(code: Column, strip_dot: bool) -> Column:
    return F.regexp_replace(code, "[.]", "") if strip_dot else code


def map_codes(codes: DataFrame, converter: DataFrame, strip_dot: bool = False,
              keys: tuple[str, ...] = (CODE,), already_distinct: bool = False) -> DataFrame:
    """(keys…, icd10, tier, candidate), one row per distinct ``keys`` with a non-NULL code.

    ``keys`` must contain the code column; extra keys ride along (e.g. a
    concept id, or a count that depends on the code). Unresolved codes keep
    NULL icd10 / tier / candidate. ``already_distinct`` skips the distinct
    for inputs that are one row per ``keys`` already.
    """
    keys = tuple(keys)
    base = codes.select(*keys).where(F.col(CODE).isNotNull())
    if not already_distinct:
        base = base.distinct()
    cands = base.select(*keys, F.inline(code_candidates(_code_base(F.col(CODE), strip_dot))))
    hits = cands.join(broadcast_if_small(dictionary(converter), MAX_BROADCAST_CODES), "key", "left")
    best = F.min(F.when(F.col("tier").isNotNull(), F.struct("tier", "candidate", "icd10")))
    return (hits.groupBy(*keys).agg(best.alias("best"))
            .select(*keys, F.col("best.icd10").alias("icd10"), F.col("best.tier").alias("tier"),
                    F.col("best.candidate").alias("candidate")))


def candidate_hits(codes: DataFrame, converter: DataFrame, strip_dot: bool = False) -> DataFrame:
    """Every dictionary hit of every candidate key of every distinct code.

    Columns: condition_source_value, tier, candidate, icd10 (a diagnostic
    listing, e.g. which codes hit on their code + '9' candidate in tier 1).
    """
    base = codes.select(CODE).where(F.col(CODE).isNotNull()).distinct()
    cands = base.select(CODE, F.inline(code_candidates(_code_base(F.col(CODE), strip_dot))))
    return cands.join(dictionary(converter), "key").select(CODE, "tier", "candidate", "icd10")


def build_mapper(conditions: DataFrame, converter: DataFrame, strip_dot: bool = False) -> DataFrame:
    """Distinct (condition_source_concept_id, condition_source_value, icd10).

    The fact table is reduced to distinct (concept id, code) pairs; the pairs
    are mapped in place (grouped by the pair, which is how they are already
    partitioned), so there is one scan and one shuffle of partial aggregates.
    """
    return map_codes(code_pairs(conditions), converter, strip_dot, PAIR, already_distinct=True).select(*PAIR, "icd10")


def code_pairs(conditions: DataFrame) -> DataFrame:
    """The distinct (condition_source_concept_id, condition_source_value) pairs with a code."""
    return conditions.select(*PAIR).where(F.col(CODE).isNotNull()).distinct()


def mapper_report(code_map: DataFrame) -> DataFrame:
    """Codes solved per (tier, candidate) and codes still open after each tier.

    Columns: tier, candidate, n_codes, unresolved_after_tier. The row with
    NULL tier holds the codes no tier resolved. The window runs over at most
    16 aggregated rows (3 tiers × 5 candidates + unresolved).
    """
    counts = code_map.groupBy("tier", "candidate").agg(F.count(F.lit(1)).alias("n_codes"))
    total = F.sum("n_codes").over(Window.partitionBy(F.lit(0)))
    through = F.sum(F.when(F.col("tier").isNotNull(), F.col("n_codes")).otherwise(0)).over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("tier").asc_nulls_last())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.select("tier", "candidate", "n_codes", (total - through).alias("unresolved_after_tier"))


def tier_candidate_hits(codes: DataFrame, converter: DataFrame, tier: int = 1, candidate: int = 4,
                        strip_dot: bool = False) -> DataFrame:
    """Codes whose given candidate hits in the given tier, whether or not it wins.

    The default lists the codes whose code + '9' key has a one-to-one entry.
    Columns: condition_source_value, icd10.
    """
    return (candidate_hits(codes, converter, strip_dot)
            .where((F.col("tier") == tier) & (F.col("candidate") == candidate))
            .select(CODE, "icd10"))


def unresolved_codes(code_map: DataFrame) -> DataFrame:
    return code_map.where(F.col("icd10").isNull()).select(CODE)


def condition_counts(conditions: DataFrame) -> DataFrame:
    """Raw code frequency, ``count(code)`` so the NULL group counts 0."""
    return ranked(code_counts(conditions))


def code_counts(conditions: DataFrame) -> DataFrame:
    """(code, count), one row per code and one of NULL, in no order."""
    return conditions.groupBy(CODE).agg(F.count(CODE).alias("count"))


def ranked(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(CODE))


def code_labels(codes: DataFrame, converter: DataFrame, strip_dot: bool = False,
                keys: tuple[str, ...] = (CODE,), already_distinct: bool = False) -> DataFrame:
    """Per distinct code: is_icd9, converted code and ICD-10 root category.

    ``converted`` is the X7 mapping for ICD-9 codes (NULL when unresolved)
    and the code itself otherwise; ``category`` is the text before the dot of
    the converted code. Extra ``keys`` ride along as in ``map_codes``.
    """
    mapped = map_codes(codes, converter, strip_dot, keys, already_distinct)
    converted = F.when(F.col("is_icd9").isNotNull(), F.col("icd10")).otherwise(F.col(CODE))
    flags = _icd9_flags(converter).withColumnRenamed(CODE, "_base")
    return (mapped.withColumn("_base", _code_base(F.col(CODE), strip_dot)).join(flags, "_base", "left")
            .select(*keys, F.col("is_icd9").isNotNull().alias("is_icd9"), converted.alias("converted"))
            .withColumn("category", icd10_category(F.col("converted"))))


def count_icd9_codes(counts: DataFrame, converter: DataFrame, strip_dot: bool = False) -> DataFrame:
    """How many distinct recorded codes are ICD-9 codes (one row)."""
    flags = _icd9_flags(converter).select(F.col(CODE).alias("_base"))
    return (counts.select(CODE).where(F.col(CODE).isNotNull()).distinct()
            .withColumn("_base", _code_base(F.col(CODE), strip_dot)).join(flags, "_base", "left_semi")
            .agg(F.count(F.lit(1)).alias("n_icd9_codes")))


def relabelled_counts(counts: DataFrame, converter: DataFrame, descriptions: DataFrame, label_of: Column,
                      strip_dot: bool = False) -> DataFrame:
    """Counts per code → label (converted or category) → description → summed.

    One branch: the ``code_counts`` carry their count through the lookup.
    A label without a description keeps its own text; NULL labels drop.
    """
    labels = code_labels(counts, converter, strip_dot, keys=(CODE, "count"), already_distinct=True)
    desc = descriptions.select(F.col("code").alias("label"), "description")
    return (labels.select(label_of.alias("label"), "count")
            .where(F.col("label").isNotNull())
            .join(desc, "label", "left")
            .groupBy(F.coalesce(F.col("description"), F.col("label")).alias(CODE))
            .agg(F.sum("count").alias("count"))
            .orderBy(F.desc("count"), F.asc(CODE)))


def mapped_condition_counts(conditions: DataFrame, converter: DataFrame, descriptions: DataFrame,
                            strip_dot: bool = False) -> DataFrame:
    """Counts per described ICD-10 code (ICD-9 codes converted first)."""
    return relabelled_counts(code_counts(conditions), converter, descriptions, F.col("converted"), strip_dot)


def hierarchy_condition_counts(conditions: DataFrame, converter: DataFrame, descriptions: DataFrame,
                               strip_dot: bool = False) -> DataFrame:
    """The same rolled up to the ICD-10 root category."""
    return relabelled_counts(code_counts(conditions), converter, descriptions, F.col("category"), strip_dot)


def convert_conditions(conditions: DataFrame, converter: DataFrame, strip_dot: bool = False) -> DataFrame:
    """Every condition row with ICD-9 codes rewritten to ICD-10.

    With a dictionary of checked size: five broadcast lookups per row (one
    per candidate key) and a tier-major COALESCE — one scan, no shuffle of
    the fact table. Otherwise the per-code labels are built first and joined
    back by code (AQE splits a hot code's partition).
    """
    cols = conditions.columns
    wide, small = measured(dictionary_by_key(converter), MAX_BROADCAST_CODES, name="dictionary")
    if small:
        rows = conditions
        keys = candidate_keys(_code_base(F.col(CODE), strip_dot))
        for i, key in enumerate(keys, start=1):
            look = F.broadcast(wide.select(F.col("key").alias(f"_k{i}"),
                                           *[F.col(f"t{t}").alias(f"_c{i}t{t}") for t in TIERS]))
            rows = rows.withColumn(f"_k{i}", key).join(look, f"_k{i}", "left")
        mapped = F.coalesce(*[F.col(f"_c{i}t{t}") for t in TIERS for i in range(1, len(keys) + 1)])
        flags = _icd9_flags(converter, checked_broadcast=True).withColumnRenamed(CODE, "_base")
        rows = rows.withColumn("_base", _code_base(F.col(CODE), strip_dot)).join(flags, "_base", "left")
        return (rows.withColumn(CODE, F.when(F.col("is_icd9").isNotNull(), mapped).otherwise(F.col(CODE)))
                .select(*cols))
    labels = code_labels(conditions, converter, strip_dot).select(CODE, "converted")
    return (conditions.join(broadcast_if_small(labels, MAX_BROADCAST_CODES), CODE, "left")
            .withColumn(CODE, F.col("converted"))
            .select(*cols))


def distinct_converted(converted: DataFrame) -> DataFrame:
    """Number of distinct (non-NULL) codes after conversion (one row)."""
    return converted.agg(F.countDistinct(CODE).alias("n_distinct_codes"))
