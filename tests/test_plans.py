"""Plan shape guards: the scans and joins the design relies on."""

import pytest

from fixture_paths import SF_SMALL
from ehrspark.plans.catalog import QUERIES
from ehrspark.operators import cohort, labels
from ehrspark.plans.inspect import plan_nodes, summarise
from ehrspark.sources.fixtures import OmopData

# query -> expected number of lineitem scans (the condition / drug / procedure rows)
FACT_SCANS = {
    "icd_mapper": 1,
    "code_map": 1,
    "mapped_condition_counts": 1,
    "hierarchy_condition_counts": 1,
    "converted_conditions": 1,
    "concept_long": 3,
    "concept_wide": 3,
}


@pytest.mark.parametrize("name", sorted(FACT_SCANS))
def test_fact_scans_and_join_kinds(spark, name):
    s = summarise(QUERIES[name](spark, SF_SMALL))
    spark.catalog.clearCache()
    assert s["scans"].get("lineitem") == FACT_SCANS[name], s
    assert s["nested_loop_joins"] == 0, s


def test_row_conversion_never_shuffles_fact_rows(spark):
    s = summarise(QUERIES["converted_conditions"](spark, SF_SMALL))
    spark.catalog.clearCache()
    assert s["sort_merge_joins"] == 0 and s["broadcast_joins"] >= 6, s


def test_cached_relations_are_counted(spark):
    """A cached side, the visits below it, and the conditions joined to it all show."""
    d = OmopData(spark, SF_SMALL)
    last = labels.last_visits(d.visit_occurrence).persist()
    s = summarise(last.join(d.condition_occurrence, "person_id"))
    last.unpersist()
    assert s["cached"] > 0 and s["scans"]["lineitem"] == 1 and s["scans"]["orders"] >= 2, s


def test_drug_rows_are_reduced_to_the_cohort_before_they_are_aggregated(spark):
    df = QUERIES["drugs_by_person"](spark, SF_SMALL)
    s = summarise(df)
    # The conditions were read once, for the written cohort; what is left are the drug rows.
    assert s["scans"]["lineitem"] == 1 and s["sort_merge_joins"] == 0, s
    kinds = [kind for kind, text in plan_nodes(df) if kind.endswith("JoinExec") or kind == "HashAggregateExec"]
    # From the top: the drug aggregates stand above the join with the broadcast cohort.
    assert kinds.index("BroadcastHashJoinExec") > kinds.index("HashAggregateExec")


def test_one_dictionary_broadcast_for_the_row_conversion(spark):
    s = summarise(QUERIES["converted_conditions"](spark, SF_SMALL))
    assert s["reused"] >= 4, s


def test_extraction_shuffles_no_table(spark):
    """The cohort is a broadcast set of bitmaps: the tables themselves are only read and filtered."""
    d = OmopData(spark, SF_SMALL)
    persons = cohort.select_persons(d.person, d.visit_occurrence, d.death)
    out = cohort.extract_tables({"visit_occurrence": d.visit_occurrence}, persons, cohort.cutoff_date(d.death, 24))
    s = summarise(out["visit_occurrence"])
    assert s["sort_merge_joins"] == 0 and s["broadcast_joins"] >= 1, s
    kinds = [kind for kind, _ in plan_nodes(out["visit_occurrence"])]
    # The only exchanges left are the broadcast and those of the cut-off date's scalar subquery.
    assert s["scans"].get("customer", 0) <= 1, kinds
