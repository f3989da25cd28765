"""Summarise the executed (final adaptive) plan of catalogue queries.

    python -m ehrspark.plans.inspect [--sf DIR] [name ...]

For each query: parquet scans per table, shuffle exchanges, reused stages and
join strategies, taken from the final plan after the query has run, with the plans
of cached relations (each once) and of subqueries; size-check jobs, which run
before, are not included. Prints a markdown table.
"""

from __future__ import annotations

import argparse
import collections
import re

from .catalog import QUERIES

MODEL_QUERIES = {"score_demographic", "demographic_grid", "score_five", "score_concepts",
                 "prediction_violations", "prevalence_spearman", "prevalence_spearman_test"}


def plan_nodes(df) -> list[tuple[str, str]]:
    """(operator class, one-line text) of every node of the plan that ``df`` ran with.

    Walks the tree: the final plan of an adaptive plan, the plan inside a query
    stage, the plan behind a cached relation (once), and subqueries. A reused
    exchange is a leaf, so nothing is counted twice.
    """
    jvm = df.sparkSession.sparkContext._jvm
    todo, seen, out = [df._jdf.queryExecution().executedPlan()], set(), []

    def all_of(seq):
        return [seq.apply(i) for i in range(seq.size())]

    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        out.append((kind, node.simpleString(10_000)))
        if kind == "InMemoryTableScanExec":
            relation = node.relation()
            which = jvm.java.lang.System.identityHashCode(relation.cacheBuilder())
            if which not in seen:
                seen.add(which)
                todo.append(relation.cachedPlan())
        if not kind.startswith("Reused"):
            todo.extend(all_of(node.children()) + all_of(node.subqueries()))
    return out


def summarise(df) -> dict:
    df.collect()
    nodes = plan_nodes(df)
    kinds = collections.Counter(kind for kind, _ in nodes)
    scans = collections.Counter(name for kind, text in nodes if kind == "FileSourceScanExec"
                                for name in re.findall(r"\[file:[^\]]*/(\w+)\.parquet", text))
    return {
        "scans": dict(sorted(scans.items())),
        "shuffles": kinds["ShuffleExchangeExec"],
        "reused": kinds["ReusedExchangeExec"],
        "broadcast_joins": kinds["BroadcastHashJoinExec"],
        "sort_merge_joins": kinds["SortMergeJoinExec"],
        "nested_loop_joins": kinds["BroadcastNestedLoopJoinExec"] + kinds["CartesianProductExec"],
        "cached": kinds["InMemoryTableScanExec"],
    }


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session()
    names = a.names or [n for n in QUERIES if n not in MODEL_QUERIES]
    print("| query | parquet scans | shuffles | reused | broadcast joins | sort-merge joins | nested-loop | cached reads |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for n in names:
        s = summarise(QUERIES[n](spark, a.sf))
        scans = ", ".join(f"{t}×{c}" for t, c in s["scans"].items())
        print(f"| {n} | {scans} | {s['shuffles']} | {s['reused']} | {s['broadcast_joins']} | "
              f"{s['sort_merge_joins']} | {s['nested_loop_joins']} | {s['cached']} |", flush=True)
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
