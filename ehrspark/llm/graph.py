"""Connected components of a table of links, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize, noting

FEW = 1 << 16  # rows of two numbers that are broadcast, a few MB: no shuffle, whose tasks the driver would all keep account of


def light(rows: DataFrame, n: int | None = None) -> DataFrame:
    """``rows``, a written table of numbers (``n``, counted if not known), to be broadcast if they are FEW at most."""
    return F.broadcast(rows) if (rows.count() if n is None else n) <= FEW else rows


def follow(table: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``column`` replaced by its root, if it has one in (node, root)."""
    found = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return table.join(found, F.col(column) == F.col("_node"), "left").withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node that isn't the least of its component; root is the least."""
    return counted_components(links)[0]


def counted_components(links: DataFrame) -> tuple[DataFrame, int]:
    """``components`` and how many rows these are.

    Every node with a smaller neighbour takes the least one as its parent;
    parents of parents are followed up to the roots; links between roots that
    are left go round again. Each round at least halves the nodes that still
    have links, and writes its small tables, which cuts the lineage.
    """
    def pairs(a: str, b: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node <> root").distinct()

    noted, told = noting(pairs("a", "b", links))
    left = materialize(noted, "links")
    total, n_total = None, 0
    while told()["n"]:
        noted, told = noting(left.groupBy("node").agg(F.min("root").alias("root")))
        tree = materialize(noted, "tree")
        n = told()["n"]  # as many in each round
        while True:
            up = light(tree, n).select(F.col("node").alias("up"), F.col("root").alias("top"))
            nearer = tree.join(up, F.col("root") == F.col("up"), "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
            noted, told = noting(nearer, moved=F.count_if("moved"))
            tree = materialize(noted, "tree").select("node", "root")
            if not told()["moved"]:
                break
        top = light(tree, n)
        total = tree if total is None else materialize(follow(total, "root", top).unionByName(tree), "roots")
        n_total += n
        noted, told = noting(pairs("node", "root", follow(follow(left, "node", top), "root", top)))
        left = materialize(noted, "links")
    return (total if total is not None else left), n_total
