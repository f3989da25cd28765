"""Exact nearest neighbours by a block matrix join (operator 5).

Vectors are cut into blocks of rows and rounded to int8. A tile is one block
of queries against one block of candidates: the product of the int8 matrices,
with a bound on what the rounding can hide, says which pairs may be among the
k nearest; only those are recomputed from the original vectors, in double
precision. Tiles are made where a cell's blocks meet (``cells``). A task keeps
a heap for each query over its tiles; the heaps of all tasks are merged at the end.

Every row takes part, so recall is 1. Copies of one vector tie, and only the
first k + 1 by id of them can be among the k nearest: a block keeps no more.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

BLOCK = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("small", pa.binary()), ("scale", pa.binary()), ("lost", pa.binary()), ("vectors", pa.binary())])
BLOCK_SQL = "block long, dim int, ids binary, small binary, scale binary, lost binary, vectors binary"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): one row for each id, ids and vectors that take part only.

    Null ids, and vectors that are null, empty, zero or hold a null or
    non-finite component, take no part. Repeated rows count once; of different
    vectors with one id the smallest counts.
    """
    v = F.col(vec_col).cast("array<double>")
    fit = F.size(v) > 0
    fit &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fit).groupBy("vec_id").agg(F.min("v").alias("v"))


def blocks(vectors: DataFrame, n_blocks: int, keep: int | None) -> DataFrame:
    """Block rows of (vec_id, v): sorted ids, int8 rows with their scales, the
    norms of what rounding lost, and the doubles. Blocks hold one length of
    vector; ``keep``: the copies of a vector that a block keeps."""
    def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches).combine_chunks()
        ids = whole.column("vec_id").to_numpy()
        v = whole.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order] + 0.0  # -0.0 is 0.0
        if keep is not None:
            seen: dict[bytes, int] = {}
            first = []
            for i, row in enumerate(v):
                seen[b] = seen.get(b := row.tobytes(), 0) + 1
                if seen[b] <= keep:
                    first.append(i)
            ids, v = ids[first], v[first]
        scale = np.abs(v).max(1) / 127
        scale[scale == 0] = np.finfo(float).tiny  # too small to divide: all of it counts as lost
        small = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
        lost = np.linalg.norm(v - small * scale[:, None], axis=1)
        yield pa.RecordBatch.from_pylist([{"block": key[0].as_py(), "dim": key[1].as_py(), "ids": ids.astype("<i8").tobytes(), "small": small.tobytes(), "scale": scale.tobytes(), "lost": lost.tobytes(), "vectors": v.tobytes()}], BLOCK)

    return vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("block"), F.size("v").alias("dim"), "vec_id", "v").groupBy("block", "dim").applyInArrow(build, BLOCK_SQL)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows in double precision, summed in the order of the components."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * c[:, d]
    return out


def tile(row: dict) -> tuple[np.ndarray, ...]:
    ids, v = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"])
    return ids, np.frombuffer(row["small"], np.int8).reshape(len(ids), -1).astype(np.float32), np.frombuffer(row["scale"]), np.frombuffer(row["lost"]), v.reshape(len(ids), -1)


def survivors(query: tuple, candidate: tuple, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of the query, row of the candidate) that may be among the k nearest.

    ``floor``: for each query, a score that k others are known to reach.
    q.c = q'.c' + (q - q').c + q'.(c - c'), and each of the last two is at most
    the product of the norms.
    """
    qi, q8, qs, ql, qv = query
    ci, c8, cs, cl, cv = candidate
    # Products of int8 are whole numbers; float32 holds sums of 1,040 of them exactly.
    near = sum(q8[:, d : d + 1024] @ c8[:, d : d + 1024].T.astype(np.float32) for d in range(0, q8.shape[1], 1024)).astype(float)
    near *= qs[:, None]
    near *= cs
    q_norm, c_norm = np.linalg.norm(qv, axis=1), np.linalg.norm(cv, axis=1)
    bound = (ql[:, None] * c_norm + (q_norm + ql)[:, None] * cl) * (1 + 1e-9) + 1e-12 * q_norm[:, None] * c_norm
    near[qi[:, None] == ci] = -np.inf
    low = near - bound
    if low.shape[1] > k:
        floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
    return np.nonzero((near + bound >= floor[:, None]) & (near > -np.inf))


def cells(left: DataFrame, right: DataFrame, n_groups: int, n_stripes: int) -> DataFrame:
    """Blocks of queries (``kind`` 0) and of candidates (1), dealt to the cells of a grid.

    A cell is a group of query blocks against a stripe of candidate blocks: a
    block of queries is sent once for each stripe, a block of candidates once
    for each group. A partition has a cell's queries before its candidates.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    names = left.columns
    asked = left.select(F.lit(0).alias("kind"), (F.col("block") % n_groups).cast("int").alias("grp"), every(n_stripes).alias("stripe"), *names)
    given = right.select(F.lit(1).alias("kind"), every(n_groups).alias("grp"), (F.col("block") % n_stripes).cast("int").alias("stripe"), *names)
    return asked.unionByName(given).repartition("dim", "grp", "stripe").sortWithinPartitions("dim", "grp", "stripe", "kind", "block")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", query_rows: int = 1024, candidate_rows: int = 8192, held_blocks: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each row where ``queries`` (over ``vec_id``) holds.

    Nearest: largest inner product, ties to the smaller id; all candidates if
    there are fewer than k. Only vectors of the query's length are candidates.
    The grid has about as many groups and stripes as the square roots of the
    numbers of blocks, so what is sent grows with n to the 1.5; a task holds
    at most about ``held_blocks`` blocks of queries and one of candidates, beyond
    which there are more groups.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vec_col), "vectors")
    asked = rows.where(queries)
    n, n_asked = rows.count(), asked.count()
    n_query, n_candidate = max(1, -(-n_asked // query_rows)), max(1, -(-n // candidate_rows))
    left = materialize(blocks(asked, n_query, None), "queries")
    right = materialize(blocks(rows, n_candidate, k + 1), "candidates")
    root = lambda m: math.isqrt(m - 1) + 1  # noqa: E731  (rounded up)
    n_groups, n_stripes = max(root(n_query), -(-n_query // held_blocks)), root(n_candidate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by cell, queries first: the queries and heaps of one cell are held at a time.
        cell, held = None, []

        def result() -> Iterator[pa.RecordBatch]:
            for query, heaps in held:
                found = [(int(q), -i, s) for q, heap in zip(query[0], heaps) for s, i in heap]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), FOUND.types)], schema=FOUND)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if cell != (cell := (row["dim"], row["grp"], row["stripe"])):
                    yield from result()
                    held = []
                block = tile(row)
                if row["kind"] == 0:
                    held.append((block, [[] for _ in block[0]]))
                    continue
                for query, heaps in held:
                    floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
                    a, b = survivors(query, block, k, floor)
                    for start in range(0, len(a), 1 << 16):
                        x, y = a[start : start + (1 << 16)], b[start : start + (1 << 16)]
                        for at, s, c in zip(x.tolist(), products(query[4][x], block[4][y]).tolist(), block[0][y].tolist()):
                            if len(heaps[at]) < k:
                                heapq.heappush(heaps[at], (s, -c))
                            elif (s, -c) > heaps[at][0]:
                                heapq.heapreplace(heaps[at], (s, -c))
        yield from result()

    found = cells(left, right, n_groups, n_stripes).mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
