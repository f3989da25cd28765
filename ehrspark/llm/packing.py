"""Best-fit packing planned on the histogram of lengths (operator 6).

Texts become token ids with an end id; a document longer than a sequence is
cut, its first piece may be shorter. Only the counts of pieces by length (one
for each length up to the sequence's) reach the driver. Best fit over counts
places the longest lengths first, each into the open sequences with the least
room that holds it, many equal sequences at a time, and leaves runs: pieces
of one length with ranks lo, lo + 1, ... take the sequences seq, seq + 1, ...
at one offset. Pieces then find their run by their rank within the length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.joins import measured
from ..session import materialize
from .common import documents, slices
from .tokens import encoder


SMALL = 64 << 20  # bytes of the partitions' shares that are broadcast


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, rank[, ids]) of all texts; a null text has its end id alone.

    ``rank`` numbers the pieces of one length in a partition.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("rank", pa.int64()), ("ids", pa.binary())]
    schema = pa.schema(fields if keep_ids else fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, met = np.array([end_id], "<u4").tobytes(), [0] * (size + 1)
        for batch in slices(batches, "text", 3 << 20):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer, "byte").encode(batch.column("text").to_pylist())):
                ids += end
                first = len(ids) % (4 * size) or 4 * size
                cuts = [0, *range(first, len(ids) + 1, 4 * size)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    n = (b - a) // 4
                    rows.append((doc_id, i, a // 4, n, zlib.crc32(ids[a:b]), met[n], ids[a:b])[: len(schema)])
                    met[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return documents(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, rank long" + ", ids binary" * keep_ids)


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset) that place all pieces.

    Sequences with equal room are kept as intervals of numbers, so the work
    depends on the lengths and the kinds of sequence, not on the pieces.
    """
    open_by: dict[int, deque[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, fresh = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room not in open_by:
            bisect.insort(rooms, room)
            open_by[room] = deque()
        open_by[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_by[room].popleft()
                take = min(n, left)
                if take < n:
                    open_by[room].appendleft((first + take, n - take))
                elif not open_by[room]:
                    del open_by[room], rooms[at]
            else:
                # The emptiest sequences: as many as the pieces fill to the brim.
                room, first, take = size, fresh, -(-left // (size // length))
                fresh += take
            runs.append((length, rank, take, first, size - room))
            rank, left = rank + take, left - take
            if room > length:
                put(room - length, first, take)
    return runs


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, keep_ids: bool = False) -> DataFrame:
    """The pieces with (sequence_id, offset); an empty table gives no rows.

    Ranks within a length are counted as the pieces are made, partition by
    partition; what a partition adds to its ranks, the pieces of that length before it, is a small
    table. It is broadcast up to ``SMALL`` bytes, and beyond that joined by length and
    partition, so that no task holds more than a partition had.
    """
    spark = docs.sparkSession
    some = pieces(docs, tokenizer, end_id, size, keep_ids).withColumn("part", F.spark_partition_id())
    some = materialize(some, "pieces")
    by_part = some.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    before, small = measured(before, None, SMALL, "before")
    counts = {r["length"]: r["n"] for r in some.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # size rows at most
    runs = plan(counts, size)
    shared = spark.sparkContext.broadcast({k: np.array([r[1:] for r in runs if r[0] == k], np.int64) for k in counts})
    ranked = some.join(F.broadcast(before) if small else before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("rank"))
    fields = [f for f in some.schema.fieldNames() if f not in ("part", "rank")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            seq, offset = np.zeros((2, len(rank)), np.int64)
            for k in np.unique(length):
                at, its = np.flatnonzero(length == k), table[int(k)]
                run = its[np.searchsorted(its[:, 0], rank[at], "right") - 1]
                seq[at], offset[at] = run[:, 2] + rank[at] - run[:, 0], run[:, 3]
            yield pa.RecordBatch.from_arrays([*[batch.column(f) for f in fields], pa.array(seq), pa.array(offset)], [*fields, "sequence_id", "offset"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema if f.name in fields)
    return ranked.select(*fields, "rank").mapInArrow(place, f"{out}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing with ``keep_ids``: the pieces' ids at their offsets, u32."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))), lambda x: x["h"])
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(rows, "")).alias("ids"))
