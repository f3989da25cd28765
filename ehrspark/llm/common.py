"""Helpers shared by the operators of this subpackage.

Row rules that hold for every operator: an operator reads only the columns it
names, so extra columns never clash with its own; a null ``text`` counts as
the empty text unless the operator says otherwise; a null ``doc_id`` is an
ordinary id that sorts first; repeated rows are repeated in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize

__all__ = ["DROPS", "EVERY_SPACE", "WORD", "bucket_of", "claim", "documents", "materialize", "slices", "summed", "table"]

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Unicode's White_Space characters, the ``\s`` of the tokenizers library.
EVERY_SPACE = "\t-\r \x85\xa0  -     　"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the named string columns, nothing else."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                     *[F.col(c).cast("string").alias(c) for c in more])


def bucket_of(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty string (0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


#: How to drop what each operator's tasks remember in a worker process. A process serves one stage after another.
DROPS: dict[str, Callable[[], None]] = {}


def claim(owner: str) -> None:
    """Called as a task begins: what other operators have left in this process goes."""
    for name, drop in DROPS.items():
        if name != owner:
            drop()
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20, max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds about ``max_bytes`` in each (one row at least)."""
    for batch in batches:
        start = size = 0
        lengths = [v or 0 for v in pa.compute.binary_length(batch.column(column)).to_pylist()]
        for i, n in enumerate(lengths):
            if i > start and (size + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if len(lengths) > start:
            yield batch.slice(start)


def summed(rows: DataFrame, column: str, one: Callable[[pa.RecordBatch], np.ndarray], width: int, chunk: int = 1 << 14, max_bytes: int = 4 << 20) -> np.ndarray:
    """Sum over all rows of the vectors of length ``width`` that ``one(batch)`` makes.

    Batches are cut by the size of ``column``. A task sums its batches; its
    vector is shuffled in chunks, which are summed by number, and only the one
    sum reaches the driver.
    """
    schema = pa.schema([("chunk", pa.int32()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in slices(batches, column, max_bytes):
            total += one(batch)
        held = [k for k in range(0, width, chunk) if total[k : k + chunk].any()]
        if held:
            yield pa.RecordBatch.from_pylist([{"chunk": k, "v": total[k : k + chunk].tobytes()} for k in held], schema)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for v in batch.column("v").to_pylist():
                total = total + np.frombuffer(v)
        yield pa.RecordBatch.from_pylist([{"chunk": key[0].as_py(), "v": total.tobytes()}], schema)

    out = np.zeros(width)
    for r in rows.mapInArrow(run, "chunk int, v binary").groupBy("chunk").applyInArrow(merge, "chunk int, v binary").collect():
        out[r.chunk : r.chunk + chunk] = np.frombuffer(r.v)
    return out
