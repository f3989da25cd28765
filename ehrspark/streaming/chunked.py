"""Running condition-code counts over a growing folder of condition files."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import deliveries
from ..session import scratch_path

CODE = "condition_source_value"


def condition_count_stream(spark: SparkSession, folder: str, fmt: str = "parquet",
                           files_per_batch: int = 1) -> DataFrame:
    """Streaming (condition_source_value, count) over the files of ``folder``.

    Same semantics as the batch ranking: ``count(code)``, so a NULL code
    group counts 0. The state is one running count per distinct code.
    CSV files must carry the condition columns of the fixed schema, in order;
    parquet files are matched by column name.
    """
    src = condition_rows_stream(spark, folder, fmt, files_per_batch)
    return src.groupBy(CODE).agg(F.count(CODE).alias("count"))


def condition_rows_stream(spark: SparkSession, folder: str, fmt: str = "parquet", files_per_batch: int = 1) -> DataFrame:
    """The condition rows of ``folder`` as a stream, so many files a micro-batch."""
    reader = (spark.readStream.schema(schemas.CONDITION_OCCURRENCE)
              .option("maxFilesPerTrigger", files_per_batch))
    if fmt == "csv":
        # A streaming source needs its schema up front; the header is checked
        # against it so a file with other columns fails instead of misaligning.
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(folder)


def run_to_states(spark: SparkSession, rows: DataFrame, folder: str, checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available now; each micro-batch becomes one delivery's state under ``folder``.

    The batch's state is written by its number, so a retried batch replaces
    itself; nothing is kept in a state store or on the driver. Totals come from
    ``deliveries.merge(deliveries.states(...))`` at any time.
    """
    checkpoint = checkpoint or scratch_path(spark, os.path.join("streams", target_key(folder)))

    def write(batch: DataFrame, batch_id: int) -> None:
        deliveries.deliver(batch, folder, f"batch-{batch_id:010d}")

    q = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_to_table(spark: SparkSession, stream: DataFrame, name: str,
                 checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available now in micro-batches, then stop.

    The full result is rewritten after each batch under the shared
    ``spark.checkpoint.dir`` and offered as the temporary view ``name``; no
    row of it passes through the driver. The checkpoint goes there too, so a restarted
    driver resumes from the last committed batch.
    """
    path = scratch_path(spark, os.path.join("tables", name))
    q = run_to_path(spark, stream, path, checkpoint or scratch_path(spark, os.path.join("streams", name)))
    spark.read.parquet(path).createOrReplaceTempView(name)
    return q


def target_key(path: str) -> str:
    """A folder name of its own for each output path, so that outputs never share a checkpoint."""
    return f"{os.path.basename(path.rstrip('/'))}-{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}"


def run_to_path(spark: SparkSession, stream: DataFrame, path: str,
                checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available now; after each micro-batch the complete
    result replaces the parquet folder ``path``.

    Rewriting the whole (small, one row per code) result per batch makes a
    retried batch idempotent; the checkpoint under ``spark.checkpoint.dir``
    lets a restarted driver resume after the last committed batch.
    """
    checkpoint = checkpoint or scratch_path(spark, os.path.join("streams", target_key(path)))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    q = (stream.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
