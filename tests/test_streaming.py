"""Micro-batch condition counts equal the batch ranking."""

import uuid

from fixture_paths import SF_SMALL
from ehrspark.operators import codes
from ehrspark.sources.fixtures import OmopData
from ehrspark.streaming.chunked import condition_count_stream, run_to_table


def test_stream_counts_match_batch(spark, tmp_path):
    cond = OmopData(spark, SF_SMALL).condition_occurrence
    folder = str(tmp_path / "conditions")
    cond.repartition(4).write.parquet(folder)
    name = f"cc_{uuid.uuid4().hex[:8]}"
    q = run_to_table(spark, condition_count_stream(spark, folder, files_per_batch=1), name,
                     checkpoint=str(tmp_path / "ckpt"))
    assert q.lastProgress is not None
    got = {r[0]: r[1] for r in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {r[0]: r[1] for r in codes.condition_counts(cond).collect()}
    assert got == want


def test_stream_counts_to_parquet(spark, tmp_path):
    from ehrspark.streaming.chunked import run_to_path
    cond = OmopData(spark, SF_SMALL).condition_occurrence
    folder = str(tmp_path / "conditions")
    cond.repartition(3).write.parquet(folder)
    out = str(tmp_path / "counts")
    run_to_path(spark, condition_count_stream(spark, folder, files_per_batch=2), out,
                checkpoint=str(tmp_path / "ckpt2"))
    got = {r[0]: r[1] for r in spark.read.parquet(out).collect()}
    want = {r[0]: r[1] for r in codes.condition_counts(cond).collect()}
    assert got == want


def test_outputs_of_one_name_have_checkpoints_of_their_own():
    from ehrspark.streaming.chunked import target_key
    assert target_key("/a/counts") != target_key("/b/counts") and target_key("/a/counts/") == target_key("/a/counts")
