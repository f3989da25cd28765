"""Cluster sizing and the stored-table entry point."""

from pyspark.sql import functions as F

from ehrspark.session import MB, cluster_conf, materialize, noting
from ehrspark.sources.fixtures import OmopData


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(20 * 1024 ** 4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(20 * 1024 ** 4 // (256 * MB))
    assert cluster_conf(1024, 8)["spark.sql.shuffle.partitions"] == "16"
    assert cluster_conf(10 ** 18, 8)["spark.sql.shuffle.partitions"] == "100000"


def test_from_tables_serves_stored_frames(spark):
    visits = spark.createDataFrame([(1, 1)], "visit_occurrence_id long, person_id long")
    d = OmopData.from_tables(spark, {"visit_occurrence": visits})
    assert d.visit_occurrence is visits


def test_materialize_runs_one_job(spark):
    """Only the rows are written: no job looks for the schema of what was just written."""
    df = spark.range(5).selectExpr("id", "cast(null as string) as s", "array(struct(id as x)) as a")
    spark.sparkContext.setJobGroup("test-materialize", "test")
    out = materialize(df, "test")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("test-materialize")) == 1
    assert out.dtypes == df.dtypes and sorted(out.collect()) == sorted(df.collect())
    assert materialize(df.limit(0), "test").count() == 0


def test_figures_are_noted_by_the_job_that_writes(spark):
    """Rows and sums of a written table, an empty one too, without another job."""
    df = spark.range(9).selectExpr("id", "id % 2 = 0 as even")
    cases = [(df, 9, 36, 5), (df.where("id > 100"), 0, None, 0), (df.limit(0), 0, None, 0), (df.join(df.where("id < 0"), "id", "left_semi"), 0, None, 0)]
    for k, (rows, n, total, even) in enumerate(cases):
        noted, told = noting(rows, total=F.sum("id"), even=F.count_if("even"))
        spark.sparkContext.setJobGroup(f"test-noting-{k}", "test")
        out = materialize(noted, "test")
        assert told() == {"n": n, "total": total, "even": even}
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert k or len(spark.sparkContext.statusTracker().getJobIdsForGroup("test-noting-0")) == 1
        assert out.columns == rows.columns and out.count() == n


def test_checkpoint_folder_when_unset(tmp_path):
    """Without spark.checkpoint.dir a private folder is made once per application."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "from ehrspark.session import ensure_checkpoint_dir, materialize\n"
        "a = ensure_checkpoint_dir(s); b = ensure_checkpoint_dir(s)\n"
        "assert a == b and s.sparkContext.getCheckpointDir() is not None\n"
        "assert s.range(5).checkpoint(eager=True).count() == 5 and materialize(s.range(5), 't').count() == 5\n"
        "print('ok')\n" % repo)
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("ok"), out.stderr[-2000:]
