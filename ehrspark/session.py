"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Settings every job relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the time zone pins date arithmetic.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def cluster_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 * MB,
                 max_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a large cluster, sized from the largest expected shuffle.

    ``shuffle_bytes`` is the biggest shuffle a job writes (here partial
    aggregates, or fact rows on the fallback join paths). The initial shuffle
    partition count gives each reduce task about ``partition_bytes`` and at
    least two tasks per core; AQE then coalesces small partitions towards the
    same advisory size and splits partitions five times the median size
    (skewed keys). File splits match, so scan tasks and reduce tasks hold
    similar amounts of data and fit executor memory without spilling.
    Example: a 20 TB shuffle on 1000 executors × 8 cores → 80,000 partitions.
    """
    wanted = -(-shuffle_bytes // partition_bytes)
    parts = int(min(max_partitions, max(2 * total_cores, wanted)))
    size = f"{partition_bytes // MB}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        # Catalyst's static broadcast choice is for sides it estimates below
        # this; operator-level broadcasts are checked by row count instead.
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ehrspark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided one."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINT_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is. Only when
    it is unset (local tests) a private temporary folder is created, once per
    application. The SparkContext's RDD checkpoint folder is set if missing.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = _LOCAL_CHECKPOINT_DIRS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="ehrspark-ckpt-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    For intermediates read by several later passes: the lineage is cut, the
    readers get columnar scans with pruning, and a lost executor costs a
    re-read instead of a recomputation. The schema is known, so no job looks for it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def noting(df: DataFrame, **figures: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """``df``, and a call that tells, once one job has written it, how many rows it has (``n``) and the ``figures``, aggregates over them.

    Saves the job, with its shuffle, that would read a table just written to count it.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in figures.items()]), lambda: seen.get
