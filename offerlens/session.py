"""Spark session helpers.

Everything in the library is a ``DataFrame -> DataFrame`` function; the only
session-level concerns are the configuration that keeps results deterministic
(UTC, ANSI) and scale-friendly (AQE, skew join), and where to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Local runs only: the driver JVM is the executor, so it needs real memory.
LOCAL_CONF = {"spark.driver.memory": "12g"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "offerlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster the master comes from ``spark-submit``; locally pass
    ``local[N]``.  Shuffle partitions default to 2-3x the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        for k, v in LOCAL_CONF.items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a folder of our own is
    set only when it is unset (local tests).
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="offerlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike local checkpoints): the data is written to
    the cluster's shared storage and the plan restarts from there.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Shuffles of a stored stage are cut into so many parts, of which
# neighbours are read together up to this size (as shuffled; some ten times that
# in a sort), so that what a task sorts also fits the memory of small executors.
STAGE_PARTS = 2048
STAGE_TASK_SIZE = "8m"


@contextmanager
def fine_tasks(spark: SparkSession, task_size: str | None = None, parts: int = STAGE_PARTS) -> Iterator[None]:
    """Many small tasks for the shuffles of what is written inside; small
    inputs still come in as many tasks as there are cores."""
    parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": task_size or STAGE_TASK_SIZE}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_MATERIALIZED: dict[tuple, str] = {}


def is_materialized(spark: SparkSession, key: tuple) -> bool:
    return (spark.sparkContext.applicationId, *key) in _MATERIALIZED


def materialize(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Stage boundary: write ``build()`` once per application as Parquet in
    the shared checkpoint folder and read it back for every later use.

    Later stages start from files on shared storage (lineage cut, so a lost
    executor never recomputes the upstream joins) instead of re-running the
    whole upstream plan in every query."""
    import uuid
    k = (spark.sparkContext.applicationId, *key)
    path = _MATERIALIZED.get(k)
    if path is None:
        path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
        df = build()
        with fine_tasks(spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        _MATERIALIZED[k] = path
    return spark.read.parquet(path)


def stage(df: DataFrame, name: str, fine: bool = False) -> DataFrame:
    """Write an intermediate result as Parquet into the shared checkpoint
    folder and continue from the files.

    Used where a plan branches (a table joined back to an aggregate of
    itself): without the cut every branch re-runs the whole upstream join
    chain.  Parquet keeps column pruning and filter push-down for the
    readers of the stage.  ``fine``: by ``fine_tasks``, for wide sorts."""
    import uuid
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stages/{name}-{uuid.uuid4().hex}"
    with fine_tasks(df.sparkSession) if fine else nullcontext():
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
