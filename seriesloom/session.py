"""Session settings the library relies on, and places to keep reliable state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the running session that the operators count on.

    Zone: timestamps are zoneless, and hour truncation must not see DST.
    Method limit: the JVM never compiles methods above 8,000 bytes of bytecode.
    Wide repair projections exceed that when fused into one stage and then run
    interpreted (three times slower here); with the limit Spark splits them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Directory every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Where it is unset, a local master gets a
    fresh temporary directory; any other master is refused, because a
    machine-local directory does not outlive an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="seriesloom-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared directory that no other run uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


_STAGED: list[str] = []


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared directory and read it back.

    Cuts the lineage like a checkpoint does, but later readers keep column
    pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Delete what was written under ``scratch_path`` in this process, once nothing reads them."""
    dropped = 0
    while _STAGED:
        target = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        dropped += 1
    return dropped


def side_by_side(spark: SparkSession, run: Callable, tasks: list, at_once: int = 4) -> list:
    """What ``run`` gives for each task, in order, a few at a time: the jobs of a fit are
    many and small, and the last tasks of one leave cores to another."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), tasks))


# Observed rows become about ten grid rows each, which a task sorts twice.
SPREAD = 4


def spread_by_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash partitioning by ``keys`` into ``SPREAD`` times ``spark.sql.shuffle.partitions`` parts.

    For operators that multiply rows after a shuffle: adaptive coalescing sizes
    partitions by what goes in and would leave too few. The windows that follow
    need this partitioning anyway, so it adds no shuffle.
    """
    if not keys:
        return df
    parts = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)
