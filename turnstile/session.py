"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "turnstile") -> SparkSession:
    """A local session configured the way tests and the bench expect.

    On a cluster, build the session with the cluster's own settings instead;
    nothing in the library depends on this function.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # merge small shuffle partitions up to the advisory size instead of
        # keeping one per core (fewer, fuller tasks); 16 MB suits inputs of
        # a few hundred MB on 8 cores (CLUSTER_CONF uses 256 MB)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TURNSTILE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for a large cluster (100 TB input, ~1000 executors).  Pass them to
# the session builder or spark-submit; nothing in the library requires them.
CLUSTER_CONF: dict[str, str] = {
    # AQE: start with many shuffle partitions and let AQE merge small ones to
    # ~256 MB, split skewed join partitions, and turn joins whose runtime
    # shuffle output is small into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.shuffle.partitions": "32768",
    # scans: ~256 MB splits (Parquet row groups of 128-256 MB)
    "spark.sql.files.maxPartitionBytes": "256m",
    # runtime bloom filters for selective joins whose filter sits on the key's
    # own table (the working set prunes receipts explicitly, see prune_to_scope)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # ANSI: overflow raises instead of wrapping (money sums, packed ids)
    "spark.sql.ansi.enabled": "true",
    # executor loss: keep shuffle output of lost executors reachable and
    # migrate blocks off decommissioned nodes
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting always wins.  Only a *local* session without any setting (tests,
    the bench, the driver's smoke run) gets a fresh scratch folder.  A
    non-local session without a shared folder is an error: a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpointed stages survive executor loss")
    scratch = tempfile.mkdtemp(prefix="turnstile-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


_FRAMES: ContextVar[list[str] | None] = ContextVar("turnstile_frames", default=None)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed in the block removes its shuffle files when it ends; else they stay on the
    executors' disks until the driver happens to collect its garbage.  For writes, of which only the result is read later."""
    before = spark.conf.get(_RELEASE, None)
    if before == "true":
        yield
        return
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def materialize(df: DataFrame, compression: str = "zstd", release: bool = False) -> DataFrame:
    """A frame that is read several times, computed once: written as Parquet to
    the shared checkpoint folder and read back, so its lineage is cut there (it
    survives lost executors) and each reader scans only its own columns.
    zstd makes the smaller files, snappy needs the least memory beside the heap.  ``release``
    removes the shuffle files of the write when it ends (:func:`released_shuffles`).

    Inside :func:`scratch_frames` it is deleted at the end."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/frame-{uuid.uuid4().hex}"
    with released_shuffles(df.sparkSession) if release else contextlib.nullcontext():
        df.write.option("compression", compression).parquet(path)
    held = _FRAMES.get()
    if held is not None:
        held.append(path)
    return df.sparkSession.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whatever store holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


@contextlib.contextmanager
def scratch_frames(spark: SparkSession) -> Iterator[None]:
    """Delete the frames that :func:`materialize` writes in the block when it
    ends; by then whatever reads them must have been written::

        with scratch_frames(spark):
            for name, product in dump(src, lo, hi, profile).items():
                write_folder(product, f"{out}/{name}")
    """
    held: list[str] = []
    token = _FRAMES.set(held)
    try:
        yield
    finally:
        _FRAMES.reset(token)
        for path in held:
            delete_path(spark, path)
