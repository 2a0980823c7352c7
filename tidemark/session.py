"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join partition is split even when the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles methods above 8000 bytes of bytecode. Wide feature expressions exceed
    # that inside one whole-stage method and then run interpreted; past the limit Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Join and window state outgrows executor heap on long streams; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_scratch_root: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on; safe to call repeatedly."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    if _is_local(spark):
        if spark.conf.get("spark.sql.shuffle.partitions") == "200":
            spark.conf.set("spark.sql.shuffle.partitions", str(cores))
    elif spark.conf.get(INITIAL_PARTITIONS, None) is None:
        # Adaptive execution merges small shuffle partitions but does not add any: start from many.
        spark.conf.set(INITIAL_PARTITIONS, str(max(200, 4 * cores)))
    return spark


def get_session(app_name: str = "tidemark", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a temp folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _scratch_root:
        _scratch_root[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _scratch_root[app]


def spread(df: DataFrame) -> DataFrame:
    """Rows to be scanned many times, in at least one partition per core.

    Small inputs arrive in few splits and would leave cores idle on every pass; large ones already
    have more splits than cores and are left alone. The planner's size estimate tells them apart,
    so nothing runs.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if estimate < cores * split else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a directory that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(shared_root(spark), "checkpoints"))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and a lost
    executor costs no more than a read."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared root, for written tables and stream checkpoints.

    Whatever is written there goes when the driver's JVM ends: returned DataFrames may read it
    as long as their session lives, and no longer.
    """
    path = os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    # The file system keeps only marks for paths that exist, so the folder is made first.
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where)
    system.deleteOnExit(where)
    return os.path.join(path, "data")
