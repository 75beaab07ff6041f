"""Session helpers: building a session and finding the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job in the library.  AQE re-plans joins and
# coalesces partitions at runtime, and the session zone is pinned so that
# date/time bucketing never depends on the machine the driver runs on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that are gone are deleted (static setting).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tierline", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only meant for local runs and tests; on a cluster the
    launcher decides it.  ``shuffle_partitions`` should be sized so a
    post-shuffle partition stays around 100-200 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session.  Only when it is unset on a local master
    (local runs, tests) a private folder is created and registered; on a
    cluster an unset folder is an error, because a machine-local folder is
    not reachable from the executors and would not survive their loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the "
                               "cluster's distributed file system) before running tierline jobs")
        # Only the context's setting: the session conf of that name is static.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierline-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for a written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tierline/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Deletes the scratch tables under the checkpoint root that were last
    changed so long ago, and returns their number.  What a job returns reads its
    scratch tables lazily, so no job can delete them itself: run this when the
    results have been read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/tierline")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(path) if s.getModificationTime() < limit]
    for p in old:
        fs.delete(p, True)
    return len(old)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tooling (tests) can open the path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


# The runtime SQL settings of the reference's dev and prod
# cluster profiles (memory, executor and service settings are deploy-time
# and belong to the launcher, not to a running session).
PROFILES = {
    "dev": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.parquet.columnarReaderBatchSize": "1024",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.autoBroadcastJoinThreshold": "50MB",
        "spark.sql.broadcastTimeout": "300s",
        "spark.sql.files.maxPartitionBytes": "64MB",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    },
    "prod": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin": "0.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        "spark.sql.shuffle.partitions": "200",
        "spark.sql.parquet.columnarReaderBatchSize": "4096",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.autoBroadcastJoinThreshold": "100MB",
        "spark.sql.broadcastTimeout": "600s",
        "spark.sql.files.maxPartitionBytes": "128MB",
        "spark.sql.files.openCostInBytes": "16MB",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        "spark.sql.optimizer.inSetConversionThreshold": "50",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    },
}


def apply_profile(spark: SparkSession, name: str) -> None:
    """Set a named profile's SQL settings on a running session."""
    for k, v in PROFILES[name].items():
        spark.conf.set(k, v)


def size_shuffle(spark: SparkSession, input_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                 floor: int = 200) -> int:
    """Size shuffles for the data at hand: a fixed 200 (or 50) partitions
    would give ~500 GB partitions on a 100 TB input.  AQE starts from one
    partition per ``target_bytes`` of input and coalesces small ones, so the
    same setting serves small and large runs."""
    n = max(floor, -(-int(input_bytes) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n


def runtime_filters(spark: SparkSession, min_scan_bytes: int = 10 << 30, max_build_bytes: int = 10 << 20) -> None:
    """Lets Spark prune the large side of a join by a bloom filter of the small
    side's keys, built at run time: where the large side scans at least
    ``min_scan_bytes`` and the filtered small side is at most ``max_build_bytes``.
    Worth it for a shuffled join of a fact table with a selective dimension."""
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", str(int(min_scan_bytes)))
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", str(int(max_build_bytes)))
