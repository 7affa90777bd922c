"""Session helpers.

``get_spark`` builds a local session for tests and the bench; on a cluster
the caller's session is used as is.  ``scratch_dir`` hands out a fresh
folder below the shared checkpoint directory the cluster names in
``spark.checkpoint.dir`` — a machine-local temp folder is used only when
that setting is unset (tests, local runs), and then it is also installed as
the checkpoint directory so ``DataFrame.checkpoint()`` works.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _default_driver_memory() -> str:
    """Half the machine's memory, capped at 16 GB (local mode runs in the driver JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(16, total // 2 // 2**30))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stargrain") -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", _default_driver_memory()))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(input_bytes: int, per_partition: int = 512 << 20) -> int:
    """``spark.sql.shuffle.partitions`` for a job that shuffles about ``input_bytes`` (AQE merges small ones)."""
    return max(200, -(-input_bytes // per_partition))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by their folders' listings (0 if it reads none)."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders: dict[str, set[str]] = {}
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        folders.setdefault(path.getParent().toString(), set()).add(path.getName())
    total = 0
    for folder, names in folders.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        total += sum(x.getLen() for x in path.getFileSystem(conf).listStatus(path) if x.getPath().getName() in names)
    return total


def partitions_for(df: DataFrame, per_partition: int = 2 << 20, most: int = 10_000) -> int:
    """Partitions for a shuffle of rows that are much longer than what they are made of: one for each 2 MB of the input files, so
    that a task's share stays the same as the input grows.  Never fewer than ``spark.sql.shuffle.partitions``,
    which decides alone beyond ``most``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(most, -(-input_bytes(df) // per_partition)))


# Settings meant for a large cluster (100 TB inputs).  Applied by the cluster's
# own configuration; listed here so the plan assumptions are explicit.  The number
# of shuffle partitions is set for each job by :func:`shuffle_partitions`.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # split a reducer partition that is 5x the median and above 512 MB
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # runtime broadcast only for dimensions that really are small
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # streaming dedup / SCD2 stage state off the JVM heap, checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # the range layout's checkpoint files go once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # survive executor loss: shuffle files outlive executors
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``).

    Read from the session; a machine-local folder is created only when the
    setting is unset (tests, local runs).  The folder is also installed as
    the context's checkpoint directory so ``DataFrame.checkpoint()`` works.
    """
    sc = None
    try:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        root = None
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stargrain-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
