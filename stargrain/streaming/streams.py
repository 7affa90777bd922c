"""Structured Streaming tables (T1-T4) and the incremental SCD2 refresh.

A streaming table is ``readStream`` -> the same DataFrame function used in
batch -> ``writeStream`` to parquet with a checkpoint, run with
``trigger(availableNow=True)`` so it processes what is there and stops.
Checkpoints and outputs live under the session's shared checkpoint folder
(:func:`stargrain.session.scratch_dir`), never in a machine-local folder
on a cluster; a restarted query resumes from its checkpoint, so a lost
executor or driver does not lose or duplicate output (file sink is exactly-once).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stargrain.operators.scd2 import scd2_apply


def stream_source(spark: SparkSession, directory: str, schema: StructType, glob: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of parquet files in ``directory`` (optionally one file
    via ``pathGlobFilter`` — a bare file path is not a valid stream source)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def _finish(q, limit_s: float | None) -> None:
    """Wait until the query ends; with ``limit_s`` stop it and raise after so many seconds."""
    try:
        if limit_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(limit_s):
            raise TimeoutError(f"the streaming query did not end within {limit_s} s")
    finally:
        if q.isActive:
            q.stop()


def run_available_now(df: DataFrame, out: str, checkpoint: str, *, mode: str = "append",
                      partition_by: Sequence[str] = (), fmt: str = "parquet",
                      limit_s: float | None = None) -> dict | None:
    """Run a streaming DataFrame to completion into ``out``.  Returns the
    last progress (its ``observedMetrics`` carry expectation counters)."""
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint) \
        .option("path", out).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    _finish(q, limit_s)
    return q.lastProgress


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      limit_s: float | None = None) -> None:
    _finish(df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(), limit_s)


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """T3 streaming dedup.  Without ``event_time`` it is ``dropDuplicates`` with
    state per key kept forever (the reference's behaviour: fine for dimension
    members, unbounded for facts); with ``event_time`` and ``delay`` the state
    is bounded by the watermark (``dropDuplicatesWithinWatermark``)."""
    if event_time and delay:
        if df.schema[event_time].dataType.simpleString() == "timestamp":
            return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
        # watermarks need TIMESTAMP: watch a session-time copy of a TIMESTAMP_NTZ/DATE column
        wm = df.withColumn("_sg_event_time", F.col(event_time).cast("timestamp"))
        return wm.withWatermark("_sg_event_time", delay).dropDuplicatesWithinWatermark(list(keys)) \
            .drop("_sg_event_time")
    return df.dropDuplicates(list(keys))


EPOCH = "sg_epoch"


def _has_data(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path))


def incremental_scd2(log_dir: str, versions_dir: str, keys: Sequence[str], sequence_by: str,
                     tracked: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for SCD2 on a stream of staged snapshots.

    Each micro-batch is one partition of the change log (its epoch), and the
    full history of the keys it touched — found by a semi-join of the log —
    is one partition of the version store.  Nothing else is rewritten; a key's
    current history is the one of its latest epoch (:func:`scd2_store`).  Late and
    out-of-order snapshots are right because a touched key is rebuilt from
    its whole log.  A micro-batch that is run again after a failure overwrites
    the partitions of its own epoch, so nothing is doubled.
    """
    keys = list(keys)

    def write(df: DataFrame, path: str, epoch: int) -> None:
        (df.withColumn(EPOCH, F.lit(epoch).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(path))

    def body(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        write(batch, log_dir, epoch)
        log = spark.read.parquet(log_dir).where(F.col(EPOCH) <= epoch)
        touched = log.where(F.col(EPOCH) == epoch).select(*keys).distinct()
        mine = log.drop(EPOCH).join(touched, keys, "left_semi").dropDuplicates()
        trk = list(tracked) if tracked is not None else [c for c in mine.columns if c not in keys]
        write(scd2_apply(mine, keys, sequence_by, tracked=trk), versions_dir, epoch)

    return body


def scd2_store(spark: SparkSession, versions_dir: str, keys: Sequence[str]) -> DataFrame:
    """The versions as they stand: of each key the history written by the latest epoch that touched it."""
    every = spark.read.parquet(versions_dir)
    latest = every.groupBy(*keys).agg(F.max(EPOCH).alias(EPOCH))
    return every.join(latest, [*keys, EPOCH], "left_semi").drop(EPOCH)


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been written yet (no micro-batch had rows)."""
    return spark.read.parquet(path) if _has_data(spark, path) else spark.createDataFrame([], schema)
