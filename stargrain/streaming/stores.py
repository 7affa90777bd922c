"""Tables that a stream keeps up to date batch by batch: SCD2 versions by key bucket, deterministic keep-first,
and rows that wait for a dimension.

Every body is for ``foreachBatch``.  A micro-batch writes under its own epoch and replaces what it wrote there
before, so a batch that runs again after a failure leaves the same table; the readers combine the epochs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.operators.facts import Lookup, lookup_keys
from stargrain.operators.rows import unique_first
from stargrain.operators.scd2 import scd2_apply
from stargrain.session import scratch_dir

EPOCH, BUCKET, OPEN = "sg_epoch", "sg_bucket", "sg_open"
MOST_BUCKETS = 100_000


def _fs(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _folders(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of a partition column among the folders directly below ``path``."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def _read(spark: SparkSession, base: str, folders: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", base).parquet(*folders)


# ---------------------------------------------------------------------------
# T5: versions by key bucket
# ---------------------------------------------------------------------------
def bucket_count(spark: SparkSession, root: str, wanted: int | None = None) -> int:
    """The store's number of buckets, written once when the store is made (``wanted``, 64 if not given)."""
    path = f"{root}/layout"
    fs, at = _fs(spark, f"{path}/_SUCCESS")
    if not fs.exists(at):
        n = 64 if wanted is None else wanted
        if not 1 <= n <= MOST_BUCKETS:
            raise ValueError(f"buckets: 1 to {MOST_BUCKETS}")
        spark.createDataFrame([(n,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(path)
    n = spark.read.schema("buckets int").parquet(path).first()[0]
    if wanted is not None and wanted != n:
        raise ValueError(f"the store at {root} has {n} buckets, not {wanted}")
    return n


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def _replace(df: DataFrame, path: str) -> None:
    # a file per bucket, or several if it is large: adaptive execution splits a hot bucket
    (df.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, EPOCH).parquet(path))


def touched_log(spark: SparkSession, root: str, epoch: int) -> DataFrame:
    """The log rows of the buckets that an epoch wrote to, up to that epoch.  Only those buckets' folders are listed and
    read; their numbers (as many as the store has buckets at most) are all that the driver sees."""
    log = f"{root}/log"
    mine = [b for b in _folders(spark, log, BUCKET) if epoch in _folders(spark, f"{log}/{BUCKET}={b}", EPOCH)]
    rows = _read(spark, log, [f"{log}/{BUCKET}={b}" for b in mine] or [log])
    return rows.where(F.col(EPOCH) <= epoch) if mine else rows.where("false")


def bucketed_scd2(root: str, keys: Sequence[str], sequence_by: str, tracked: Sequence[str] | None = None,
                  buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """SCD2 over a stream of staged snapshots, in a store whose cost follows the touched keys.

    Log and versions are partitioned by a hash bucket of the key and by epoch.  A batch adds its snapshots to the log, reads
    the log of the buckets it wrote to and nothing else, and rebuilds the whole history of the keys it touched under its
    epoch, so late and out-of-order snapshots are right.  :func:`bucketed_versions` reads each key's
    latest; :func:`compact_scd2` folds old epochs so that a bucket keeps few files.
    """
    keys = list(keys)

    def body(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        n = bucket_count(spark, root, buckets)
        _replace(batch.withColumn(BUCKET, _bucket(keys, n)).withColumn(EPOCH, F.lit(epoch).cast("bigint")), f"{root}/log")
        if not _folders(spark, f"{root}/log", BUCKET):
            return  # no batch has had rows yet
        log = touched_log(spark, root, epoch)
        touched = log.where(F.col(EPOCH) == epoch).select(BUCKET, *keys).distinct()
        mine = log.drop(EPOCH).join(touched, [BUCKET, *keys], "left_semi").drop(BUCKET).dropDuplicates()
        trk = list(tracked) if tracked is not None else [c for c in mine.columns if c not in keys]
        made = scd2_apply(mine, keys, sequence_by, tracked=trk)
        _replace(made.withColumn(BUCKET, _bucket(keys, n)).withColumn(EPOCH, F.lit(epoch).cast("bigint")), f"{root}/versions")

    return body


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the rows of its latest epoch."""
    last = rows.groupBy(BUCKET, *keys).agg(F.max(EPOCH).alias(EPOCH))
    return rows.join(last, [BUCKET, *keys, EPOCH], "left_semi")


def bucketed_versions(spark: SparkSession, root: str, keys: Sequence[str], only: Sequence[int] | None = None) -> DataFrame:
    """The versions as they stand; with ``only`` those of some buckets, whose folders alone are read."""
    path = f"{root}/versions"
    folders = [path] if only is None else [f"{path}/{BUCKET}={b}" for b in only]
    return _latest(_read(spark, path, folders), list(keys)).drop(BUCKET, EPOCH)


def buckets_of(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str]) -> list[int]:
    """The buckets of the keys in ``rows``, for a pruned read."""
    n = bucket_count(spark, root)
    return sorted(r[0] for r in rows.select(_bucket(keys, n)).distinct().collect())


def compact_scd2(spark: SparkSession, root: str, keys: Sequence[str], upto: int, epochs: int = 2) -> list[int]:
    """Fold the epochs up to ``upto`` into that one, in the buckets that have ``epochs`` of them or more; returns those buckets.

    The log's rows become one set of distinct snapshots, of the versions only each key's latest stay.  The
    folded rows are written aside first, then replace the bucket's epoch ``upto``, then the older folders go: a failure
    in between leaves rows that readers already pass over.  Run it when no batch is running.
    """
    keys = list(keys)
    full = []
    for part in ("log", "versions"):
        path = f"{root}/{part}"
        for b in _folders(spark, path, BUCKET):
            if sum(e <= upto for e in _folders(spark, f"{path}/{BUCKET}={b}", EPOCH)) >= epochs and b not in full:
                full.append(b)
    for part in ("log", "versions"):
        path = f"{root}/{part}"
        there = [b for b in full if b in _folders(spark, path, BUCKET)]
        if not there:
            continue
        rows = _read(spark, path, [f"{path}/{BUCKET}={b}" for b in there]).where(F.col(EPOCH) <= upto)
        folded = rows.drop(EPOCH).dropDuplicates() if part == "log" else _latest(rows, keys).drop(EPOCH)
        aside = scratch_dir(spark, "compacted")
        folded.withColumn(EPOCH, F.lit(upto).cast("bigint")).write.parquet(aside)
        _replace(spark.read.parquet(aside), path)
        for b in there:
            for e in _folders(spark, f"{path}/{BUCKET}={b}", EPOCH):
                if e < upto:
                    fs, old = _fs(spark, f"{path}/{BUCKET}={b}/{EPOCH}={e}")
                    fs.delete(old, True)
    return sorted(full)


# ---------------------------------------------------------------------------
# Keep-first whatever the order of arrival
# ---------------------------------------------------------------------------
def keep_first_batches(root: str, keys: Sequence[str], order: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Each batch leaves its first row of every key (``unique_first``: least by ``order``, then by all columns).  The least of the
    epochs' least is the least of all, so :func:`keep_first_table` does not depend on which rows came
    first, and no state is held between batches."""
    def body(batch: DataFrame, epoch: int) -> None:
        unique_first(batch, keys, order).write.mode("overwrite").parquet(f"{root}/{EPOCH}={epoch}")
    return body


def keep_first_table(spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    return unique_first(spark.read.parquet(root).drop(EPOCH), keys, order)


def fold_keep_first(spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] | None = None) -> None:
    """Fold all epochs into the last one: the table's size is that of its keys again."""
    epochs = _folders(spark, root, EPOCH)
    if len(epochs) < 2:
        return
    aside = scratch_dir(spark, "folded")
    keep_first_table(spark, root, keys, order).write.parquet(aside)
    spark.read.parquet(aside).write.mode("overwrite").parquet(f"{root}/{EPOCH}={epochs[-1]}")
    for e in epochs[:-1]:
        fs, old = _fs(spark, f"{root}/{EPOCH}={e}")
        fs.delete(old, True)


# ---------------------------------------------------------------------------
# Rows whose dimension (or fact) row comes later
# ---------------------------------------------------------------------------
Lookups = Callable[[SparkSession], Sequence[Lookup]]


def _unresolved(lookups: Sequence[Lookup]) -> Column:
    """A business key without its surrogate key; a NULL business key has none to wait for."""
    out = F.lit(False)
    for lk in lookups:
        out = out | (F.col(f"`{lk.bk}`").isNotNull() & F.col(f"`{lk.sk}`").isNull())
    return out


def _waiting(spark: SparkSession, root: str, epoch: int | None = None) -> DataFrame | None:
    """The rows that wait after the last epoch (before ``epoch``)."""
    epochs = [e for e in _folders(spark, root, EPOCH) if epoch is None or e < epoch]
    path = f"{root}/{EPOCH}={epochs[-1]}/{OPEN}=true" if epochs else None
    if path is None or not _fs(spark, path)[0].exists(_fs(spark, path)[1]):
        return None
    return spark.read.parquet(path)


def late_lookups(root: str, lookups: Lookups) -> Callable[[DataFrame, int], None]:
    """Stream-static lookups that pick up dimension rows which arrive after the fact.

    A batch looks up its own rows and those still waiting after the epoch before, and nothing else, in the dimensions as they
    are now (``lookups`` is called for each batch).  Rows with all keys are settled under the batch's epoch;
    the others are parked there and are looked up again by the next batch.  No row is dropped:
    :func:`late_table` has the settled rows of all epochs and the rows that still wait, with NULL keys.
    For a bridge, the fact is one of the lookups and ``late_table(..., waiting=False)`` is the inner join.
    """
    def body(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        tables = list(lookups(spark))
        parked = _waiting(spark, root, epoch)
        rows = batch if parked is None else batch.unionByName(parked.select(*batch.columns))
        found = lookup_keys(rows, tables).withColumn(OPEN, _unresolved(tables))
        found.write.mode("overwrite").partitionBy(OPEN).parquet(f"{root}/{EPOCH}={epoch}")
    return body


def retry_waiting(spark: SparkSession, root: str, lookups: Lookups) -> None:
    """Look up the waiting rows again without a new batch (dimension rows came, facts did not): the last epoch is rewritten
    with what is settled by now."""
    epochs = _folders(spark, root, EPOCH)
    parked = _waiting(spark, root)
    if parked is None:
        return
    tables = list(lookups(spark))
    path = f"{root}/{EPOCH}={epochs[-1]}"
    again = lookup_keys(parked.drop(*[lk.sk for lk in tables]), tables).withColumn(OPEN, _unresolved(tables))
    settled = spark.read.parquet(path).where(~F.col(OPEN))
    aside = scratch_dir(spark, "settled")
    settled.unionByName(again).write.parquet(aside)
    spark.read.parquet(aside).write.mode("overwrite").partitionBy(OPEN).parquet(path)


def late_table(spark: SparkSession, root: str, waiting: bool = True) -> DataFrame:
    """Settled rows, and with ``waiting`` those that still wait."""
    rows = spark.read.parquet(root)
    last = _folders(spark, root, EPOCH)[-1]
    mine = ~F.col(OPEN)
    if waiting:
        mine = mine | (F.col(EPOCH) == last)
    return rows.where(mine).drop(EPOCH, OPEN)
