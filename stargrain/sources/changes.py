"""Change feed without a table format.

A change row is an ordinary row plus ``_change_type`` (insert,
update_preimage, update_postimage, delete), ``_commit_version`` and
``_commit_timestamp``.  :func:`diff_snapshots` derives the change rows
between two snapshots; :func:`read_changes` reads them back from an
append-only change log in batch or as a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGE_TYPE, COMMIT_VERSION, COMMIT_TS = "_change_type", "_commit_version", "_commit_timestamp"


def diff_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str], *, version: int,
                   commit_ts=None, compare: Sequence[str] | None = None, repeats: str = "error") -> DataFrame:
    """Change rows turning snapshot ``old`` into ``new``.

    A snapshot has one row per key: a repeated key stops the job, or with
    ``repeats="least"`` its least row stands for it.

    One full outer join on the keys (a snapshot has one row per key, so the
    join never multiplies rows); an update yields a pre- and a post-image,
    emitted with ``inline`` from the joined row (narrow).
    """
    keys = list(keys)
    vals = [c for c in new.columns if c not in keys]
    comp = list(compare) if compare is not None else vals
    # at most one row per key and side (a dirty snapshot with repeated keys must
    # not pair every old row with every new row); the aggregate leaves both
    # sides hash-partitioned by the keys, so the join adds no exchange
    if repeats not in ("error", "least"):
        raise ValueError("repeats is 'error' or 'least'")

    def one(name: str):
        least = F.min(F.struct(*vals))
        if repeats == "least":
            return least.alias(name)
        return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"diff_snapshots: a key of {keys} is repeated"))).otherwise(least).alias(name)

    o = old.groupBy(*keys).agg(one("_o")).withColumn("_oc", F.struct(
        *[F.col(f"_o.{c}").alias(c) for c in comp]))
    n = new.groupBy(*keys).agg(one("_n")).withColumn("_nc", F.struct(
        *[F.col(f"_n.{c}").alias(c) for c in comp]))
    j = o.join(n, keys, "full_outer")
    kind = (F.when(F.col("_o").isNull(), "insert").when(F.col("_n").isNull(), "delete")
            .when(~F.col("_oc").eqNullSafe(F.col("_nc")), "update").otherwise(None))
    j = j.withColumn("_k", kind).where(F.col("_k").isNotNull())
    img = F.array(
        F.struct(F.lit("update_preimage").alias("t"), F.col("_o").alias("v")),
        F.struct(F.lit("update_postimage").alias("t"), F.col("_n").alias("v")),
    )
    alone = F.array(F.struct(F.when(F.col("_k") == "insert", "insert").otherwise("delete").alias("t"),
                           F.coalesce(F.col("_n"), F.col("_o")).alias("v")))
    rows = j.select(*keys, F.explode(F.when(F.col("_k") == "update", img).otherwise(alone)).alias("_r"))
    ts = F.lit(commit_ts).cast("timestamp") if commit_ts is not None else F.current_timestamp()
    return rows.select(*keys, *[F.col(f"_r.v.{c}").alias(c) for c in vals],
                       F.col("_r.t").alias(CHANGE_TYPE), F.lit(version).cast("bigint").alias(COMMIT_VERSION),
                       ts.alias(COMMIT_TS))


def read_changes(changes: DataFrame, since_version: int | None = None,
                 types: Sequence[str] | None = None) -> DataFrame:
    """S10 ``readChangeFeed``: change rows from ``since_version`` on, of ``types``."""
    out = changes
    if since_version is not None:
        out = out.where(F.col(COMMIT_VERSION) >= since_version)
    if types:
        out = out.where(F.col(CHANGE_TYPE).isin(*types))
    return out


def stream_changes(spark: SparkSession, path: str, schema, since_version: int | None = None,
                   types: Sequence[str] | None = None) -> DataFrame:
    """S10 as a stream over the append-only change-log directory."""
    return read_changes(spark.readStream.schema(schema).parquet(path), since_version, types)


def apply_changes_snapshot(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest image per key after all commits (deletes removed): the inverse of
    :func:`diff_snapshots`; the last commit per key is picked by a ``max``
    aggregate (combined map-side)."""
    keys = list(keys)
    vals = [c for c in changes.columns if c not in keys and c not in (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TS)]
    rank = F.when(F.col(CHANGE_TYPE) == "update_preimage", 0).otherwise(1)
    last = changes.where(F.col(CHANGE_TYPE) != "update_preimage").groupBy(*keys).agg(
        F.max(F.struct(F.col(COMMIT_VERSION), rank.alias("_r"), F.col(CHANGE_TYPE).alias("_t"),
                       *[F.col(c) for c in vals])).alias("_l"))
    return last.where(F.col("_l._t") != "delete").select(*keys, *[F.col(f"_l.{c}").alias(c) for c in vals])
