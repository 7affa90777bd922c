"""Row selection per key: keep-first, distinct keys, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unique_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """A5 Unique: keep the first row of every key.

    "First" is the smallest ``(order..., remaining columns...)`` tuple, so the
    result is deterministic even when ``order`` has ties.  ``row_number() = 1`` is
    trimmed before the shuffle as well (a group limit of one row per key and
    map task), so a hot key never gathers its rows in one task.  ``carried`` names columns that the others decide
    (rows equal in those are equal in these): they are not compared, so that a plan that does not use them need not sort them.
    """
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order and c not in carried]
    if not order and not rest:
        return df.select(*keys).distinct()
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(f"`{c}`") for c in [*order, *rest]])
    return df.withColumn("_sg_first", F.row_number().over(w)).where("_sg_first = 1").drop("_sg_first")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A4: Summarize with only GroupBy fields."""
    return df.select(*keys).distinct()


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """The keys that more than one row has (a primary-key check: empty if all is well)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def with_total(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """W3 ``COUNT(*) OVER ()``: the row count on every row.

    A scalar subquery — Spark evaluates it once and inlines the value; no
    single-partition window and no join.
    """
    total = df.select(F.count(F.lit(1)).alias(name))
    return df.withColumn(name, total.scalar())


def global_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame."""
    return df.select(F.count(F.lit(1)).alias(name))
