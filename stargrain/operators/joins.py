"""Join helpers (J1-J5): semi-joins and key lookups.

No side is broadcast by hand: adaptive execution broadcasts a side once its
materialised size is known to be below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and shuffles both sides otherwise, whatever the row counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep left rows whose key exists on the right; left columns only."""
    return left.join(right.select(*keys), list(keys), "left_semi")


def key_side(dim: DataFrame, bk: str, sk: str) -> DataFrame:
    """A dimension reduced to one (business key, surrogate key) per business key,
    so that a lookup never multiplies facts."""
    return dim.groupBy(bk).agg(F.min(sk).alias(sk))


def lookup_key(fact: DataFrame, dim: DataFrame, bk: str, sk: str, *, how: str = "left") -> DataFrame:
    """Add the surrogate key ``sk`` of ``dim`` to ``fact`` by business key ``bk``."""
    return fact.join(key_side(dim, bk, sk), bk, how)
