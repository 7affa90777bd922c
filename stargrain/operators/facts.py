"""Fact and bridge loading (J3-J5, T9, T10) and the batch key repair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.operators.joins import key_side, lookup_key


@dataclass(frozen=True)
class Lookup:
    """One dimension lookup: ``fact.bk -> dim.sk``."""
    dim: DataFrame
    bk: str
    sk: str
    how: str = "left"


def lookup_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add the surrogate keys of several dimensions, best read from their stored tables."""
    out = fact
    for lk in lookups:
        out = lookup_key(out, lk.dim, lk.bk, lk.sk, how=lk.how)
    return out


def refresh_missing_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Batch repair for point-in-time stream-static joins (§4.3-8): facts written
    before their dimension row existed carry NULL keys; look them up again
    and keep existing keys."""
    out = fact
    for lk in lookups:
        side = key_side(lk.dim, lk.bk, lk.sk).withColumnRenamed(lk.sk, "_sg_new")
        out = out.join(side, lk.bk, "left") \
            .withColumn(lk.sk, F.coalesce(F.col(lk.sk), F.col("_sg_new"))).drop("_sg_new")
    return out


def build_bridge(detail: DataFrame, fact: DataFrame, fact_bk: str, fact_sk: str,
                 dim_lookups: Sequence[Lookup]) -> DataFrame:
    """Detail rows -> inner join to the fact (drops details without a
    fact row, J4) -> left lookups of detail dimensions (J5)."""
    out = detail.join(fact.select(fact_bk, fact_sk), fact_bk, "inner")
    return lookup_keys(out, dim_lookups)
