"""Declarative data-quality expectations.

A rule is a SQL predicate with an action:

* ``warn``  — counted, rows kept (``expect_all``);
* ``drop``  — counted, failing rows removed (``expect_or_drop``);
* ``fail``  — counted; :func:`enforce` raises when any row fails.

A predicate that evaluates to NULL counts as failed (a filter keeps only
TRUE).  Every rule is counted on the full input, not on the survivors of
earlier rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"  # warn | drop | fail

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _drop_rules(rules: Sequence[Expectation]) -> list[Expectation]:
    return [r for r in rules if r.action == "drop"]


def kept(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows that pass every ``drop`` rule (works on streams too).

    The raw predicates are used: a filter keeps only TRUE, which is the same
    as ``coalesce(p, false)`` but leaves the predicates pushable to the scan.
    """
    out = df
    for r in _drop_rules(rules):
        out = out.where(F.expr(r.predicate))
    return out


def quarantine(df: DataFrame, rules: Sequence[Expectation], col: str = "failed_rules") -> DataFrame:
    """Rows failing at least one ``drop`` rule, with the failed rule names
    joined by ``|`` (in rule order)."""
    names = F.concat_ws("|", *[F.when(~r.passes(), F.lit(r.name)) for r in _drop_rules(rules)])
    return df.withColumn(col, names).where(F.col(col) != "")


def metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """``(rule, action, passed, failed)`` — one aggregate pass, one row per rule."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(~r.passes()).alias(f"_f{i}") for i, r in enumerate(rules)]
    stats = df.agg(*aggs)
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                     (F.col("_n") - F.col(f"_f{i}")).alias("passed"), F.col(f"_f{i}").alias("failed"))
            for i, r in enumerate(rules)]
    return stats.select(F.inline(F.array(*rows)))


def observed(df: DataFrame, rules: Sequence[Expectation], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """E1 in batch or stream: attach failure counters to ``df`` without an extra
    pass.  Batch: read ``obs.get`` after an action; stream:
    ``query.lastProgress['observedMetrics'][name]``."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(~r.passes()).alias(r.name) for r in rules]
    return df.observe(obs, *exprs), obs


def observe_stream(df: DataFrame, rules: Sequence[Expectation], name: str = "expectations") -> DataFrame:
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(~r.passes()).alias(r.name) for r in rules]
    return df.observe(name, *exprs)


def enforce(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """``fail`` rules: raise if any row fails; returns ``df`` otherwise."""
    hard = [r for r in rules if r.action == "fail"]
    if hard:
        m = metrics(df, hard).where(F.col("failed") > 0).select("rule").limit(len(hard)).collect()
        if m:
            raise ValueError(f"expectations failed: {[r['rule'] for r in m]}")
    return df


def apply_expectations(df: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(kept, quarantine, metrics)`` for a batch DataFrame."""
    return kept(df, rules), quarantine(df, rules), metrics(df, rules)
