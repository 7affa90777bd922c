"""Mixing sources to target weights: hierarchical budgeting over a domain - language - source tree.

A token budget goes down the tree.  At each node it is parted among the children by their weights; a
child that holds less than its part (its tokens times the greatest number of epochs) takes what it holds,
and its shortage goes to its siblings.  Because a node never asks for more than its subtree holds,
a shortage leaves a family only when all siblings are full, and then reaches the parent's siblings.  All
arithmetic is whole tokens (decimals), rounded down at each parting.

Each leaf then takes the prefix of its token stream: epoch after epoch, each epoch in its own seeded
order (a digest of seed, epoch and id).  The document at the end is cut to the tokens that are left.
Offsets come from sums over digest ranges of a leaf (about the square root of its documents) and
sums within a range, so that no task holds a leaf, however large its source.

Defined results: null levels are the level ``unknown``; null and blank texts have no tokens and are
never chosen; weights not given are 1, a weight of 0 takes nothing; rows with equal ids that differ in any
column are rows of their own, those equal in all are chosen each as often as the plan says, their order in the stream
arbitrary; an empty table chooses nothing; very long texts are counted and cut in one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import NOT_BLANK, cut, free_name, q

LEVELS = ("domain", "lang", "source")
UNKNOWN = "unknown"
_DEC = "decimal(38,0)"


def domain_of_source(source: Column, domains: int = 4) -> Column:
    """The domain of a source: its number modulo ``domains`` (``domain0``, ...); other names are ``unknown``."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("int"), F.lit(domains)).cast("string"))).otherwise(UNKNOWN)


def token_count(text: Column) -> Column:
    """Words between blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)), F.lit(0)).cast("bigint")


def _weight(column: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(column == name, F.lit(int(w))).otherwise(out)
    return out.cast(_DEC)


def part(nodes: DataFrame, parent: Sequence[str], node: str) -> DataFrame:
    """``nodes`` (with budget of the parent, capacity and weight) with ``share``: water-filling within each family.
    Children are taken by rising capacity for their weight; those filled at what is left for them are a
    prefix of that order."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight").cast("double")).otherwise(F.lit(float("inf")))
    order = family.orderBy(ratio, node)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(_DEC)
    total = F.sum("weight").over(family)
    held, weighed = F.coalesce(F.sum("capacity").over(before), zero), F.coalesce(F.sum("weight").over(before), zero)
    staged = nodes.withColumn("_left", (F.col("budget") - held).cast(_DEC)).withColumn("_weights", (total - weighed).cast(_DEC))
    full = (F.col("weight") > 0) & (F.col("capacity") * F.col("_weights") <= F.col("weight") * F.col("_left"))
    staged = staged.withColumn("_full", full)
    # what is left for the children that are not filled, and their weights: the same for all of them
    rest = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(family), zero)).cast(_DEC)
    weights = (total - F.coalesce(F.sum(F.when(F.col("_full"), F.col("weight"))).over(family), zero)).cast(_DEC)
    product = (F.col("weight") * rest).cast(_DEC)
    share = F.when(F.col("_full"), F.col("capacity")).when(F.col("weight") > 0, ((product - product % weights) / weights).cast(_DEC)).otherwise(zero)
    return staged.withColumn("share", F.greatest(zero, share).cast(_DEC)).drop("_left", "_weights", "_full")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int,
            max_epochs: int) -> DataFrame:
    """``leaves`` (level columns, tokens) with ``target``: the tokens each leaf gives.  A weight of 0 takes a subtree's
    capacity away, so its share goes to the others."""
    base = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast(_DEC))
    for level in levels:
        base = base.withColumn("capacity", F.when(_weight(F.col(level), weights.get(level, {})) > 0, F.col("capacity")).otherwise(F.lit(0).cast(_DEC)))
    given = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = base.groupBy(*path).agg(F.sum("capacity").cast(_DEC).alias("capacity")).withColumn("weight", _weight(F.col(level), weights.get(level, {})))
        if given is None:
            whole = F.sum("capacity").over(Window.partitionBy(F.lit(0)))  # one row per node of the first level
            nodes = nodes.withColumn("budget", F.least(F.lit(int(budget)).cast(_DEC), whole.cast(_DEC)))
        else:
            nodes = nodes.join(given, path[:-1])
        given = part(nodes, path[:-1], level).select(*path, F.col("share").alias("budget"))
    return base.join(given, list(levels)).withColumn("target", F.least("budget", "capacity").cast("bigint")).drop("capacity", "budget")


def _digest(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits of a digest, the same in any SQL engine."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def plan(docs: DataFrame, *, weights: Mapping[str, Mapping[str, int]], budget: int | None = None, budget_share: float = 1.0,
         max_epochs: int = 3, seed: int = 42, doc_id: str = "doc_id", text: str = "text", levels: Mapping[str, Column] | None = None,
         keep_key: Column | None = None) -> DataFrame:
    """The selection: a row per document and epoch chosen: doc_id, the levels, epoch, tokens, stream_start (tokens of
    the leaf's stream before it) and tokens_taken.  ``budget`` defaults to ``budget_share`` of all tokens."""
    levels = levels or {"domain": domain_of_source(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    names = list(levels)
    key = [] if keep_key is None else [keep_key.alias("row_key")]
    counted = cut(docs.select(F.col(q(doc_id)).alias("doc_id"), *[F.coalesce(c.cast("string"), F.lit(UNKNOWN)).alias(n) for n, c in levels.items()],
                              token_count(F.col(q(text))).alias("tokens"), *key).where("tokens > 0"))
    leaves = counted.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    if budget is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total * budget_share)
    targets = cut(budgets(leaves, names, weights, budget, max_epochs).withColumnRenamed("tokens", "leaf_tokens").where("target > 0"))
    # the epochs a leaf needs; the last one may end early
    need = F.ceil(F.col("target") / F.col("leaf_tokens")).cast("int")
    ranges = F.greatest(F.lit(1), F.ceil(F.sqrt("docs")).cast("bigint"))
    rows = counted.join(targets.select(*names, "leaf_tokens", "target", "docs"), names) \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), need - 1))) \
        .withColumn("digest", _digest(seed, F.col("epoch"), F.col("doc_id"))) \
        .withColumn("range", (F.col("digest") / F.lit(float(1 << 60)) * ranges).cast("bigint"))
    # dealt by range: else the windows below would stay in the join's partitions, a whole leaf in each
    rows = rows.repartition(*names, "epoch", "range")
    by_range = rows.groupBy(*names, "epoch", "range").agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy(*names, "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = by_range.select(*names, "epoch", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*names, "epoch", "range").orderBy("digest", "doc_id", *(["row_key"] if key else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(by_range, [*names, "epoch", "range"]) \
        .withColumn("stream_start", F.col("epoch") * F.col("leaf_tokens") + F.col("before") + F.col("inside"))
    taken = F.least(F.col("tokens"), F.col("target") - F.col("stream_start"))
    return placed.where(F.col("stream_start") < F.col("target")) \
        .select("doc_id", *names, "epoch", "tokens", "stream_start", taken.alias("tokens_taken"), *(["row_key"] if key else []))


def _row_key(docs: DataFrame) -> Column:
    """A digest of all columns, each with its length, so that no value can pass for another or for two."""
    parts = []
    for f in docs.schema.fields:
        value = F.hex(F.col(q(f.name))) if f.dataType.typeName() == "binary" else F.col(q(f.name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def mixed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` as the plan chooses them: a document as often as it was chosen, the last of a leaf cut to the tokens
    taken of it (with the blanks before them)."""
    digest = _row_key(docs)
    chosen = plan(docs, doc_id=doc_id, text=text, keep_key=digest, **options)
    key, took, has = (free_name(docs.columns, n) for n in ("row_key", "took", "has"))
    # fully equal rows share a key and so are each as many times in the plan: one of each stands for its like
    chosen = chosen.select(F.col("row_key").alias(key), F.col("tokens_taken").alias(took), F.col("tokens").alias(has))
    body = F.col(q(text))
    head = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(f"[ \\t-\\r]*{NOT_BLANK}"), F.lit(0)), F.lit(1), F.col(q(took)).cast("int")), "")
    rows = docs.withColumn(key, digest).dropDuplicates([key]).join(chosen, key)
    return rows.withColumn(text, F.when(F.col(q(took)) < F.col(q(has)), head).otherwise(body)).select(*[F.col(q(c)) for c in docs.columns])
