"""Grouped summaries and their join-back."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stargrain.functions.text import ColLike, _c


def _over(agg: Column, window: WindowSpec | None) -> Column:
    return agg if window is None else agg.over(window)


def concat_agg(c: ColLike, sep: str = "|", order_by: Sequence[ColLike] | None = None, over: WindowSpec | None = None) -> Column:
    """Concat summary: values joined by ``sep`` in ``order_by`` order.

    Built on ``collect_list`` (combined map-side) + ``array_sort`` of
    ``(order, value)`` structs, so the order is explicit and stable.
    The output of one group is as long as the group, and so is its array in one
    task: it is meant for naturally small groups (violations of one inspection,
    lines of one order); :func:`concat_by` is for the others.  ``over``: of a window's rows instead of a group's.
    """
    v = _c(c).cast("string")
    if not order_by:
        return F.array_join(F.array_sort(_over(F.collect_list(v), over)), sep)
    keyed = F.struct(*[_c(o).alias(f"k{i}") for i, o in enumerate(order_by)], v.alias("v"))
    return F.array_join(F.transform(F.array_sort(_over(F.collect_list(keyed), over)), lambda x: x["v"]), sep)


def concat_by(df: DataFrame, by: Sequence[str], concats: Mapping[str, tuple[str, str]], order_by: Sequence[str],
              parts: int | None = None) -> DataFrame:
    """A2 Concat for groups of any size: the columns of ``concat_agg`` (``concats``: output name to (column, separator)), in
    two ordered steps.

    A range exchange by (group, order) cuts a hot group into ordered pieces; each piece is concatenated in
    the task that holds it (``collect_list`` is combined before the second exchange, so a piece moves as one
    row), and the pieces of a group, one row each, are joined in their order.  No task sorts or holds
    a whole group's rows; the group's text itself is one value, as long as the group.  Rows that are equal in
    ``by`` and ``order_by`` are ordered by the concatenated values.
    """
    by, order_by = list(by), list(order_by)
    columns = list(dict.fromkeys(c for c, _ in concats.values()))
    ordering = [*order_by, *[c for c in columns if c not in order_by]]
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in by]
    row = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(ordering)],
                   *[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    pieces = df.repartitionByRange(n, *[F.col(f"`{c}`").asc_nulls_first() for c in [*by, *ordering]]) \
        .groupBy(*keys, F.spark_partition_id().alias("_sg_piece")).agg(F.array_sort(F.collect_list(row)).alias("_sg_rows"))
    # a piece without any value has no text; array_join leaves it out, as it leaves NULL values out
    texts, joined = [], []
    for name, (c, sep) in concats.items():
        values = F.col(f"_sg_rows.v{columns.index(c)}")
        texts.append(F.when(F.exists(values, lambda v: v.isNotNull()), F.array_join(values, sep)).alias(f"_sg_{name}"))
        pieces_of = F.array_sort(F.collect_list(F.struct("_sg_piece", F.col(f"_sg_{name}").alias("text"))))
        joined.append(F.array_join(F.transform(pieces_of, lambda p: p["text"]), sep).alias(name))
    return pieces.select(*keys, "_sg_piece", *texts).groupBy(*keys).agg(*joined)


def mode_agg(c: ColLike, over: WindowSpec | None = None) -> Column:
    """Mode, lowest value on ties.  Spark's ``mode`` keeps a value->count map
    per group and merges partial maps, so its memory is bounded by the
    distinct values of a group, not its rows."""
    return _over(F.mode(_c(c), deterministic=True), over)


def any_true(c: ColLike, over: WindowSpec | None = None) -> Column:
    """Max(bool)."""
    return F.coalesce(_over(F.max(_c(c).cast("boolean")), over), F.lit(False))


def summarize(df: DataFrame, by: Sequence[str], aggs: dict[str, Column], concats: Mapping[str, tuple[str, str]] | None = None,
              order_by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """A1/A2: ``groupBy(by).agg(...)`` with every output aliased.  ``concats`` adds texts for groups that may be hot
    (:func:`concat_by`); both halves have one row per group and are joined NULL-safe."""
    out = df.groupBy(*by).agg(*[col.alias(name) for name, col in aggs.items()])
    if not concats:
        return out
    texts = concat_by(df, by, concats, order_by, parts)
    named = texts.select(*[F.col(f"`{c}`").alias(f"_sg_by{i}") for i, c in enumerate(by)], *concats)
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_sg_by{i}"))
    return out.join(named, same).drop(*[f"_sg_by{i}" for i in range(len(by))])


def attach_summary(df: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join the per-group summary back onto every row of the group.

    The summary has one row per key, so the join never multiplies rows; a
    hot key is split by AQE's skew-join handling (the summary side is the
    small one of that partition).
    """
    return df.join(summary, list(by), "inner")


def summarize_back(df: DataFrame, key: str, by: Sequence[str], aggs: Mapping[str, Column | Callable[[WindowSpec], Column]]) -> DataFrame:
    """A1 and J2 in one pass: the summary by ``by`` (``key`` is one of them), on every row of the same key.

    Equal to ``df.join(summary.select(key, *aggs), key)``: a key with several groups has several summaries, and each of its rows
    meets all of them; rows without a key meet none.  The rows of a group stand beside their summary as one array
    (:func:`concat_agg` holds as much), so ``df`` is computed once and, if it is partitioned by ``key``
    already, not shuffled again.

    Summaries that are all given as functions of a window are computed over windows instead: no row is packed and unpacked,
    and of what is not used afterwards (summaries and columns alike) nothing is computed or carried.
    """
    rest = [c for c in df.columns if c not in by]
    if not any(isinstance(a, Column) for a in aggs.values()):
        return _summaries_over(df.where(F.col(f"`{key}`").isNotNull()), key, by, aggs)
    rows = F.collect_list(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_sg_rows")
    groups = df.where(F.col(f"`{key}`").isNotNull()).groupBy(*[F.col(f"`{c}`") for c in by]).agg(*[c.alias(n) for n, c in aggs.items()], rows)
    if list(by) == [key]:
        return groups.select(*[F.col(f"`{c}`") for c in [*by, *aggs]], F.inline("_sg_rows"))
    every = F.collect_list(F.struct(*aggs)).over(Window.partitionBy(F.col(f"`{key}`")))
    keys = [F.col(f"`{c}`") for c in by]
    rows = groups.select(*keys, "_sg_rows", every.alias("_sg_every")).select(*keys, "_sg_every", F.inline("_sg_rows"))
    return rows.select(*[F.col(f"`{c}`") for c in [*by, *rest]], F.inline("_sg_every"))


def _summaries_over(df: DataFrame, key: str, by: Sequence[str], aggs: Mapping[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    keys = [F.col(f"`{c}`") for c in by]
    group = Window.partitionBy(*keys)
    if list(by) == [key]:
        return df.select("*", *[a(group).alias(n) for n, a in aggs.items()])
    # one row of a group stands for it; a list for each summary, so that one that is not used is not collected
    whole = group.orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = df.select("*", F.row_number().over(group.orderBy(*keys)).alias("_sg_nth"), *[a(whole).alias(f"_sg_of_{n}") for n, a in aggs.items()])
    same_key, first = Window.partitionBy(F.col(f"`{key}`")), F.col("_sg_nth") == 1
    lists = [F.collect_list(F.when(first, F.struct(F.col(f"_sg_of_{n}").alias("v")))).over(same_key).alias(f"_sg_every_{n}") for n in aggs]
    every = found.select(*df.columns, F.count(F.when(first, F.lit(1))).over(same_key).alias("_sg_groups"), *lists)
    each = every.select("*", F.explode(F.sequence(F.lit(0), (F.col("_sg_groups") - 1).cast("int"))).alias("_sg_i"))
    return each.select(*df.columns, *[F.get(f"_sg_every_{n}", F.col("_sg_i"))["v"].alias(n) for n in aggs])


def count_by(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """``COUNT(*) GROUP BY ... ORDER BY COUNT(*) DESC``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), *by)


def having(df: DataFrame, by: Sequence[str], min_count: int, name: str = "n") -> DataFrame:
    """Groups with more than ``min_count`` rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > min_count)
