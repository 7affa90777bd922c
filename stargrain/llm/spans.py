"""Spans of pattern matches in DataFrame functions: positions in code points, context, order and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stargrain.llm.common import let, prefix_sums

NONE = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def found(text: Column, pattern: str, context: int = 0, sign: str = "") -> Column:
    """Leftmost non-overlapping matches of a Java pattern that never matches the empty text:
    ``array<struct<start, end, value, before, after>>``, with up to ``context`` code points on either
    side (no further than the neighbouring match).  Texts without a match cost one search, and those without
    ``sign`` (a text that every match holds) less."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(s: Column) -> Column:
        lengths = F.zip_with(F.slice(s["gaps"], 1, F.size(s["values"])), s["values"], lambda g, v: F.length(g) + F.length(v))

        def structs(t: Column) -> Column:
            def one(v: Column, i: Column) -> Column:
                start = F.get(t["sums"], i) + F.length(F.get(t["gaps"], i))
                left, right = F.get(t["gaps"], i), F.get(t["gaps"], i + 1)
                return F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value"),
                                (F.right(left, F.lit(context)) if context else F.lit("")).alias("before"),
                                (F.left(right, F.lit(context)) if context else F.lit("")).alias("after"))
            return F.transform(t["values"], one)

        return let(F.struct(s["values"].alias("values"), s["gaps"].alias("gaps"), prefix_sums(lengths).alias("sums")), structs)

    whole = let(F.struct(values.alias("values"), F.split(text, pattern, -1).alias("gaps")), placed)
    some = text.contains(sign) & text.rlike(pattern) if sign else text.rlike(pattern)
    return F.when(some, whole).otherwise(F.array().cast(NONE))


def labelled(kind: str, order: int, spans: Column) -> Column:
    """``array<struct<start, order, label>>`` with labels ``kind:start:end``."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"),
        F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label")))


def joined(labels: Sequence[Column], by_kind: bool) -> Column:
    """All labels comma-joined: by start and then kind, or by kind and then start."""
    every = F.concat(*labels)
    if by_kind:
        every = F.transform(every, lambda s: F.struct(s["order"].alias("order"), s["start"].alias("start"), s["label"].alias("label")))
    return F.array_join(F.transform(F.array_sort(every), lambda s: s["label"]), ",")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function, to about 1e-7 (a rational approximation with the density as factor)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * series
    return F.when(z < 0, tail).otherwise(1 - tail)
