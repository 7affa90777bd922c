"""Dimension builders (§2.13): calendar and hash-keyed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions.keys import date_key, surrogate_key
from stargrain.operators.rows import unique_first


def calendar_dates(df: DataFrame, start: Column, end: Column, name: str = "full_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` (aggregates over ``df``).

    The day list is generated from a one-row aggregate; its length is the
    number of days in the range (thousands), independent of the row count.
    """
    bounds = df.agg(F.to_date(start).alias("_s"), F.to_date(end).alias("_e"))
    return bounds.select(F.explode(F.sequence("_s", "_e", F.expr("interval 1 day"))).alias(name))


def calendar_dimension(days: DataFrame, d: str = "full_date") -> DataFrame:
    """The 21 calendar attributes of ``dim_date``."""
    c = F.col(d)
    month = F.month(c)
    dow = F.dayofweek(c)
    return days.select(
        date_key(c).alias("date_key"),
        c.alias("full_date"),
        F.year(c).alias("year"),
        F.date_format(c, "yyyy").alias("year_name"),
        F.quarter(c).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(c)).alias("quarter_name"),
        F.concat(F.year(c), F.lit("-Q"), F.quarter(c)).alias("year_quarter"),
        month.alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.date_format(c, "MMM").alias("month_name_short"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        F.dayofmonth(c).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_of_week_name"),
        F.date_format(c, "EEE").alias("day_of_week_short"),
        F.weekofyear(c).alias("week_of_year"),
        F.ceil(F.dayofmonth(c) / 7).cast("int").alias("week_of_month"),
        dow.isin(1, 7).alias("is_weekend"),
        dow.isin(2, 3, 4, 5, 6).alias("is_weekday"),
        F.when(month >= 10, F.year(c) + 1).otherwise(F.year(c)).alias("fiscal_year"),
        F.when(month.isin(10, 11, 12), 1).when(month.isin(1, 2, 3), 2)
         .when(month.isin(4, 5, 6), 3).otherwise(4).alias("fiscal_quarter"),
    )


def hash_dimension(df: DataFrame, *, attrs: dict[str, Column | str], not_null: Sequence[str],
                   bk_name: str, bk: Column, sk_name: str, derive: dict[str, Column] | None = None,
                   select: Sequence[str] | None = None, keep_first_by: Sequence[str] | None = None,
                   sk_method: str = "md5_60") -> DataFrame:
    """The shared shape of the hash dimensions:

    select attributes -> filter NOT NULL -> business key -> one row per key ->
    surrogate key -> derived attributes -> final column list.

    One row per key is :func:`unique_first` (smallest attribute tuple, or
    ``keep_first_by``), so a rebuild gives the same row every time.
    """
    cols = [(v if isinstance(v, Column) else F.col(v)).alias(k) for k, v in attrs.items()]
    out = df.select(*cols)
    for c in not_null:
        out = out.where(F.col(c).isNotNull())
    out = out.withColumn(bk_name, bk)
    out = unique_first(out, [bk_name], keep_first_by)
    out = out.withColumn(sk_name, surrogate_key(F.col(bk_name), sk_method))
    for k, v in (derive or {}).items():
        out = out.withColumn(k, v)
    return out.select(*(select or [sk_name, bk_name, *attrs.keys(), *(derive or {}).keys()]))
