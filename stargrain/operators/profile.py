"""Field summary / profile, field info and schema comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _numeric(type_name: str) -> bool:
    return type_name in ("tinyint", "smallint", "int", "bigint", "float", "double") or type_name.startswith("decimal")


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column — ordinal, name, type, rows, NULLs, blanks,
    distinct values, min/max text length, min/max of numeric columns.

    One aggregate over the data (partial aggregation, one output row), then
    ``inline`` to one row per column.  Distinct values are estimated in that
    pass (``approx_count_distinct``); ``exact=True`` counts them, which costs
    a row per column and value before the shuffle.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        s = col.cast("string")
        aggs += [
            F.count_if(col.isNull()).alias(f"nn{i}"),
            F.count_if(F.trim(s) == "").alias(f"nb{i}") if types[c] == "string" else F.lit(0).cast("bigint").alias(f"nb{i}"),
            (F.count_distinct(col) if exact else F.approx_count_distinct(col)).alias(f"nd{i}"),
            F.min(F.length(col)).alias(f"lo{i}") if types[c] == "string" else F.lit(None).cast("int").alias(f"lo{i}"),
            F.max(F.length(col)).alias(f"hi{i}") if types[c] == "string" else F.lit(None).cast("int").alias(f"hi{i}"),
            F.min(col).cast("double").alias(f"mn{i}") if _numeric(types[c]) else F.lit(None).cast("double").alias(f"mn{i}"),
            F.max(col).cast("double").alias(f"mx{i}") if _numeric(types[c]) else F.lit(None).cast("double").alias(f"mx{i}"),
        ]
    stats = df.agg(*aggs)
    rows = [F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"),
                     F.lit(types[c]).alias("data_type"), F.col("n_rows").alias("n_rows"),
                     F.col(f"nn{i}").alias("n_nulls"), F.col(f"nb{i}").alias("n_blank"),
                     F.col(f"nd{i}").alias("n_distinct"), F.col(f"lo{i}").alias("min_len"),
                     F.col(f"hi{i}").alias("max_len"), F.col(f"mn{i}").alias("min_value"),
                     F.col(f"mx{i}").alias("max_value"))
            for i, c in enumerate(cols)]
    return stats.select(F.inline(F.array(*rows)))


def value_pattern(c) -> F.Column:
    """A15 pattern: digits -> 9, ASCII letters -> A, everything else kept."""
    col = c if isinstance(c, F.Column) else F.col(f"`{c}`")
    return F.regexp_replace(F.regexp_replace(col.cast("string"), "[0-9]", "9"), "[A-Za-z]", "A")


def pattern_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, pattern, n)`` — count of each value shape per column.

    The columns are unpivoted (narrow) and grouped on (column, pattern); the
    partial aggregate collapses repeated shapes before the shuffle.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), value_pattern(c).alias("pattern")) for c in cols
    ])).alias("p")).select("p.*")
    return long.groupBy("column_name", "pattern").agg(F.count(F.lit(1)).alias("n"))


def outlier_counts(df: DataFrame, cols: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """A15 outliers: values outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` per column.

    Quartiles from ``percentile_approx`` (bounded-memory sketch, combined
    map-side); then one more pass counts the values outside the fences.
    """
    q = df.agg(*[F.percentile_approx(F.col(f"`{c}`"), [0.25, 0.75], accuracy).alias(f"q{i}")
                 for i, c in enumerate(cols)])
    # one scalar subquery holds all fences
    fences = q.select(F.array(*[F.struct((F.col(f"q{i}")[0] - 1.5 * (F.col(f"q{i}")[1] - F.col(f"q{i}")[0])).cast("double").alias("lo"),
                                         (F.col(f"q{i}")[1] + 1.5 * (F.col(f"q{i}")[1] - F.col(f"q{i}")[0])).cast("double").alias("hi"))
                                for i in range(len(cols))])).scalar()
    held = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)]).withColumn("f", fences)
    rows = [F.struct(F.lit(c).alias("column_name"), F.first(F.get(F.col("f"), F.lit(i))["lo"]).alias("lower_fence"),
                     F.first(F.get(F.col("f"), F.lit(i))["hi"]).alias("upper_fence"),
                     F.count_if((F.col(f"v{i}") < F.get(F.col("f"), F.lit(i))["lo"]) | (F.col(f"v{i}") > F.get(F.col("f"), F.lit(i))["hi"])).alias("n_outliers"))
            for i, c in enumerate(cols)]
    return held.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def field_info(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """A14 Field Info: ``(ordinal, name, type, nullable)`` from the schema (metadata only)."""
    return [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]


def compare_schemas(a: DataFrame, b: DataFrame) -> list[tuple[str, str | None, str | None, str]]:
    """A15 cross-dataset schema comparison: per column name its type on each
    side and a status ``same`` / ``type_differs`` / ``only_left`` / ``only_right``."""
    ta = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    tb = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    out = []
    for name in list(ta) + [n for n in tb if n not in ta]:
        x, y = ta.get(name), tb.get(name)
        status = "only_right" if x is None else "only_left" if y is None else "same" if x == y else "type_differs"
        out.append((name, x, y, status))
    return out
