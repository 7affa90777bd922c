"""Data cleanse and AutoField."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions.text import WS

# AutoField candidates, narrowest first.  A type fits a column only if it holds every
# non-NULL value: the cast succeeds and its text stands for the same value.
CANDIDATES = ["boolean", "tinyint", "smallint", "int", "bigint", "double", "date", "timestamp"]
_WHOLE = "^[+-]?(0|[1-9][0-9]{0,18})$"
_NUMBER = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]*)?([eE][+-]?[0-9]{1,3})?$|^[+-]?\.[0-9]+([eE][+-]?[0-9]{1,3})?$"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def cleanse(df: DataFrame, cols: Sequence[str] | None = None, *, collapse: bool = True,
            trim: bool = True, upper: bool = False, blank_as_null: bool = False,
            drop_null_rows: bool = True, drop_null_columns: bool = False) -> DataFrame:
    """R7/R8 Data Cleanse on string columns.

    ``collapse``: tabs, line breaks and runs of blanks -> one blank;
    ``trim``: leading/trailing blanks; ``drop_null_rows``: rows whose
    every column is NULL (or blank) go; ``drop_null_columns``: columns with
    no value at all go — that one needs one aggregate job to decide.
    """
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    targets = set(c for c in (cols or str_cols) if c in str_cols)
    out = df
    if drop_null_rows:
        # Decided on the raw values, before the cleansing projection: a value is
        # blank after cleansing iff it has no non-whitespace character.  One flat
        # expression over raw columns (no deep OR chain, no aliases for the
        # optimizer's constraint propagation to expand on wide rows), which ends at the first value: it reads no
        # more of a row, and a column that is one fixed value spares the test.
        found = [c.rlike(f"[^{WS[1:-1]}]") if name in str_cols else c.isNotNull() for name, c in ((c, F.col(f"`{c}`")) for c in df.columns)]
        out = out.where(F.coalesce(*[F.when(c, F.lit(1)) for c in found]).isNotNull() if found else F.lit(False))
    sel = []
    for c in df.columns:
        v: Column = F.col(f"`{c}`")
        if c in targets:
            if collapse:
                v = F.regexp_replace(v, f"{WS}+", " ")
            if trim:
                v = F.btrim(v, F.lit(" \t\n\r\f\u00a0"))
            if upper:
                v = F.upper(v)
            if blank_as_null:
                v = F.nullif(v, F.lit(""))
            v = v.alias(c)
        sel.append(v)
    out = out.select(*sel)
    if drop_null_columns:
        counts = out.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in out.columns]).first()
        out = out.select(*[F.col(f"`{c}`") for c in out.columns if counts[c] > 0])
    return out


def _classes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(pos, n, lo, hi, longest) per column of ``cols`` (from 0) that has rows: its number of values, the least and greatest
    class of a value, and the characters of the longest.

    A value's class is the index into CANDIDATES of the narrowest type that holds it (len(CANDIDATES) when
    none does).  Leading zeros make a text (``00501`` is a code, not 501); an impossible date is a text;
    whole numbers beyond 64 bits are doubles as long as a double holds them exactly, numbers beyond its range are
    texts.

    The columns are unpivoted, so that one small expression serves all of them: the same tests written out
    for every column make a method too long for the JVM to compile.  The groups are combined before the
    exchange, to one row per column and task.  The first character says which test can hold at all, so that a
    pattern and a cast run only for values that may pass them.
    """
    value = F.col("value")
    rows = df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in cols])).alias("pos", "value")).where(value.isNotNull())
    head = F.substring(value, 1, 1)
    numeric = head.between("0", "9") | head.isin("+", "-", ".")
    whole = F.when(numeric & (F.length(value) <= 20) & value.rlike(_WHOLE), value.try_cast("bigint"))
    rows = rows.select("pos", "value", numeric.alias("numeric"), whole.alias("big"))
    real, big = value.try_cast("double"), F.col("big")
    finite = real.isNotNull() & ~F.isnan(real) & (F.abs(real) < F.lit(float("inf")))
    # digits alone can be too many for a double only beyond 15
    exact = (F.length(value) <= 15) | ~value.rlike("^[+-]?[0-9]+$") | (value.try_cast("decimal(38,0)") == real.try_cast("decimal(38,0)"))
    other = (F.when(value.rlike(_NUMBER) & finite & F.coalesce(exact, F.lit(False)), 5)
              .when((F.length(value) == 10) & value.rlike(_DAY) & value.try_cast("date").isNotNull(), 6)
              .when((F.length(value) > 10) & value.rlike(_MOMENT) & value.try_cast("timestamp_ntz").isNotNull(), 7)
              .otherwise(len(CANDIDATES)))
    kind = (F.when(big.isNotNull(), F.when(big.between(-128, 127), 1).when(big.between(-32768, 32767), 2)
                   .when(big.between(-2147483648, 2147483647), 3).otherwise(4))
             .when(F.col("numeric"), other)
             .when(head.isin("t", "T", "f", "F") & F.lower(value).isin("true", "false"), 0)
             .otherwise(len(CANDIDATES)))
    return rows.select("pos", F.length(value).alias("size"), kind.alias("kind")).groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"), F.min("kind").alias("lo"), F.max("kind").alias("hi"), F.max("size").alias("longest"))


def field_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """R5 decision as a DataFrame: ``(ordinal, column_name, inferred_type, size, n_values)``.

    One aggregate pass.  Each value gets the index of the narrowest candidate
    it fits; the numeric candidates (tinyint .. double) nest, so a column's
    type is the widest class seen when all classes are numeric, the single
    class when all values share it, and string otherwise — the first
    candidate that fits every non-NULL value.  ``size`` is the field size of a text
    column: the characters of its longest value (0 without values); NULL for the others.
    """
    cols = list(cols or df.columns)
    names = F.array(*[F.lit(n) for n in CANDIDATES])
    lo, hi = F.col("lo"), F.col("hi")
    single = ((lo >= 1) & (hi <= 5)) | ((lo == hi) & (hi < len(CANDIDATES)))
    kind = F.when(single, F.get(names, hi)).otherwise(F.lit("string"))  # without values: lo and hi are NULL
    every = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("pos", "column_name"))
    found = every.join(_classes(df, cols), "pos", "left").withColumn("inferred_type", kind)
    return found.select((F.col("pos") + 1).alias("ordinal"), "column_name", "inferred_type",
                        F.when(F.col("inferred_type") == "string", F.coalesce("longest", F.lit(0))).alias("size"),
                        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_values"))


def auto_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """R5 for a flow that goes on as text: columns whose values are all numbers are written in
    plain form (``+7`` as ``7``, ``60614.0`` as ``60614``).  The decision is a scalar subquery, so no job
    runs while the plan is built."""
    numeric = (F.col("lo") >= 1) & (F.col("hi") <= 5)
    decided = _classes(df, cols).where(numeric).agg(F.collect_list("pos")).scalar()

    def plain(i: int, c: Column) -> Column:
        return F.when(F.array_contains(decided, F.lit(i)), F.regexp_replace(c, r"^[+]|\.0*$", "")).otherwise(c)

    return df.withColumns({c: plain(i, F.col(f"`{c}`").cast("string")) for i, c in enumerate(cols)})


def auto_field(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """R5 AutoField: cast each column to its narrowest fitting type.

    Needs the decision before it can build the typed plan: runs the one-row
    aggregate of :func:`field_types` and returns ``(typed_df, types)``.
    """
    decided = {r["column_name"]: r["inferred_type"] for r in field_types(df, cols).collect()}
    return df.withColumns({c: typed_value(F.col(f"`{c}`"), t) for c, t in decided.items() if t != "string"}), decided


def typed_value(c: Column, t: str) -> Column:
    """A text value as its column's decided type."""
    v = c.cast("string")
    return (F.lower(v) == "true") if t == "boolean" else v.try_cast("timestamp_ntz" if t == "timestamp" else t)
