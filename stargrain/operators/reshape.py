"""Reshaping operators (R1-R4, R6, P1-P5, O4-O5).  All narrow except
``cross_tab`` (a grouped aggregate)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_map(df: DataFrame, mapping: dict[str, str], keep_unknown: bool = False,
               drop: Sequence[str] = ()) -> DataFrame:
    """P1-P4 Select tool: keep + rename ``mapping`` (in its order); with
    ``keep_unknown`` the other columns follow unchanged, minus ``drop``."""
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()]
    if keep_unknown:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in mapping and c not in drop]
    return df.select(*cols)


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def split_to_rows(df: DataFrame, col: str, sep: str, pos: str | None = None, keep_empty_input: bool = True,
                  out: str | None = None) -> DataFrame:
    """R1 Text to rows: one row per piece of ``col`` split on the literal ``sep``.

    ``pos`` (1-based piece number) keeps the order of the pieces, which later
    keep-first / sequence steps need.  NULL input keeps one row with a NULL
    piece (``explode_outer``).
    """
    out = out or col
    parts = F.split(F.col(col), re.escape(sep), -1)
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    gen = F.posexplode_outer(parts) if keep_empty_input else F.posexplode(parts)
    exploded = df.select(*others, gen.alias("_sg_pos", out))
    if pos:
        exploded = exploded.withColumn(pos, (F.col("_sg_pos") + 1).cast("int"))
    return exploded.drop("_sg_pos")


def regex_parse(df: DataFrame, col: str, pattern: str, names: Sequence[str],
                ignore_case: bool = False, max_len: int | None = None) -> DataFrame:
    """R6 RegEx Parse: one output column per capture group; no match -> NULLs.

    The groups come out of a generator (one row each): a filter on them is not pushed below it, where the optimizer would
    write the pattern out, and match it, once for every use of a group.
    """
    pat = f"(?i){pattern}" if ignore_case else pattern
    found = [f"_sg_group{i}" for i in range(1, len(names) + 1)]
    groups = F.struct(*[F.regexp_extract(F.col(f"`{col}`"), pat, i).alias(g) for i, g in enumerate(found, start=1)])
    values = {n: F.when(F.col(g) != "", F.substring(g, 1, max_len) if max_len else F.col(g)) for n, g in zip(names, found)}
    return df.select("*", F.inline(F.array(groups))).withColumns(values).drop(*found)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "Name",
            value: str = "Value") -> DataFrame:
    """R2 Transpose: data columns -> (name, value) rows.  Values share one type."""
    return df.unpivot(list(ids), list(values), name, value)


def header_name(c: Column) -> Column:
    """R3 CrossTab header rule: blanks in the header value become ``_``."""
    return F.regexp_replace(c, r"\s", "_")


NULL_HEADER = "null"


def cross_tab(df: DataFrame, keys: Sequence[str], header: str, value: str, values: Sequence | None = None,
              agg: str = "first", most: int = 10_000) -> DataFrame:
    """R3 CrossTab: one column per header value.

    One grouped aggregate with a conditional aggregate per header value (one
    shuffle; fixed-width buffers stay in the hash aggregate).  ``first`` takes
    the first non-NULL value — deterministic only when (keys, header) is
    unique; other methods: ``sum``, ``max``, ``min``, ``count``, ``concat``.
    Without ``values`` the header values are found by a distinct query; they
    become columns, and more than ``most`` of them are an error (the driver gets one more
    at most).  Rows with a NULL header go to a column named ``null`` (None in ``values``).
    """
    if values is None:
        found = [r[0] for r in df.select(header).distinct().limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"cross_tab: {header!r} has more than {most} values; give them as values")
        values = sorted(v for v in found if v is not None) + ([None] if None in found else [])
    h, v = F.col(header), F.col(value)

    def pick(x):
        c = F.when(h.isNull() if x is None else h == F.lit(x), v)
        if agg == "first":
            return F.first(c, ignorenulls=True)
        if agg == "concat":
            return F.array_join(F.array_sort(F.collect_list(c.cast("string"))), ",")
        return {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[agg](c)

    return df.groupBy(*keys).agg(*[pick(x).alias(NULL_HEADER if x is None else str(x)) for x in values])


def packed_slots(df: DataFrame, slots: Sequence[dict[str, Column | str]], slot_col: str = "slot", drop_empty: bool = True) -> Column:
    """The first half of :func:`slots_to_rows`: the groups of a row as one array, to be carried in place of their columns.

    ``slots[i]`` maps field name -> column for slot ``i + 1``.  Every slot is
    cast to the type of the first slot's fields, because ``inline`` needs one
    struct type.  ``drop_empty`` removes slots whose fields are all NULL, before they become rows: the rows made are as
    many as the filled slots, not all the slots there are.
    """
    fields = list(slots[0].keys())
    types = {}
    for f in fields:
        c = slots[0][f]
        types[f] = df.select(c if isinstance(c, Column) else F.col(f"`{c}`")).schema.fields[0].dataType
    structs = []
    for i, s in enumerate(slots, start=1):
        parts = [F.lit(i).alias(slot_col)]
        for f in fields:
            c = s.get(f)
            c = F.lit(None) if c is None else (c if isinstance(c, Column) else F.col(f"`{c}`"))
            parts.append(c.cast(types[f]).alias(f))
        structs.append(F.struct(*parts))
    groups = F.array(*structs)
    if drop_empty:
        groups = F.filter(groups, lambda s: reduce(or_, [s[f].isNotNull() for f in fields], F.lit(False)))
    return groups


def slots_to_rows(df: DataFrame, ids: Sequence[str], slots: Sequence[dict[str, Column | str]] | str,
                  slot_col: str = "slot", drop_empty: bool = True) -> DataFrame:
    """Side-by-side repeating groups -> one row per group (narrow, no shuffle).  ``slots`` and ``drop_empty`` as for
    :func:`packed_slots`; ``slots`` may also name a column that has been packed so."""
    groups = F.col(slots) if isinstance(slots, str) else packed_slots(df, slots, slot_col, drop_empty)
    return df.select(*[F.col(f"`{i}`") for i in ids], F.inline(groups))
