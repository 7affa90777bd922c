"""Slowly changing dimension, type 2, without a MERGE engine.

The change log (staged snapshots) is the source of truth; versions are a
pure function of it, recomputed with per-key ordered steps that stay
balanced under key skew (see :mod:`stargrain.operators.ordered`):

1. ties on (key, sequence) collapse to one snapshot — the largest attribute
   tuple wins, so the result is deterministic;
2. a snapshot opens a version when its tracked attributes differ (NULL-safe)
   from the previous snapshot of the key; the first snapshot always opens one;
3. ``__END_AT`` of a version is the ``__START_AT`` of the next version.

Because versions are recomputed from the log, late and out-of-order
snapshots are handled by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions.keys import epoch_micros, surrogate_key
from stargrain.operators.ordered import PLAIN, ordered

START, END = "__START_AT", "__END_AT"
FAR_FUTURE_DATE = "9999-12-31"


def scd2_stage(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], sequence_by: str,
               not_null: Sequence[str] | None = None) -> DataFrame:
    """Distinct snapshots ``(keys, attrs, sequence_by)``; works on a stream."""
    cols = list(dict.fromkeys([*keys, *attrs, sequence_by]))
    out = df.select(*cols)
    for c in (not_null if not_null is not None else [*keys, sequence_by]):
        out = out.where(F.col(c).isNotNull())
    return out.dropDuplicates(cols)


def scd2_apply(log: DataFrame, keys: Sequence[str], sequence_by: str,
               tracked: Sequence[str] | None = None, ignore_null_updates: bool = False,
               parts: int | None = None, layout: str = PLAIN) -> DataFrame:
    """T5 ``apply_changes(stored_as_scd_type=2)`` as a batch query over the log.

    ``tracked=None`` tracks every non-key column, the sequence column
    included (so every new sequence value opens a version — the literal
    configuration of the reference); pass a list to track only those.
    Returns the log columns plus ``__START_AT`` and ``__END_AT`` (NULL for the
    open version).
    """
    keys = list(keys)
    others = [c for c in log.columns if c not in keys and c != sequence_by]
    # 1. one snapshot per (key, sequence): the largest attribute tuple wins.
    snap = log.groupBy(*keys, sequence_by).agg(F.max(F.struct(*others)).alias("_sg_a")) \
        .select(*keys, sequence_by, "_sg_a.*") if others else log.select(*keys, sequence_by).distinct()
    trk = list(tracked) if tracked is not None else [*others, sequence_by]
    if ignore_null_updates:
        # a NULL attribute means "unchanged": fill it from the last non-NULL value of the key
        snap = ordered(snap, keys, [sequence_by], carry={f"_sg_f_{c}": c for c in others}, parts=parts,
                       layout=layout)
        for c in others:
            snap = snap.withColumn(c, F.col(f"_sg_f_{c}")).drop(f"_sg_f_{c}")
    snap = snap.withColumn("_sg_trk", F.struct(*trk))
    # 2. keep snapshots whose tracked values differ from the previous snapshot.
    marked = ordered(snap, keys, [sequence_by], prev={"_sg_prev": "_sg_trk"}, parts=parts,
                     layout=layout)
    changed = marked.where(F.col("_sg_prev").isNull() | ~F.col("_sg_prev").eqNullSafe(F.col("_sg_trk")))
    changed = changed.drop("_sg_prev", "_sg_trk")
    # 3. version end = next version start; row_version numbers the versions.
    versions = ordered(changed, keys, [sequence_by], seq="row_version", nxt={END: sequence_by}, parts=parts,
                       layout=layout)
    return versions.withColumn(START, F.col(sequence_by))


def scd2_transformed(versions: DataFrame, load_at: bool = True) -> DataFrame:
    """Validity as ``start_dt`` / ``end_dt`` and an ``is_active`` Y/N flag
    (open version), plus the load time; the ``__START_AT``/``__END_AT``
    columns are dropped."""
    out = (versions.withColumn("start_dt", F.col(START)).withColumn("end_dt", F.col(END))
           .withColumn("is_active", F.when(F.col(END).isNull(), F.lit("Y")).otherwise(F.lit("N"))))
    if load_at:
        out = out.withColumn("load_at", F.current_timestamp())
    return out.drop(START, END)


def scd2_final(versions: DataFrame, key: str, *, as_date: bool = True, sk_name: str = "version_key",
               sk_method: str = "md5_60", load_at: bool = False) -> DataFrame:
    """Validity columns of the final dimension.

    ``effective_*`` = start, ``expiration_*`` = end or 9999-12-31,
    ``is_current`` = no end, ``row_version`` (from :func:`scd2_apply`), and a
    surrogate key from (key, effective).  ``as_date`` truncates to dates as
    the reference does; keep timestamps when several versions can start on
    one day.
    """
    if as_date:
        eff, exp = F.to_date(F.col(START)), F.coalesce(F.to_date(F.col(END)), F.lit(FAR_FUTURE_DATE).cast("date"))
        names = ("effective_date", "expiration_date")
    else:
        eff = F.col(START)
        exp = F.coalesce(F.col(END), F.lit(f"{FAR_FUTURE_DATE} 00:00:00").cast(versions.schema[START].dataType))
        names = ("effective_at", "expiration_at")
    out = (versions.withColumn(names[0], eff).withColumn(names[1], exp)
           .withColumn("is_current", F.col(END).isNull()))
    # key text: date as yyyy-MM-dd, timestamp as epoch microseconds (engine-neutral text)
    start_txt = F.col(names[0]).cast("string") if as_date else \
        epoch_micros(names[0], versions.schema[START].dataType.simpleString()).cast("string")
    out = out.withColumn(sk_name, surrogate_key(F.concat_ws("|", F.col(key).cast("string"), start_txt), sk_method))
    if load_at:
        out = out.withColumn("load_at", F.current_timestamp())
    return out.drop(START, END)


def scd2_current(versions: DataFrame) -> DataFrame:
    """P10: current versions only."""
    return versions.where(F.col("is_current"))


def scd2_lookup_current(facts: DataFrame, versions: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """J3 against the current version: one current row per key, so the join
    never multiplies fact rows."""
    cur = scd2_current(versions).select(*keys, *cols)
    return facts.join(cur, list(keys), "left")


def scd2_lookup_as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str,
                      start: str, cols: Sequence[str], parts: int | None = None,
                      layout: str = PLAIN) -> DataFrame:
    """J6 as-of lookup: for each fact, the version of its key valid at ``at``
    (``start <= at < next start``).

    Not a range join (which pairs every fact with every version of its key):
    facts and version starts are merged into one ordered stream per key and
    the version attributes are carried forward to the facts that follow them.
    A version sorts before a fact with the same time (``start`` is inclusive).
    """
    keys = list(keys)
    fact_cols = facts.columns
    v = versions.select(*keys, F.col(start).alias("_sg_t"), F.lit(0).alias("_sg_tag"),
                        F.struct(*cols).alias("_sg_v"))
    f = facts.select(*[F.col(f"`{c}`") for c in fact_cols], F.col(at).alias("_sg_t"), F.lit(1).alias("_sg_tag"))
    u = f.unionByName(v, allowMissingColumns=True)
    res = ordered(u, keys, ["_sg_t", "_sg_tag"], carry={"_sg_cv": "_sg_v"}, parts=parts, layout=layout)
    res = res.where(F.col("_sg_tag") == 1)
    return res.select(*[F.col(f"`{c}`") for c in fact_cols],
                      *[F.col(f"_sg_cv.{c}").alias(c) for c in cols])



# a version lies in at most this many bins and one more of its level
_SPREAD = 64


def scd2_lookup_binned(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                       cols: Sequence[str], finest_s: int = 60) -> DataFrame:
    """J6 for streaming ``facts`` (and batch ones): the version of each fact's key valid at ``at`` (``start <= at < end``, an
    open version has no ``end``).

    Ordered windows do not run on streams, and a join on the key alone would pair a key's facts with all its versions.
    So validity is cut into time bins and joined on (key, bin) exactly: bins have widths of ``finest_s`` seconds times
    powers of 64, a version is put on the finest level where it lies in 65 bins at most, and open versions, one per key, are a
    join of their own.  Versions of a key do not overlap, so each fact meets one of them at most and no join
    multiplies facts.  The number of levels is the logarithm of the longest validity; a hot key's facts are
    spread over its bins.  ``versions`` is a batch table, read as it is when a micro-batch starts.
    """
    keys = list(keys)
    types = dict(versions.dtypes)
    v = versions.select(*[F.col(f"`{k}`").alias(f"_sg_k{i}") for i, k in enumerate(keys)], epoch_micros(start, types[start]).alias("_sg_from"),
                        epoch_micros(end, types[end]).alias("_sg_to"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_sg_v"))
    closed = v.where("_sg_to > _sg_from")
    longest = closed.agg(F.max(F.col("_sg_to") - F.col("_sg_from"))).first()[0]
    widths = []
    while longest is not None and (not widths or widths[-1] * _SPREAD < longest):
        widths.append(widths[-1] * _SPREAD if widths else finest_s * 1_000_000)
    names = facts.columns
    out = facts.withColumn("_sg_at", epoch_micros(at, dict(facts.dtypes)[at]))

    def same(side: DataFrame, more):
        for i, k in enumerate(keys):
            more = more & out[k].eqNullSafe(side[f"_sg_k{i}"])
        return more

    found = []
    for level, width in enumerate(widths):
        lasts = F.col("_sg_to") - F.col("_sg_from")
        mine = closed.where(lasts <= width * _SPREAD)
        if level:
            mine = mine.where(lasts > widths[level - 1] * _SPREAD)
        side = mine.withColumn("_sg_bin", F.explode(F.sequence(_bin(F.col("_sg_from"), width), _bin(F.col("_sg_to") - 1, width)))) \
            .withColumnRenamed("_sg_v", f"_sg_v{level}")
        here = _bin(out["_sg_at"], width)
        cond = same(side, (here == side["_sg_bin"]) & (out["_sg_at"] >= side["_sg_from"]) & (out["_sg_at"] < side["_sg_to"]))
        out = out.join(side, cond, "left").drop("_sg_bin", "_sg_from", "_sg_to", *[f"_sg_k{i}" for i in range(len(keys))])
        found.append(f"_sg_v{level}")
    side = v.where("_sg_to IS NULL").drop("_sg_to").withColumnRenamed("_sg_v", "_sg_open")
    out = out.join(side, same(side, out["_sg_at"] >= side["_sg_from"]), "left")
    version = F.coalesce(*[F.col(c) for c in [*found, "_sg_open"]])
    return out.withColumn("_sg_version", version).select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_sg_version.`{c}`").alias(c) for c in cols])


def _bin(micros, width: int):
    """The bin of a time, rounded down before 1970 as well; the quotient is exact, so a double holds it."""
    return ((micros - F.pmod(micros, F.lit(width))) / F.lit(width)).cast("bigint")
