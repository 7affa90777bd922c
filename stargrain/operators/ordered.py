"""Order-dependent per-key computations that stay balanced under key skew.

``row_number`` / ``lag`` / ``lead`` over ``Window.partitionBy(key)`` send all
rows of one key to one task; with one key holding a third of the data that
task is a third of the job.  The layout used here instead:

1. ``repartitionByRange(P, *keys, *order)`` — the range partitioner samples
   the data, so a hot key is cut into several contiguous, ordered pieces.
2. Local windows over ``(keys, partition id)`` — each piece of a key is
   numbered on its own (one hash exchange; pieces of a hot key land in
   different tasks).
3. Boundary fix-up — only a key that crosses a partition boundary needs
   information from the neighbouring partition.  One row per partition
   (the partition's first or last row) is enough to compute it, so the
   fix-up table has at most P rows: a size bound that does not grow with
   the data, which is what makes its broadcast safe.

Order columns must be ascending column names and, together with the keys,
define a total order (add tie-breaking columns); otherwise equal rows are
numbered in an arbitrary order, as with any window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stargrain.session import checkpoint_root

_PID = "_sgo_pid"
_LRN = "_sgo_lrn"
_LCNT = "_sgo_lcnt"


def _partitions(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _attach(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join the boundary table (at most one row per partition, so its
    size is bounded by the partition count) onto ``big`` by (partition, keys),
    NULL-safe.  The small side's join columns are renamed so no name is shared."""
    cols = [_PID] + list(keys)
    ren = small.select(*[F.col(c).alias(f"_sgo_j{i}") for i, c in enumerate(cols)],
                       *[c for c in small.columns if c not in cols])
    cond = None
    for i, c in enumerate(cols):
        e = big[c].eqNullSafe(ren[f"_sgo_j{i}"])
        cond = e if cond is None else cond & e
    joined = big.join(F.broadcast(ren), cond, "left")
    return joined.drop(*[f"_sgo_j{i}" for i in range(len(cols))])


# The layouts: a window per key, or the range layout described above.
PLAIN, RANGE = "plain", "range"


def _plain(df: DataFrame, keys, order, seq, prev, nxt, carry) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df
    if seq:
        out = out.withColumn(seq, F.sum(F.lit(1).cast("bigint")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for o, c in prev.items():
        out = out.withColumn(o, F.lag(c, 1).over(w))
    for o, c in nxt.items():
        out = out.withColumn(o, F.lead(c, 1).over(w))
    for o, c in carry.items():
        out = out.withColumn(o, F.last(c, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return out


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
            seq: str | None = None,
            prev: dict[str, str] | None = None,
            nxt: dict[str, str] | None = None,
            carry: dict[str, str] | None = None,
            parts: int | None = None,
            layout: str = PLAIN) -> DataFrame:
    """Add per-key ordered columns to ``df``.

    * ``seq``: name of a 1-based row number within the key.
    * ``prev``: ``{out: col}`` — value of ``col`` in the previous row of the key (lag 1).
    * ``nxt``: ``{out: col}`` — value of ``col`` in the next row of the key (lead 1).
    * ``carry``: ``{out: col}`` — last non-NULL value of ``col`` up to and including
      this row (forward fill).

    The caller names the layout, from what it knows of the data: ``PLAIN`` is one
    shuffle and a window per key, lazy, for keys whose groups the data model
    bounds (the lines of an order, the turns of a conversation); ``RANGE`` splits
    hot keys over many tasks, at the price of a sampling pass and a
    checkpoint.  Both give the same rows; numbers are ``bigint``.
    """
    keys, order = list(keys), list(order)
    prev, nxt, carry = prev or {}, nxt or {}, carry or {}
    if layout == PLAIN:
        return _plain(df, keys, order, seq, prev, nxt, carry)
    if layout != RANGE:
        raise ValueError(f"layout is {PLAIN!r} or {RANGE!r}")
    n = _partitions(df, parts)

    laid = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys + order]) \
        .withColumn(_PID, F.spark_partition_id())
    w = Window.partitionBy(*keys, _PID).orderBy(*order)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    loc = laid.withColumn(_LRN, F.row_number().over(w)).withColumn(_LCNT, F.count(F.lit(1)).over(w_all))
    for out, c in prev.items():
        loc = loc.withColumn(f"_sgo_lp_{out}", F.lag(c, 1).over(w))
    for out, c in nxt.items():
        loc = loc.withColumn(f"_sgo_ln_{out}", F.lead(c, 1).over(w))
    for out, c in carry.items():
        loc = loc.withColumn(f"_sgo_lc_{out}", F.last(c, ignorenulls=True).over(w_upto))

    # One row per non-empty partition: its first and its last row (in key, order).
    fields = keys + order + [_LCNT] + list(prev.values()) + [f"_sgo_lc_{o}" for o in carry]
    fields = list(dict.fromkeys(fields))
    first_fields = list(dict.fromkeys(keys + order + list(nxt.values())))
    # The boundary rows must come from the *same* partitioning as the data:
    # evaluating the range exchange twice would sample new range bounds.  So
    # the laid-out, locally numbered rows are written once to the session's
    # shared checkpoint folder (reliable checkpoint: also a lineage cut that
    # survives executor loss) and both branches read that copy.
    checkpoint_root(df.sparkSession)
    loc = loc.checkpoint(eager=True)
    bnd = loc.groupBy(_PID).agg(
        F.max(F.struct(*fields)).alias("last"),
        F.min(F.struct(*first_fields)).alias("first"),
    )
    gw = Window.orderBy(_PID)  # P rows: a single-partition window is bounded by P
    bnd = (bnd.withColumn("_next_pid", F.lead(_PID).over(gw))
              .withColumn("_prev_pid", F.lag(_PID).over(gw)))

    out = loc
    # Incoming state for partition j from the partitions before it.
    last_cols = [F.col(f"last.{k}").alias(k) for k in keys]
    incoming = bnd.select(F.col("_next_pid").alias(_PID), *last_cols,
                          F.col(f"last.{_LCNT}").alias(_LCNT),
                          *[F.col(f"last.{c}").alias(f"_sgo_bp_{o}") for o, c in prev.items()],
                          *[F.col(f"last._sgo_lc_{o}").alias(f"_sgo_bc_{o}") for o in carry],
                          F.col(_PID).alias("_src_pid"))
    incoming = incoming.where(F.col(_PID).isNotNull())
    incoming = incoming.withColumn("_sgo_off", F.sum(_LCNT).over(
        Window.partitionBy(*keys).orderBy("_src_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for o in carry:
        incoming = incoming.withColumn(f"_sgo_bc_{o}", F.last(f"_sgo_bc_{o}", ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy("_src_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    incoming = incoming.drop(_LCNT, "_src_pid")

    outgoing = bnd.select(F.col("_prev_pid").alias(_PID), *[F.col(f"first.{k}").alias(k) for k in keys],
                          *[F.col(f"first.{c}").alias(f"_sgo_bn_{o}") for o, c in nxt.items()])
    outgoing = outgoing.where(F.col(_PID).isNotNull())

    out = _attach(out, incoming, keys)
    if nxt:
        out = _attach(out, outgoing, keys)

    if seq:
        out = out.withColumn(seq, (F.col(_LRN) + F.coalesce(F.col("_sgo_off"), F.lit(0))).cast("bigint"))
    for o in prev:
        out = out.withColumn(o, F.when(F.col(_LRN) == 1, F.col(f"_sgo_bp_{o}")).otherwise(F.col(f"_sgo_lp_{o}")))
    for o in nxt:
        out = out.withColumn(o, F.when(F.col(_LRN) == F.col(_LCNT), F.col(f"_sgo_bn_{o}"))
                             .otherwise(F.col(f"_sgo_ln_{o}")))
    for o in carry:
        out = out.withColumn(o, F.coalesce(F.col(f"_sgo_lc_{o}"), F.col(f"_sgo_bc_{o}")))
    drop = [c for c in out.columns if c.startswith("_sgo_")]
    return out.drop(*drop)


def sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "seq",
             parts: int | None = None, layout: str = PLAIN) -> DataFrame:
    """1-based position (``bigint``) of each row within its key."""
    return ordered(df, keys, order, seq=out, parts=parts, layout=layout)


def run_sequence(df: DataFrame, keys: Sequence[str], arrival: Sequence[str], out: str = "seq", run: str | None = None,
                 parts: int | None = None) -> DataFrame:
    """W1, run-based form: rows are taken in ``arrival`` order (file, position), unsorted by key; the number starts
    again whenever a key differs from the row before, so a key that comes back later opens a new run.

    Gaps and islands in the range layout, with no window over all rows: the row before comes across a
    partition's end from the boundary table, and so do the row numbers and the last run's start.  ``run`` adds the
    1-based number of the run.  ``arrival`` must order the rows totally; NULL keys are equal to each other.
    """
    keys, arrival = list(keys), list(arrival)
    row = df.withColumn("_sg_key", F.struct(*[F.col(f"`{k}`") for k in keys]))
    marked = ordered(row, [], arrival, seq="_sg_row", prev={"_sg_before": "_sg_key"}, parts=parts, layout=RANGE)
    opens = (F.col("_sg_row") == 1) | ~F.col("_sg_before").eqNullSafe(F.col("_sg_key"))
    marked = marked.withColumn("_sg_open", F.when(opens, F.col("_sg_row")))
    starts = ordered(marked, [], ["_sg_row"], carry={"_sg_start": "_sg_open"}, parts=parts, layout=RANGE)
    found = starts.withColumn(out, F.col("_sg_row") - F.col("_sg_start") + 1)
    if run:
        # runs are few where rows are many: their starts alone are numbered
        ids = ordered(starts.where(F.col("_sg_open").isNotNull()).select(F.col("_sg_open").alias("_sg_first")), [], ["_sg_first"], seq=run,
                      parts=parts, layout=RANGE)
        found = found.join(ids, F.col("_sg_start") == F.col("_sg_first")).drop("_sg_first")
    return found.drop("_sg_key", "_sg_row", "_sg_before", "_sg_open", "_sg_start")
