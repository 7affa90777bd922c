"""Queries over tables that streams keep up to date, registered in the catalog like the others: each writes the given
tables in parts, runs a stream over them more than once, and reads the kept table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.operators.facts import Lookup
from stargrain.operators.quality import observe_stream
from stargrain.operators.scd2 import END, START, scd2_lookup_binned, scd2_stage
from stargrain.plans.catalog import LINE_RULES, ORACLE, _TRACKED_SQL, _sk, _stream_of, customer_dimension, event_versions, query, table
from stargrain.session import scratch_dir
from stargrain.streaming import stores
from stargrain.streaming.history import MetricsHistory, metrics_total
from stargrain.streaming.streams import run_available_now, run_foreach_batch


def _fed(spark, root: str, rows: DataFrame, parts: list, step) -> None:
    """Append the rows that meet each condition of ``parts`` to a folder, and after each run ``step(stream, n)`` over what is new."""
    src = f"{root}/source"
    for n, part in enumerate(parts):
        rows.where(part).write.mode("append").parquet(src)
        step(spark.readStream.schema(rows.schema).parquet(src), n)


@query("stream_scd2_buckets", _TRACKED_SQL)
def q_stream_scd2_buckets(spark, d):
    """The later half of the change log first, then the earlier half, in a store of key buckets that is compacted in between."""
    root = scratch_dir(spark, "scd2_buckets")
    log = table(spark, d, "events").select("user_id", "event_type", "ts")
    body = stores.bucketed_scd2(f"{root}/store", ["user_id"], "ts", tracked=["event_type"], buckets=16)

    def step(stream, n):
        run_foreach_batch(scd2_stage(stream, ["user_id"], ["event_type"], "ts"), body, f"{root}/checkpoint")
        if n == 1:
            stores.compact_scd2(spark, f"{root}/store", ["user_id"], upto=1)

    day = F.dayofmonth("ts")
    _fed(spark, root, log, [day >= 20, day < 10, (day >= 10) & (day < 20)], step)
    v = stores.bucketed_versions(spark, f"{root}/store", ["user_id"])
    return v.select("user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at"), "row_version")


@query("stream_keep_first", """
SELECT o_custkey, o_orderdate, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) = 1
""")
def q_stream_keep_first(spark, d):
    """Each customer's first order, from a stream that meets the later orders first."""
    root = scratch_dir(spark, "keep_first")
    body = stores.keep_first_batches(f"{root}/kept", ["o_custkey"], ["o_orderdate"])
    rows = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    late = F.coalesce(F.year("o_orderdate") >= 1996, F.lit(False))
    _fed(spark, root, rows, [late, ~late], lambda stream, n: run_foreach_batch(stream, body, f"{root}/checkpoint"))
    return stores.keep_first_table(spark, f"{root}/kept", ["o_custkey"], ["o_orderdate"])


@query("late_dimension_rows", ORACLE["refreshed_keys"])
def q_late_dimension_rows(spark, d):
    """Orders that come before half of the customers do: they wait, and the batches after that settle them."""
    root = scratch_dir(spark, "late_dimension")
    dim = customer_dimension(table(spark, d, "customer")).select("customer_bk", "customer_key")
    early = F.substring("customer_bk", 1, 1) < "8"
    facts = table(spark, d, "orders").select("o_orderkey", F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("customer_bk"))
    body = stores.late_lookups(f"{root}/fact", lambda s: [Lookup(s.read.parquet(f"{root}/dim"), "customer_bk", "customer_key")])

    def step(stream, n):
        dim.where(early if n == 0 else ~early).write.mode("append").parquet(f"{root}/dim")
        run_foreach_batch(stream, body, f"{root}/checkpoint")

    third = F.col("o_orderkey") % 3 == 0
    _fed(spark, root, facts, [~third, third], step)
    return stores.late_table(spark, f"{root}/fact").select("o_orderkey", "customer_key")


@query("late_bridge_rows", f"""
SELECT {_sk("md5(CAST(o_orderkey AS VARCHAR))")} AS order_key, l_linenumber, l_partkey, l_suppkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
""")
def q_late_bridge_rows(spark, d):
    """Lines that come before their order wait for it; those whose order never comes are not in the bridge."""
    from stargrain.functions.keys import surrogate_key
    root = scratch_dir(spark, "late_bridge")
    bk = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    orders = table(spark, d, "orders").where("o_orderstatus <> 'P'").select("o_orderstatus", bk("o_orderkey").alias("order_bk")) \
        .withColumn("order_key", surrogate_key("order_bk"))
    lines = table(spark, d, "lineitem").select(bk("l_orderkey").alias("order_bk"), "l_linenumber", "l_partkey", "l_suppkey")

    def lookups(s):
        return [Lookup(s.read.parquet(f"{root}/fact"), "order_bk", "order_key")]

    def step(stream, n):
        if n == 0:
            orders.where("o_orderstatus = 'F'").write.parquet(f"{root}/fact")
        run_foreach_batch(stream, stores.late_lookups(f"{root}/bridge", lookups), f"{root}/checkpoint")

    half = F.col("l_partkey") % 2 == 0
    _fed(spark, root, lines, [half, ~half], step)
    # the other orders come when all lines are there
    orders.where("o_orderstatus <> 'F'").write.mode("append").parquet(f"{root}/fact")
    stores.retry_waiting(spark, f"{root}/bridge", lookups)
    return stores.late_table(spark, f"{root}/bridge", waiting=False).select("order_key", "l_linenumber", "l_partkey", "l_suppkey")


@query("stream_as_of", ORACLE["scd2_as_of"])
def q_stream_as_of(spark, d):
    """As-of lookup of streaming facts: bins of the versions' validity, joined on user and bin."""
    root = scratch_dir(spark, "as_of")
    event_versions(spark, d, ["event_type"]).select("user_id", START, END, "row_version", "event_type").write.parquet(f"{root}/versions")
    facts = _stream_of(spark, d, "events").select("event_id", "user_id", "ts")
    out = scd2_lookup_binned(facts, spark.read.parquet(f"{root}/versions"), ["user_id"], "ts", START, END, ["row_version", "event_type"])
    run_available_now(out, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "ts", F.col("row_version").alias("version_row"), F.col("event_type").alias("version_type"))


@query("stream_rule_history", f"SELECT rule, passed, failed FROM ({ORACLE['expect_metrics']})")
def q_stream_rule_history(spark, d):
    """The rule counters of a stream, stored as it ran, added up over its batches."""
    root = scratch_dir(spark, "rule_history")
    with MetricsHistory(spark, f"{root}/metrics"):
        stream = observe_stream(_stream_of(spark, d, "lineitem"), LINE_RULES, "lines")
        run_available_now(stream, f"{root}/out", f"{root}/checkpoint")
    return metrics_total(spark, f"{root}/metrics").select("rule", "passed", "failed")
