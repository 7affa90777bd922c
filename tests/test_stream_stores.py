"""Tables that streams keep: bucketed SCD2, keep-first in any order of arrival, late dimension rows, metrics history."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stargrain.operators.facts import Lookup
from stargrain.operators.quality import Expectation, metrics, observe_stream
from stargrain.operators.rows import unique_first
from stargrain.operators.scd2 import END, START, scd2_apply
from stargrain.streaming import stores
from stargrain.streaming.history import MetricsHistory, metrics_history, metrics_total
from stargrain.streaming.streams import run_available_now, run_foreach_batch, stream_source

LOG = "k bigint, t int, v string"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def snapshots(seed, n, keys):
    rng = random.Random(seed)
    # key 0 has a third of the rows
    return [(0 if rng.random() < 0.34 else rng.randrange(keys), rng.randrange(200), rng.choice("abc")) for _ in range(n)]


def test_bucketed_store_equals_batch_and_replays(spark, tmp_path):
    root = str(tmp_path / "store")
    body = stores.bucketed_scd2(root, ["k"], "t", tracked=["v"], buckets=8)
    batches = [spark.createDataFrame(snapshots(s, n, 40), LOG) for s, n in ((1, 120), (2, 60), (3, 1))]
    for e, b in enumerate(batches):
        body(b, e)
    body(batches[1], 1)  # runs again after the later one
    columns = ["k", "t", "v", START, END, "row_version"]
    want = rows_of(scd2_apply(batches[0].union(batches[1]).union(batches[2]).distinct(), ["k"], "t", tracked=["v"]).select(columns))
    body(batches[2], 2)
    assert rows_of(stores.bucketed_versions(spark, root, ["k"]).select(columns)) == want
    with pytest.raises(ValueError):
        stores.bucket_count(spark, root, 16)
    folded = stores.compact_scd2(spark, root, ["k"], upto=1)
    assert folded and rows_of(stores.bucketed_versions(spark, root, ["k"]).select(columns)) == want
    assert all(min(stores._folders(spark, f"{root}/log/sg_bucket={b}", "sg_epoch")) >= 1 for b in folded)
    # the folded store goes on
    more = spark.createDataFrame([(0, 1000, "z"), (5, -1, "y")], LOG)
    body(more, 3)
    every = batches[0].union(batches[1]).union(batches[2]).union(more).distinct()
    want = rows_of(scd2_apply(every, ["k"], "t", tracked=["v"]).select(columns))
    assert rows_of(stores.bucketed_versions(spark, root, ["k"]).select(columns)) == want


def test_a_batch_reads_only_the_buckets_it_touched(spark, tmp_path):
    root = str(tmp_path / "store")
    body = stores.bucketed_scd2(root, ["k"], "t", tracked=["v"], buckets=16)
    body(spark.createDataFrame([(k, 1, "a") for k in range(300)], LOG), 0)
    one = spark.createDataFrame([(7, 2, "b"), (7, 3, "c")], LOG)
    body(one, 1)
    touched = stores.buckets_of(spark, root, one, ["k"])
    assert len(touched) == 1 and len(stores._folders(spark, f"{root}/log", "sg_bucket")) == 16
    files = stores.touched_log(spark, root, 1).inputFiles()
    assert files and all(f"/sg_bucket={touched[0]}/" in f for f in files)
    assert stores._folders(spark, f"{root}/versions/sg_bucket={touched[0]}", "sg_epoch") == [0, 1]
    assert sum(1 in stores._folders(spark, f"{root}/versions/sg_bucket={b}", "sg_epoch") for b in range(16)) == 1
    versions = stores.bucketed_versions(spark, root, ["k"], only=touched)
    assert versions.where("k = 7").count() == 3 and versions.select("k").distinct().count() < 300


def test_keep_first_does_not_depend_on_the_order_of_files(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, 1, 2, 3]), str(rng.randrange(5))) for _ in range(400)]
    schema = "k int, o int, v string"
    want = rows_of(unique_first(spark.createDataFrame(rows, schema), ["k"], ["o"]))
    for turn in range(2):
        root, src = str(tmp_path / f"out{turn}"), str(tmp_path / f"src{turn}")
        parts = [rows[i::3] for i in range(3)]
        for part in parts if turn else reversed(parts):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            stream = stream_source(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
            run_foreach_batch(stream, stores.keep_first_batches(root, ["k"], ["o"]), str(tmp_path / f"ckpt{turn}"))
        assert len(stores._folders(spark, root, "sg_epoch")) == 3
        assert rows_of(stores.keep_first_table(spark, root, ["k"], ["o"])) == want
        stores.fold_keep_first(spark, root, ["k"], ["o"])
        assert len(stores._folders(spark, root, "sg_epoch")) == 1
        assert rows_of(stores.keep_first_table(spark, root, ["k"], ["o"])) == want


def test_facts_pick_up_dimension_rows_that_come_later(spark, tmp_path):
    root, dim = str(tmp_path / "fact"), str(tmp_path / "dim")

    def add(rows):
        spark.createDataFrame(rows, "bk string, sk int").write.mode("append").parquet(dim)

    def lookups(s):
        return [Lookup(s.read.parquet(dim), "bk", "sk")]

    body = stores.late_lookups(root, lookups)
    facts = lambda rows: spark.createDataFrame(rows, "id int, bk string")
    add([("a", 1)])
    body(facts([(1, "a"), (2, "b"), (3, None), (4, "c"), (4, "c")]), 0)
    assert rows_of(stores.late_table(spark, root).select("id", "sk")) == Counter([(1, 1), (2, None), (3, None), (4, None), (4, None)])
    assert rows_of(stores._waiting(spark, root).select("id")) == Counter([(2,), (4,), (4,)])
    add([("b", 2)])
    body(facts([(5, "a"), (6, "z")]), 1)
    body(facts([(5, "a"), (6, "z")]), 1)  # again
    settled = Counter([(1, 1), (2, 2), (3, None), (5, 1)])
    assert rows_of(stores.late_table(spark, root, waiting=False).select("id", "sk")) == settled
    assert rows_of(stores.late_table(spark, root).select("id", "sk")) == settled + Counter([(4, None), (4, None), (6, None)])
    add([("c", 3)])
    stores.retry_waiting(spark, root, lookups)
    assert rows_of(stores.late_table(spark, root, waiting=False).select("id", "sk")) == settled + Counter([(4, 3), (4, 3)])
    # the next batch looks up only what still waits, and all may be settled at last
    add([("z", 9)])
    body(facts([]), 2)
    assert stores._waiting(spark, root) is None
    assert rows_of(stores.late_table(spark, root).select("id", "sk")) == settled + Counter([(4, 3), (4, 3), (6, 9)])
    stores.retry_waiting(spark, root, lookups)
    body(facts([(7, "q")]), 3)
    assert rows_of(stores.late_table(spark, root).where("id >= 6").select("id", "sk")) == Counter([(6, 9), (7, None)])


def test_metrics_of_every_batch_are_kept(spark, tmp_path):
    rules = [Expectation("positive", "v > 0", "drop"), Expectation("known", "k IS NOT NULL")]
    src, path = str(tmp_path / "src"), str(tmp_path / "metrics")
    rows = spark.range(90).selectExpr("nullif(id % 7, 3) AS k", "nullif(id % 5, 2) - 1 AS v")
    for i in range(3):
        rows.where(f"coalesce(v, 0) % 3 = {i}").coalesce(1).write.mode("append").parquet(src)
    with MetricsHistory(spark, path):
        for turn in range(2):
            stream = observe_stream(stream_source(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1), rules, "checks")
            run_available_now(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
            if not turn:
                rows.limit(10).coalesce(1).write.mode("append").parquet(src)
    got = metrics_history(spark, path)
    assert got.select("run_id").distinct().count() == 2
    want = {(r["rule"], r["passed"], r["failed"]) for r in metrics(spark.read.parquet(src), rules).collect()}
    assert {(r["rule"], r["passed"], r["failed"]) for r in metrics_total(spark, path).collect()} == want
    assert got.groupBy("batch_id").count().count() >= 2
