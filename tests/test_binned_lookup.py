"""The as-of lookup by validity bins equals the ordered one, in batch and on a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stargrain.operators.scd2 import scd2_lookup_as_of, scd2_lookup_binned
from stargrain.streaming.streams import run_available_now, stream_source


def _data(spark, kind, seed):
    rng = random.Random(seed)
    zero = datetime(1969, 12, 1)
    versions = []
    for k in [None, *range(12)]:
        # from seconds to years, before and after 1970; gaps between some versions; some keys end
        t = zero + timedelta(seconds=rng.randrange(10**6))
        for n in range(60 if k == 0 else rng.randrange(1, 6)):
            e = t + timedelta(microseconds=rng.choice([1, 10**6, 59_999_999, 7 * 10**9, 10**12, 3 * 10**13]) * rng.randrange(1, 4))
            versions.append((k, t, e, n, f"v{n}"))
            t = e + (timedelta(days=2) if rng.random() < 0.2 else timedelta(0))
        versions.append((k, t, None if rng.random() < 0.8 else t + timedelta(hours=1), 99, "last"))
    edges = [x for v in versions for x in v[1:3] if x]
    facts = [(i, rng.choice([None, 0, 0, *range(14)]), rng.choice(edges) + timedelta(microseconds=rng.choice([-1, 0, 1, 10**7]))) for i in range(900)]
    facts.append((900, 3, None))
    return (spark.createDataFrame(facts, f"id int, k int, at {kind}"),
            spark.createDataFrame(versions, f"k int, s {kind}, e {kind}, n int, `the name` string"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_binned_equals_brute_force(spark, kind):
    facts, versions = _data(spark, kind, 5)
    got = {r["id"]: (r["n"], r["the name"]) for r in scd2_lookup_binned(facts, versions, ["k"], "at", "s", "e", ["n", "the name"]).collect()}
    vs = versions.collect()
    for f in facts.collect():
        hit = [(v["n"], v["the name"]) for v in vs if v["k"] == f["k"] and f["at"] and v["s"] <= f["at"] and (v["e"] is None or f["at"] < v["e"])]
        assert len(hit) <= 1 and got.pop(f["id"]) == (hit[0] if hit else (None, None)), f
    assert not got


def test_binned_equals_the_ordered_lookup_on_a_stream(spark, tmp_path):
    facts, versions = _data(spark, "timestamp_ntz", 9)
    # the ordered lookup knows starts alone: without gaps it says the same
    w = versions.where("k IS NOT NULL").select("k", "s", "n")
    from stargrain.operators.ordered import ordered
    whole = ordered(w, ["k"], ["s"], nxt={"e": "s"})
    facts.where("at IS NOT NULL AND k IS NOT NULL").repartition(3).write.parquet(str(tmp_path / "facts"))
    src = stream_source(spark, str(tmp_path / "facts"), facts.schema, max_files_per_trigger=1)
    run_available_now(scd2_lookup_binned(src, whole, ["k"], "at", "s", "e", ["n"]), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = scd2_lookup_as_of(spark.read.parquet(str(tmp_path / "facts")), whole, ["k"], "at", "s", ["n"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.where("n IS NOT NULL").count() > 0


def test_no_join_is_on_the_key_alone(spark):
    facts, versions = _data(spark, "timestamp_ntz", 5)
    plan = scd2_lookup_binned(facts, versions, ["k"], "at", "s", "e", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    # every level joins on key and bin; the open versions are one per key
    assert 3 <= len(joins) <= 6 and sum("_sg_bin" in j for j in joins) == len(joins) - 1
    assert versions.where("e IS NULL").groupBy("k").count().agg(F.max("count")).first()[0] == 1


def test_no_versions(spark):
    facts, versions = _data(spark, "timestamp_ntz", 5)
    got = scd2_lookup_binned(facts, versions.where("false"), ["k"], "at", "s", "e", ["n"]).collect()
    assert len(got) == 901 and {r["n"] for r in got} == {None}
