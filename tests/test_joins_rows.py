from pyspark.sql import functions as F

from stargrain.operators.facts import Lookup, build_bridge, lookup_keys, refresh_missing_keys
from stargrain.operators.joins import lookup_key, semi_join
from stargrain.operators.reshape import header_name
from stargrain.operators.rows import global_count, with_total
from stargrain.operators.summarize import attach_summary, concat_agg, count_by, having, mode_agg, summarize


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_a_lookup_never_multiplies_facts(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, bk string")
    dim = spark.createDataFrame([("a", 10), ("a", 7), ("b", 20)], "bk string, sk int")
    assert sorted((r.id, r.sk) for r in lookup_key(fact, dim, "bk", "sk").collect()) == [(1, 7), (2, 20), (3, None)]


def test_lookup_refresh_and_bridge(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "bk string, m int")
    dim_then = spark.createDataFrame([("a", 10)], "bk string, sk int")
    dim_now = spark.createDataFrame([("a", 10), ("b", 20)], "bk string, sk int")
    f1 = lookup_keys(fact, [Lookup(dim_then, "bk", "sk")])
    assert sorted((r.bk, r.sk) for r in f1.collect()) == [("a", 10), ("b", None), ("z", None)]
    f2 = refresh_missing_keys(f1, [Lookup(dim_now, "bk", "sk")])
    assert sorted((r.bk, r.sk) for r in f2.collect()) == [("a", 10), ("b", 20), ("z", None)]
    det = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("q", "v1")], "bk string, vbk string")
    fk = f2.select("bk", F.col("sk").alias("fact_key"))
    vd = spark.createDataFrame([("v1", 7)], "vbk string, vk int")
    br = build_bridge(det, fk, "bk", "fact_key", [Lookup(vd, "vbk", "vk")])
    assert sorted((r.bk, r.vbk, r.vk) for r in br.collect()) == [("a", "v1", 7), ("a", "v2", None)]


def test_semi_join_total_counts(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (5,)], "k int")
    assert [r.k for r in semi_join(left, right, ["k"]).collect()] == [2]
    assert {r.total_rows for r in with_total(left).collect()} == {3}
    assert global_count(left).first()[0] == 3


def test_summaries(spark):
    df = spark.createDataFrame([(1, 2, "b", True), (1, 1, "a", False), (1, 3, "b", False), (2, 1, "c", None)],
                               "k int, seq int, code string, crit boolean")
    s = summarize(df, ["k"], {"codes": concat_agg("code", "|", ["seq"]), "mode": mode_agg("code"),
                              "n": F.count("code")})
    got = {r.k: (r.codes, r["mode"], r.n) for r in s.collect()}
    assert got == {1: ("a|b|b", "b", 3), 2: ("c", "c", 1)}
    back = attach_summary(df, s, ["k"])
    assert back.count() == 4
    assert [tuple(r) for r in count_by(df, ["k"]).collect()] == [(1, 3), (2, 1)]
    assert [r.k for r in having(df, ["k"], 1).collect()] == [1]


def test_header_name_and_point_filter(spark):
    df = spark.createDataFrame([("Violation Description",), ("Violation  Memo",)], "h string")
    assert [r[0] for r in df.select(header_name(F.col("h"))).collect()] == ["Violation_Description",
                                                                           "Violation__Memo"]
    versions = spark.createDataFrame([("2205833-chicago", 1), ("2205833-chicago", 2), ("x-dallas", 1)],
                                     "restaurant_id string, row_version int")
    hist = versions.where(F.col("restaurant_id") == "2205833-chicago").orderBy("row_version")   # P13 + O2
    assert [r.row_version for r in hist.collect()] == [1, 2]
