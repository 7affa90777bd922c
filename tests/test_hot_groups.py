"""Summaries and sequences of hot groups: the ordered pieces give what one window or one array would."""

import random

import pytest
from pyspark.sql import functions as F

from stargrain.operators.ordered import run_sequence
from stargrain.operators.summarize import any_true, attach_summary, concat_agg, concat_by, mode_agg, summarize, summarize_back


def _rows(spark, n=3000):
    # a third of the rows is in the NULL group; values and texts hold NULLs and empty texts
    rng = random.Random(n)
    rows = [(None if i % 3 == 0 else rng.randrange(40), rng.randrange(500), i, rng.choice([None, "", "a", "bc", f"v{i}"])) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g int, o int, i int, v string")


def _equal(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_concat_by_equals_concat_agg(spark, parts):
    df = _rows(spark)
    got = concat_by(df, ["g"], {"vs": ("v", "|"), "is": ("i", ",")}, ["o", "i"], parts=parts).select("g", "vs", "is")
    want = df.groupBy("g").agg(concat_agg("v", "|", ["o", "i"]).alias("vs"), concat_agg("i", ",", ["o", "i"]).alias("is"))
    _equal(got, want)


def test_a_group_without_values_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 1, "")], "g int, o int, v string")
    got = {r["g"]: r["vs"] for r in concat_by(df, ["g"], {"vs": ("v", "|")}, ["o"], parts=3).collect()}
    assert got == {1: "", 2: ""}
    assert concat_by(df.where("false"), ["g"], {"vs": ("v", "|")}, ["o"]).collect() == []


def test_no_task_holds_a_hot_group(spark):
    df = _rows(spark, 4000)
    pieces = df.repartitionByRange(16, "g", "o", "i").groupBy("g", F.spark_partition_id().alias("p")).count()
    assert pieces.where("g IS NULL").count() >= 4 and pieces.agg(F.max("count")).first()[0] < 4000 / 6
    plan = concat_by(df, ["g"], {"vs": ("v", "|")}, ["o", "i"], parts=16)._jdf.queryExecution().executedPlan().toString()
    # lists are made before the second exchange: a piece moves as one row
    lower = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_collect_list" in lower and "Exchange rangepartitioning" in lower


def test_summaries_with_texts_join_back_null_safe(spark):
    df = _rows(spark, 600)
    got = summarize(df, ["g"], {"n": F.count(F.lit(1))}, concats={"vs": ("v", "|")}, order_by=["o", "i"], parts=5)
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), concat_agg("v", "|", ["o", "i"]).alias("vs"))
    _equal(got.select("g", "n", "vs"), want)
    back = attach_summary(df.where("g IS NOT NULL"), got, ["g"])
    assert back.count() == df.where("g IS NOT NULL").count()


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_run_sequence_equals_a_loop(spark, parts):
    rng = random.Random(parts)
    rows, key = [], None
    for i in range(700):
        if rng.random() < (0.02 if 200 < i < 500 else 0.5):
            key = rng.choice([None, "a", "b"])
        rows.append((f"f{i // 300}", i % 300, key, rng.choice(["x", None]) if i % 7 == 0 else "x"))
    want, run, n, before = {}, 0, 0, object()
    for file, pos, k, k2 in rows:
        n = n + 1 if (k, k2) == before else 1
        run += n == 1
        before = (k, k2)
        want[file, pos] = (n, run)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "file string, pos int, k string, k2 string")
    got = run_sequence(df, ["k", "k2"], ["file", "pos"], out="n", run="run", parts=parts).collect()
    assert {(r["file"], r["pos"]): (r["n"], r["run"]) for r in got} == want and len(got) == len(rows)
    assert run_sequence(df.where("false"), ["k"], ["file", "pos"]).collect() == []


def test_summarize_back_equals_summary_and_join(spark):
    # key 1 has two groups, so its rows meet both summaries; rows without a key meet none; "t" may be NULL in a group
    rows = [(1, "a", 1, "x"), (1, "a", 2, None), (1, "b", 1, "y"), (2, None, 1, "z"), (2, None, 1, "z"), (None, "a", 1, "w")]
    df = spark.createDataFrame(rows, "k int, t string, o int, v string")
    aggs = {"n": F.count(F.lit(1)), "vs": concat_agg("v", "|", ["o"])}
    for by in (["k", "t"], ["k"]):
        summary = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()]).select("k", *aggs)
        want, got = df.join(summary, "k"), summarize_back(df, "k", by, aggs)
        _equal(got.select("k", "t", "o", "v", "n", "vs"), want.select("k", "t", "o", "v", "n", "vs"))
        assert got.count() == want.count() == (8 if len(by) == 2 else 5)


def test_summarize_back_over_windows_equals_summary_and_join(spark):
    rows = [(1, "a", 1, "x"), (1, "a", 2, None), (1, "b", 1, "y"), (2, None, 1, "z"), (2, None, 1, "z"), (None, "a", 1, "w"), (3, "c", 1, None)]
    df = spark.createDataFrame(rows, "k int, t string, o int, v string")
    aggs = {"n": (F.count("v"), lambda w: F.count("v").over(w)), "vs": (concat_agg("v", "|", ["o"]), lambda w: concat_agg("v", "|", ["o"], over=w)),
            "most": (F.max("v"), lambda w: F.max("v").over(w)), "often": (mode_agg("v"), lambda w: mode_agg("v", over=w)),
            "any": (any_true(F.col("v") == "y"), lambda w: any_true(F.col("v") == "y", over=w))}
    for by in (["k", "t"], ["k"]):
        summary = df.groupBy(*by).agg(*[a.alias(n) for n, (a, _) in aggs.items()]).select("k", *aggs)
        want, got = df.join(summary, "k"), summarize_back(df, "k", by, {n: f for n, (_, f) in aggs.items()})
        _equal(got.select(*df.columns, *aggs), want.select(*df.columns, *aggs))
        assert got.count() == want.count() == (9 if len(by) == 2 else 6)
    # a summary that is not used is not computed
    assert "collect_list(struct" not in got.select("k", "n")._jdf.queryExecution().optimizedPlan().toString()
