from pyspark.sql import functions as F

from stargrain.operators.cleanse import auto_field, cleanse, field_types
from stargrain.operators.profile import compare_schemas, field_info, pattern_histogram, profile
from stargrain.operators.quality import Expectation, apply_expectations, enforce, observed
from stargrain.operators.reshape import (cross_tab, regex_parse, select_map, slots_to_rows, split_to_rows, union_all,
                                        unpivot)
from stargrain.plans.catalog import VIOLATION_PATTERN


def test_split_to_rows_keeps_order_and_null(spark):
    df = spark.createDataFrame([(1, "a|b||c"), (2, None)], "id int, v string")
    got = sorted((tuple(r) for r in split_to_rows(df, "v", "|", pos="n").collect()), key=lambda t: (t[0], t[2] or 0))
    assert got == [(1, "a", 1), (1, "b", 2), (1, "", 3), (1, "c", 4), (2, None, None)]


def test_regex_parse_traps(spark):
    texts = ["1. FOOD SAFE - Comments: ok  ", "47. FOOD & NON-FOOD CONTACT - Comments: x",
             "3. NO COMMENT PART", "12. SINKS - comments: lower case"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = regex_parse(df, "t", VIOLATION_PATTERN, ["code", "desc", "comm"], ignore_case=True)
    got = [tuple(r) for r in out.select("code", "desc", "comm").collect()]
    assert got == [("1", "FOOD SAFE", "ok"), (None, None, None), (None, None, None), ("12", "SINKS", "lower case")]


def test_unpivot_cross_tab_identity(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 4.0)], "k int, a double, b double")
    back = cross_tab(unpivot(df, ["k"], ["a", "b"], "name", "value"), ["k"], "name", "value", ["a", "b"])
    assert sorted(tuple(r) for r in back.collect()) == [(1, 1.0, 2.0), (2, None, 4.0)]


def test_slots_to_rows_two_space_memo(spark):
    df = spark.createDataFrame([("r1", "*5 desc", "3", None, "m", None, None)],
                               "id string, `Violation Description - 1` string, `Violation Points - 1` string, "
                               "`Violation Detail - 1` string, `Violation  Memo - 1` string, "
                               "`Violation Description - 2` string, `Violation Points - 2` string")
    slots = [{"description": f"Violation Description - {i}", "points": f"Violation Points - {i}"} for i in (1, 2)]
    slots[0]["memo"] = "Violation  Memo - 1"
    out = slots_to_rows(df, ["id"], slots)
    assert [tuple(r) for r in out.collect()] == [("r1", 1, "*5 desc", "3", "m")]


def test_select_map_and_union(spark):
    a = spark.createDataFrame([(1, "x")], "zipcode int, FileName string")
    b = spark.createDataFrame([(2, "y", "z")], "zip_code int, filename string, extra string")
    a2 = select_map(a, {"zipcode": "zip_code", "FileName": "filename"})
    u = union_all([a2, b])
    assert u.columns == ["zip_code", "filename", "extra"]
    assert sorted(tuple(r) for r in u.collect()) == [(1, "x", None), (2, "y", "z")]


def test_cleanse_and_auto_field(spark):
    df = spark.createDataFrame([(" a \t b ", "1", "2024-01-02", None), (None, None, None, None),
                                ("c", "300", "2024-01-03", None)], "s string, n string, d string, e string")
    c = cleanse(df, drop_null_rows=True, drop_null_columns=True)
    assert c.columns == ["s", "n", "d"] and c.count() == 2
    assert c.where("s = 'a b'").count() == 1
    typed, types = auto_field(c)
    assert types == {"s": "string", "n": "smallint", "d": "date"}
    assert dict(typed.dtypes)["n"] == "smallint"
    ft = {r["column_name"]: r["inferred_type"] for r in field_types(df).collect()}
    assert ft["e"] == "string"


def test_profile_and_schemas(spark):
    df = spark.createDataFrame([("a1", 1), ("", None), ("b22", 3)], "s string, n int")
    p = {r["column_name"]: r for r in profile(df, exact=True).collect()}
    assert p["s"]["n_blank"] == 1 and p["n"]["n_nulls"] == 1 and p["s"]["max_len"] == 3
    h = {(r["column_name"], r["pattern"]): r["n"] for r in pattern_histogram(df, ["s"]).collect()}
    assert h[("s", "A9")] == 1 and h[("s", "A99")] == 1
    assert field_info(df)[1] == (2, "n", "int", True)
    other = spark.createDataFrame([(1.0, "x")], "n double, t string")
    assert compare_schemas(df, other) == [("s", "string", None, "only_left"), ("n", "int", "double", "type_differs"),
                                          ("t", None, "string", "only_right")]


def test_expectations_partition_the_input(spark):
    df = spark.createDataFrame([(1, "Chicago", None), (2, "Dallas", 101), (3, "Dallas", 90), (4, None, 150)],
                               "id int, source_city string, score int")
    rules = [Expectation("score_ok", "source_city != 'Dallas' OR (score IS NOT NULL AND score <= 100)", "drop"),
             Expectation("has_city", "source_city IS NOT NULL", "warn")]
    kept, quar, met = apply_expectations(df, rules)
    assert sorted(r.id for r in kept.collect()) == [1, 3]       # NULL predicate (id 4) counts as failed
    assert sorted(r.id for r in quar.collect()) == [2, 4]
    assert kept.count() + quar.count() == df.count()
    m = {r.rule: (r.passed, r.failed) for r in met.collect()}
    assert m == {"score_ok": (2, 2), "has_city": (3, 1)}
    obs_df, obs = observed(df, rules)
    obs_df.count()
    assert obs.get["score_ok"] == 2
    hard = [Expectation("no_nulls", "score IS NOT NULL", "fail")]
    try:
        enforce(df, hard)
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_outlier_counts_brute_force(spark):
    import numpy as np
    from stargrain.operators.profile import outlier_counts
    vals = [1.0, 2.0, 2.0, 3.0, 3.0, 3.0, 4.0, 4.0, 5.0, 40.0, -30.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = outlier_counts(df, ["x"]).first()
    s = sorted(vals)

    def q(p):  # percentile_approx returns an actual element: the smallest v with rank >= p * n
        return s[max(0, int(np.ceil(p * len(s))) - 1)]
    lo, hi = q(0.25) - 1.5 * (q(0.75) - q(0.25)), q(0.75) + 1.5 * (q(0.75) - q(0.25))
    assert (r.lower_fence, r.upper_fence) == (lo, hi)
    assert r.n_outliers == sum(1 for v in vals if v < lo or v > hi) == 2


def test_auto_field_keeps_what_a_type_cannot_hold(spark):
    df = spark.createDataFrame([("99999999999999999999", "2024-02-30", "1e400", "00501", "+7", "1.5", "2024-02-29 10:00:00", "1e300"),
                                ("1", "2024-02-28", "1", "10001", "-128", "2", "2024-01-01T00:00:00.5", "2"), (None,) * 8],
                               "huge string, day string, real string, zip string, tiny string, half string, at string, big string")
    out, types = auto_field(df)
    assert types == {"huge": "string", "day": "string", "real": "string", "zip": "string", "tiny": "tinyint", "half": "double", "at": "timestamp",
                     "big": "double"}
    for c in out.columns:  # nothing is lost
        assert out.where(F.col(c).isNull()).count() == 1


def test_cleanse_on_mixed_types_and_no_break_spaces(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, 2.5, dt.datetime(2024, 1, 1), "\u00a0FOOD \u00a0 SAFE\u00a0"), (None, None, None, " \u00a0\t"), (None, None, dt.datetime(2024, 1, 1), None)],
                               "a bigint, b double, c timestamp, d string")
    assert sorted((r.d or "") for r in cleanse(df).collect()) == ["", "FOOD SAFE"]


def test_cross_tab_keeps_the_null_header(spark):
    from stargrain.operators.reshape import cross_tab
    df = spark.createDataFrame([(1, "x", 5), (1, None, 7)], "k int, h string, v int")
    assert cross_tab(df, ["k"], "h", "v").first().asDict() == {"k": 1, "x": 5, "null": 7}


def test_cross_tab_bounds_the_headers(spark):
    import pytest
    df = spark.range(30).selectExpr("id % 3 AS k", "id % 10 AS h", "id AS v")
    assert len(cross_tab(df, ["k"], "h", "v", agg="max", most=10).columns) == 11
    with pytest.raises(ValueError, match="more than 9 values"):
        cross_tab(df, ["k"], "h", "v", agg="max", most=9)


def test_slots_to_rows_makes_rows_of_filled_slots_alone(spark):
    df = spark.createDataFrame([(1, "a", None, None, None), (2, None, None, None, None), (3, None, "", "c", "d")], "k int, x1 string, y1 string, x2 string, y2 string")
    out = slots_to_rows(df, ["k"], [{"x": "x1", "y": "y1"}, {"x": "x2", "y": "y2"}])
    assert sorted(map(tuple, out.collect())) == [(1, 1, "a", None), (3, 1, None, ""), (3, 2, "c", "d")]
    # no row is made to be dropped again
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in p[:p.index("Generate")].splitlines() if "Filter" in x]
    every = slots_to_rows(df, ["k"], [{"x": "x1", "y": "y1"}, {"x": "x2", "y": "y2"}], drop_empty=False)
    assert every.count() == 6


def test_cleanse_does_not_test_rows_that_have_a_fixed_value(spark):
    df = spark.createDataFrame([(" a ", None), (None, "\t "), (None, None), ("", "b")], "x string, y string")
    assert sorted((r.x, r.y) for r in cleanse(df).where("x IS NOT NULL").collect()) == [("", "b"), ("a", None)] and cleanse(df).count() == 2
    fixed = cleanse(df.withColumn("z", F.lit("c")))
    assert fixed.count() == 4 and "RLIKE" not in fixed._jdf.queryExecution().optimizedPlan().toString()
    assert cleanse(df.withColumn("n", F.when(F.col("y").isNull(), 1))).count() == 3
