import hashlib

from pyspark.sql import functions as F

from stargrain.functions import keys as K
from stargrain.functions import rules as R
from stargrain.functions import text as T


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_md5_60_matches_python(spark):
    df = spark.createDataFrame([("a",), ("b|c",)], "bk string")
    got = rows(df.select(K.surrogate_key("bk").alias("k")), "k")
    # surrogate_key hashes the business key text itself
    want = [(int(hashlib.md5(s.encode()).hexdigest()[:15], 16),) for s in ["a", "b|c"]]
    assert got == want


def test_murmur31_widened_no_overflow(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("bk"))
    out = df.select(K.surrogate_key("bk", "murmur31").alias("k"))
    assert out.where((F.col("k") < 0) | (F.col("k") >= 2147483647)).count() == 0


def test_business_key_null_handling(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    r = df.select(K.business_key("x", "y").alias("ws"), K.business_key("x", "y", skip_nulls=False).alias("c")).first()
    assert r["ws"] == hashlib.md5(b"a").hexdigest()   # concat_ws skips NULL (trap 5)
    assert r["c"] is None


def test_date_key(spark):
    df = spark.sql("select date'2024-03-07' d, cast(null as date) n")
    r = df.select(K.date_key("d").alias("k"), K.date_key("n").alias("kn")).first()
    assert r["k"] == 20240307 and r["kn"] is None


def test_city_a_score_and_result(spark):
    vals = ["Pass", "Pass w/ Conditions", "Fail", "No Entry", "Out of Business", "Business Not Located", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    got = rows(df.select(R.city_a_score("r").alias("s"), R.city_a_result("r").alias("t")), "s", "t")
    assert got == [(90, "PASS"), (80, "PASS_CONDITIONS"), (70, "FAIL"), (0, "NO_ENTRY"), (None, "OUT_OF_BUSINESS"),
                   (None, "NOT_LOCATED"), (None, "OTHER"), (None, "OTHER")]


def test_severity_rules(spark):
    df = spark.createDataFrame([(False, False, "1"), (False, False, "14"), (False, False, "15"), (False, False, "29"),
                                (False, False, "30"), (True, True, "3"), (False, True, "3")], "c boolean, u boolean, code string")
    got = [r[0] for r in df.select(R.city_a_severity("c", "u", "code")).collect()]
    assert got == ["Priority Foundation", "Priority Foundation", "Core", "Core", "General", "Critical", "Urgent"]
    pts = spark.createDataFrame([(p,) for p in ["0", "2", "3", "5", "6", "7", "8", "9", "10", ""]], "p string")
    assert [r[0] for r in pts.select(R.points_severity("p")).collect()] == [
        "Minor", "Minor", "Moderate", "Moderate", "Serious", "Serious", "Serious", "Serious", "Critical", "Minor"]


def test_score_result_and_risk(spark):
    df = spark.createDataFrame([(s,) for s in [None, "69", "70", "89", "90", "100", "101"]], "s string")
    got = rows(df.select(R.score_result("s").alias("r"), R.score_risk("s").alias("k")), "r", "k")
    assert got == [("UNKNOWN", "High Risk"), ("FAIL", "High Risk"), ("PASS_CONDITIONS", "Medium Risk"),
                   ("PASS_CONDITIONS", "Medium Risk"), ("PASS", "Low Risk"), ("PASS", "Low Risk"), ("PASS", "Low Risk")]


def test_risk_level_first_match(spark):
    vals = ["Risk 1 (High)", "Risk 2 (Medium)", "Risk 3 (Low)", "All", "2-HIGH", "4-NOT SPECIFIED"]
    df = spark.createDataFrame([(v,) for v in vals], "r string").withColumn("l", R.risk_level("r"))
    got = rows(df.withColumn("p", R.risk_priority("l")), "l", "p")
    assert got == [("High", 1), ("Medium", 2), ("Low", 3), ("Unknown", 99), ("High", 1), ("Unknown", 99)]


def test_categories(spark):
    df = spark.createDataFrame([("Canvass Re-Inspection",), ("Complaint",), ("License",), ("routine",),
                                ("Follow-up",)], "t string")
    assert [r[0] for r in df.select(R.inspection_category("t")).collect()] == [
        "Re-Inspection", "Complaint", "Other", "Routine", "Follow-up"]
    sev = spark.createDataFrame([(s,) for s in ["Critical", "Urgent", "Serious", "Moderate", "Minor"]], "s string")
    got = rows(sev.select(R.violation_category("s").alias("c"), R.is_critical_severity("s").alias("i")), "c", "i")
    assert got[0] == ("Food Safety - Critical", True) and got[3] == ("Sanitation - Moderate", False)
    assert got[4] == ("General Compliance", False)


def test_zip_and_blank(spark):
    df = spark.createDataFrame([(z,) for z in ["60614", "60614-1234", "6061", "abc", None, ""]], "z string")
    assert [r[0] for r in df.select(R.zip_invalid("z")).collect()] == [False, False, True, True, True, True]
    assert [r[0] for r in df.select(T.is_blank("z")).collect()] == [False, False, False, False, True, True]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a\t\tb \n c  ", "12abc", "(41.9, -87.6)", "5201")], "t string, n string, p string, z string")
    r = df.select(T.collapse_ws("t").alias("c"), T.to_number_lenient("n").alias("n"),
                  T.lat_from_point("p").alias("lat"), T.long_from_point("p").alias("lon"),
                  T.pad_left("z", 5).alias("z"), T.concat_blank(F.lit(None), F.lit("x")).alias("cb")).first()
    assert r["c"] == "a b c" and r["n"] == 12.0 and r["lat"] == "41.9" and r["lon"] == "-87.6"
    assert r["z"] == "05201" and r["cb"] == "x"


def test_parse_date_lenient(spark):
    df = spark.createDataFrame([("2024/01/31",), ("2024-01-31",), ("abc",)], "d string")
    got = [r[0] for r in df.select(T.parse_date("d", "yyyy/MM/dd")).collect()]
    assert str(got[0]) == "2024-01-31" and got[1] is None and got[2] is None


def test_city_b_comments(spark):
    df = spark.createDataFrame([("d", "m"), ("d", ""), ("", "m"), ("", "")], "d string, m string")
    assert [r[0] for r in df.select(R.city_b_comments("d", "m")).collect()] == ["d | m", "d |", "m", ""]


def test_epoch_micros_ignores_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.123456' t, timestamp'2024-01-02 03:04:05.123456' z")
    want = 1704164645123456
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/Chicago", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(K.epoch_micros("t", "timestamp_ntz").alias("a")).first()
            assert r.a == want
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert df.select(K.epoch_micros("z", "timestamp").alias("b")).first().b == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_typed_helpers_on_inferred_numeric_columns(spark):
    # a type-inferring load makes these numeric/boolean; the helpers must not
    # raise CAST_INVALID_INPUT under ANSI mode
    df = spark.createDataFrame([(95, 41.5, True, None)], "score int, lat double, flag boolean, city string")
    r = df.select(T.int_or_null("score").alias("s"), T.double_or_null("lat").alias("l"),
                  T.bool_text("flag").alias("f"), T.lower_or_null("city").alias("c")).first()
    assert (r.s, r.l, r.f, r.c) == (95, 41.5, True, None)


def test_is_blank_on_numbers(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    assert [r[0] for r in df.select(T.is_blank("n")).collect()] == [False, True]
