"""End to end on small synthetic city files built from the fixture schemas."""

import pytest
from pyspark.sql import functions as F

from stargrain.operators.facts import Lookup
from stargrain.plans import inspections as P
from stargrain.streaming import stores
from stargrain.streaming.history import metrics_total

A_ROWS = [
    # id, dba, aka, license, facility, risk, address, city, state, zip, date, type, results, violations, lat, lon, loc
    ["1001", "Cafe  One", None, "501", "Restaurant", "Risk 1 (High)", "1 Main St", "CHICAGO", "IL", "60614",
     "2024/01/05", "Canvass", "Pass", "1. FOOD SAFE - Comments: all good | 15. SINKS - Comments: CRITICAL leak",
     "41.9", "-87.6", "(41.9, -87.6)"],
    ["1002", "Deli\tTwo", "Two", "502", "Restaurant", "Risk 2 (Medium)", "2 Oak St", "Chicago", "IL", "60614-1234",
     "2024/01/06", "Complaint Re-Inspection", "Fail",
     "47. FOOD & NON-FOOD CONTACT - Comments: x | 3. NO COMMENT PART | 30. FLOORS - comments: URGENT fix | "
     "30. FLOORS - Comments: dup", "41.8", "-87.7", "(41.8, -87.7)"],
    ["1003", "Cafe One", None, "501", "Restaurant", "Risk 3 (Low)", "1 Main St", "Chicago", "IL", "6061",
     "2024/02/01", "Canvass", "Pass w/ Conditions", "14. PRIORITY FOUNDATION ITEM - Comments: " + "c" * 300,
     "", "", ""],
    ["1004", "", None, "", "Restaurant", None, "4 Elm St", "chicago", "IL", "abc", "bad-date", "License",
     "Out of Business", None, "", "", ""],
    ["1005", "Soup Bar", None, "505", "Restaurant", None, "5 Pine St", "Chicago", "IL", "60601",
     "2024/03/01", "Canvass", "Pass", "2. WATER - Comments: fine", "", "", ""],
    ["1006", "Noodle Hut", None, "506", "Restaurant", "All", "6 Oak St", "Chicago", "IL", None,
     "2024/03/02", "Routine", "No Entry", "29. SERIOUS HAZARD - Comments: fix now", "", "", ""],
    ["1007", "Pie Co", None, "507", "Bakery", "Risk 2 (Medium)", "7 Oak St", "Chicago", "IL", "60602",
     "2024/03/03", "Follow-up", "Business Not Located", "3. TEMPS - Comments: ok", "", "", ""],
]
# the same inspection id in a second file (keep-first takes the first file's row)
A_REPEAT = ["1001", "Cafe One", None, "501", "Restaurant", "Risk 1 (High)", "1 Main St", "Chicago", "IL", "60614",
            "2024/01/05", "Canvass", "Pass", "1. FOOD SAFE - Comments: second file copy", "41.9", "-87.6",
            "(41.9, -87.6)"]
B_SLOT_COLS = [c for i in range(1, 26) for c in P.city_b_slot_columns(i).values()]
B_HEADER = P.CITY_B_IDS[:-1] + B_SLOT_COLS


def b_row(name, date, score, slots, zip_code="75201", loc="(32.7, -96.8)"):
    base = {"Restaurant Name": name, "Inspection Type": "Routine", "Inspection Date": date, "Inspection Score": score,
            "Street Number": "10", "Street Name": "Elm", "Street Direction": "", "Street Type": "St",
            "Street Unit": "", "Street Address": "10 Elm St", "Zip Code": zip_code, "Inspection Month": "Jan 2024",
            "Inspection Year": "2024", "Lat Long Location": loc}
    for i, (d, p, det, memo) in enumerate(slots, start=1):
        cols = P.city_b_slot_columns(i)
        base[cols["Violation_Description"]] = d
        base[cols["Violation_Points"]] = p
        base[cols["Violation_Detail"]] = det
        base[cols["Violation_Memo"]] = memo
    return [base.get(c, "") for c in B_HEADER]


B_ROWS = [
    b_row("Taco Place", "2024-01-05", "95", [("*5 Food temp", "3", "detail", "memo"), ("*5 Food temp again", "2", "", ""),
                                             ("*12 Hands", "10", "", "memo only")]),
    b_row("Taco Place", "2024-01-05", "88", [("*7 Floors", "8", "d", "")], zip_code="5201"),   # same name+day: merged id
    b_row("Burger Hub", "2024-03-01", "101", [("No number here", "", "", "")]),
    b_row("Burger Hub", "2024-04-01", "92", [("*1 PRIORITY item", "6", "", ""), ("", "", "", ""),
                                             ("*2 ok", "0", "", "")], loc="unknown"),
    b_row("Grill A", "2024-05-01", None, [("*3 Hands", "3", "", "")]),
    b_row("Grill B", "2024-05-02", "69", [("*4 Sink", "2", "", "")]),
    b_row("Grill C", "2024-05-03", "70", [("*5 Floor", "1", "", "")]),
]


def _field(v):
    if v is None:
        return ""
    return '"' + v.replace('"', '""') + '"' if any(ch in v for ch in '\t\n"') else v


def _tsv(rows, header):
    lines = ["\t".join(header)] + ["\t".join(_field(v) for v in r) for r in rows]
    return ("\n".join(lines) + "\n").encode("latin-1")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("cities")
    (d / "a1.tsv").write_bytes(_tsv(A_ROWS[:2], P.CITY_A_COLUMNS))
    (d / "a2.tsv").write_bytes(_tsv(A_ROWS[2:] + [A_REPEAT], P.CITY_A_COLUMNS))
    (d / "b1.tsv").write_bytes(_tsv(B_ROWS, B_HEADER))
    return [str(d / "a1.tsv"), str(d / "a2.tsv")], [str(d / "b1.tsv")]


@pytest.fixture(scope="module")
def uni(spark, files):
    return P.unified(spark, *files).cache()


def test_unified_shape_and_parse(uni):
    assert uni.columns == P.UNIFIED_COLUMNS
    a = {(r.inspection_id, r.violation_code): r for r in uni.where("source_city = 'Chicago'").collect()}
    # hyphen before "- Comments:" and missing comments do not parse; lower-case comments: does
    assert set(a) == {("1001", "1"), ("1001", "15"), ("1002", "30"), ("1003", "14"), ("1005", "2"),
                      ("1006", "29"), ("1007", "3")}
    assert a[("1001", "1")].violation_comments_original == "all good"      # first file wins
    assert a[("1006", "29")].violation_severity == "Critical"               # SERIOUS -> critical flag
    assert a[("1006", "29")].results_std == "NO_ENTRY" and a[("1006", "29")].violation_score == "0"
    assert a[("1007", "3")].results_std == "NOT_LOCATED" and a[("1007", "3")].violation_score is None
    assert a[("1001", "15")].violation_severity == "Critical"
    assert a[("1001", "1")].violation_severity == "Priority Foundation"
    assert a[("1002", "30")].violation_comments_original == "URGENT fix"       # keep-first of the duplicate code
    assert a[("1002", "30")].violation_severity == "Urgent"
    assert len(a[("1003", "14")].violation_comments_original) == 300        # texts stay whole
    assert a[("1001", "1")].inspection_date == "2024-01-05"
    assert a[("1001", "1")].all_violation_codes == "1|15" and a[("1001", "15")].violation_sequence == "2"
    assert a[("1001", "1")].dba_name == "Cafe One" and a[("1002", "30")].dba_name == "Deli Two"


def test_city_b_rules(uni):
    b = uni.where("source_city = 'Dallas'").collect()
    taco = [r for r in b if r.dba_name == "TACO PLACE"]
    assert len({r.inspection_id for r in taco}) == 1              # same name + day merge (trap 2)
    codes = sorted(r.violation_code for r in taco)
    assert codes == ["12", "5", "7"]                               # duplicate *5 collapsed by keep-first
    r5 = [r for r in taco if r.violation_code == "5"][0]
    assert r5.violation_comments_original == "detail | memo" and r5.violation_severity == "Moderate"
    r12 = [r for r in taco if r.violation_code == "12"][0]
    assert r12.is_violation_critical == "True" and r12.is_violation_urgent == "True"
    assert r12.violation_comments_original == "memo only"
    assert {r.violation_sequence for r in taco} == {"1", "2", "3"}
    assert all(r.license_number == "DALLAS-" + r.inspection_id for r in b)
    assert {r.zip_code for r in taco} <= {"75201", "05201"}
    res = {r.dba_name: r.results_std for r in b}
    assert res["GRILL A"] == "UNKNOWN" and res["GRILL B"] == "FAIL" and res["GRILL C"] == "PASS_CONDITIONS"
    risk = {r.dba_name: r.risk_category for r in b}
    assert risk["GRILL A"] == "High Risk" and risk["GRILL C"] == "Medium Risk"
    bh = [r for r in b if r.dba_name == "BURGER HUB"]
    assert sorted(r.violation_code for r in bh) == ["0", "1", "2"]
    assert [r.latitude for r in bh if r.violation_code == "1"] == [""]


def test_silver_typed_and_star(spark, uni):
    br = P.bronze(uni)
    sv = P.silver(br)
    m = {r.rule: (r.passed, r.failed) for r in P.silver_metrics(br).collect()}
    assert sum(m["valid_dallas_score"]) == br.count()
    assert sv.where("source_city = 'Dallas' AND TRY_CAST(violation_score AS INT) > 100").count() == 0
    t = P.typed(sv).cache()
    assert dict(t.dtypes)["inspection_date"] == "date" and dict(t.dtypes)["violation_score"] == "int"
    g = P.star(t)
    assert g["dim_date"].count() == 4018
    for name, bk in [("dim_location", "location_business_key"), ("dim_violation", "violation_business_key"),
                     ("dim_inspection_type", "inspection_type_business_key"),
                     ("dim_inspection_result", "result_business_key"), ("dim_risk_category", "risk_business_key")]:
        d = g[name]
        assert d.count() == d.select(bk).distinct().count(), name
    fact = g["fact_food_inspections"]
    n_insp = t.select(F.concat("inspection_id", F.lit("-"), "city")).distinct().count()
    assert fact.count() == n_insp
    # both cities' inspections have their date and reach the restaurant dimension
    assert fact.where("city = 'chicago' AND inspection_id <> '1004' AND (date_key IS NULL OR restaurant_key IS NULL)").count() == 0
    assert g["dim_restaurant"].where("city = 'chicago'").count() > 1
    assert fact.where("restaurant_key IS NULL AND inspection_date IS NOT NULL").count() == 0
    assert fact.where("city = 'dallas' AND restaurant_key IS NULL").count() == 0
    br_rows = g["bridge_inspection_violation"].count()
    assert br_rows == t.count()
    # trap 6: the fact maps a NULL risk to Unknown|99, the dimension drops NULL
    # risks, so without another source of "Unknown" the foreign key is NULL
    # ("All" maps to Unknown, so here the NULL-risk fact row does find a key)
    r1005 = fact.where("inspection_id = '1005'").first()
    unknown = g["dim_risk_category"].where("risk_level = 'Unknown'").collect()
    assert len(unknown) == 1 and r1005 is not None
    assert r1005.risk_category_key == unknown[0].risk_category_key
    # without the "All" row nothing maps to Unknown and the same fact row gets a NULL key
    g2 = P.star(t.where("inspection_id != '1006'"))
    assert g2["dim_risk_category"].where("risk_level = 'Unknown'").count() == 0
    assert g2["fact_food_inspections"].where("inspection_id = '1005'").first().risk_category_key is None
    # trap 2: a city B restaurant id is unique per inspection date -> one version each
    rest_b = g["dim_restaurant"].where("city = 'dallas'")
    assert rest_b.count() == rest_b.select("restaurant_id").distinct().count()
    rest = g["dim_restaurant"]
    assert rest.groupBy("restaurant_id").agg(F.sum(F.col("is_current").cast("int")).alias("c")) \
        .where("c != 1").count() == 0


@pytest.mark.parametrize("change_feed", [False, True])
def test_streaming_tables_equal_batch(spark, uni, tmp_path, change_feed):
    from stargrain.sources.changes import diff_snapshots
    udir = str(tmp_path / "unified")
    # one violation per inspection, so that the streams' arbitrary survivors are the batch ones
    src = uni.where("violation_sequence = '1'")
    if change_feed:
        keyed = src.withColumn("row_id", F.xxhash64(*src.columns))
        empty = spark.createDataFrame([], keyed.schema)
        diff_snapshots(empty, keyed, ["row_id"], version=1, commit_ts="2024-01-01 00:00:00").drop("row_id").write.parquet(udir)
    else:
        src.repartition(3).write.parquet(udir)
    out = P.stream_tables(spark, udir, str(tmp_path / "gold"), change_feed=change_feed, late_rows=not change_feed)
    counted = {(r.rule, r.passed, r.failed) for r in metrics_total(spark, out["metrics"]).collect()}
    assert counted == {(r.rule, r.passed, r.failed) for r in P.silver_metrics(P.bronze(src)).collect()}
    batch = P.star(P.typed(P.silver(P.bronze(src))))
    for name, want in batch.items():
        got = spark.read.parquet(out[name])
        assert got.columns == want.columns, name
        if name == "dim_location":  # the survivor of two spellings of one address is arbitrary in a stream
            got, want = got.select("location_key"), want.select("location_key")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_streamed_facts_wait_for_their_dimension_rows(spark, uni, tmp_path):
    """Facts loaded while the risk dimension is empty end with its keys once its rows are there."""
    t = P.typed(P.silver(P.bronze(uni.where("violation_sequence = '1'"))))
    dim, path, root = P.dimensions(t)["dim_risk_category"], str(tmp_path / "dim"), str(tmp_path / "fact")
    dim.where("false").write.parquet(path)
    facts = P.inspection_rows(t).select("inspection_business_key", "risk_business_key")
    body = stores.late_lookups(root, lambda s: [Lookup(s.read.parquet(path), "risk_business_key", "risk_category_key")])
    body(facts, 0)
    assert {r.risk_category_key for r in stores.late_table(spark, root).collect()} == {None}
    dim.write.mode("append").parquet(path)
    body(facts.where("false"), 1)
    got = stores.late_table(spark, root)
    want = facts.join(dim.select("risk_business_key", "risk_category_key"), "risk_business_key", "left").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.where("risk_category_key IS NOT NULL").count() > 0


def test_city_b_slots_with_missing_columns(spark, files):
    from stargrain.sources.delimited import read_delimited
    raw = read_delimited(spark, files[1], multiline=True)
    fewer = raw.drop("Violation Memo - 1", "Violation Points - 2")
    full, part = P.city_b_unified(raw), P.city_b_unified(fewer)
    keys = ["inspection_id", "violation_code", "violation_description"]
    assert part.select(*keys).exceptAll(full.select(*keys)).count() == 0 and part.count() == full.count()


def test_city_b_numbers_too_long_for_an_integer(spark, tmp_path):
    rows = [b_row("Long Co", "2024-06-01", "95", [("*99999999999 big", "1", "", ""), ("*" + "9" * 30 + " bigger", "1", "", "")])]
    (tmp_path / "b.tsv").write_bytes(_tsv(rows, B_HEADER))
    from stargrain.sources.delimited import read_delimited
    got = {r.violation_code for r in P.city_b_unified(read_delimited(spark, str(tmp_path / "b.tsv"), multiline=True)).collect()}
    assert got == {"99999999999", None}


def test_an_id_with_two_sets_of_attributes_meets_both_summaries(spark, tmp_path):
    rows = [A_ROWS[0], [*A_ROWS[0][:12], "Fail", "2. WATER - Comments: x", *A_ROWS[0][14:]]]
    (tmp_path / "a.tsv").write_bytes(_tsv(rows, P.CITY_A_COLUMNS))
    from stargrain.sources.delimited import read_delimited
    got = sorted((r.violation_code, r.violation_count) for r in P.city_a_unified(read_delimited(spark, str(tmp_path / "a.tsv"))).collect())
    assert got == [("1", "1"), ("1", "2"), ("15", "1"), ("15", "2"), ("2", "1"), ("2", "2")]


def test_numbers_are_written_plainly_only_if_all_values_are_numbers(spark):
    from stargrain.operators.cleanse import auto_text
    df = spark.createDataFrame([("60614.0", "00501", "+7"), ("60615", "10001", "x"), (None, None, None)], "a string, b string, c string")
    assert [tuple(r) for r in auto_text(df, ["a", "b", "c"]).collect()] == [("60614", "00501", "+7"), ("60615", "10001", "x"), (None, None, None)]


def test_published_tables_answer_adhoc_sql(spark, uni, tmp_path):
    P.publish(spark, uni, str(tmp_path / "tables"))
    rows = {n: spark.table(n).count() for n in ("source_food_inspections_data", "fact_food_inspections", "bridge_inspection_violation")}
    assert rows["source_food_inspections_data"] == uni.count() and rows["fact_food_inspections"] >= 1
    # every bridge row has its inspection, every fact key its dimension row
    assert spark.sql("SELECT 1 FROM bridge_inspection_violation ANTI JOIN fact_food_inspections USING (inspection_key)").isEmpty()
    assert spark.sql("SELECT 1 FROM fact_food_inspections ANTI JOIN dim_location USING (location_key)").isEmpty()
    spans = spark.sql("SELECT restaurant_id, sum(int(is_current)) AS open, count(*) AS n, max(row_version) AS last FROM dim_restaurant GROUP BY 1").collect()
    assert spans and all(r.open == 1 and r.n == r.last for r in spans)
    assert spark.sql("DESCRIBE TABLE fact_food_inspections").first().col_name == "inspection_key"


def test_unified_csv_round_trip(spark, uni, tmp_path):
    """The file boundary between the workflows and the cluster load: the
    unified table written as CRLF/Latin-1 CSV and read back all-string."""
    from stargrain.sources.delimited import read_delimited, write_delimited
    out = str(tmp_path / "unified_csv")
    write_delimited(uni.coalesce(1), out)
    back = read_delimited(spark, f"{out}/*.csv", sep=",", multiline=True, source_file=None)
    assert back.columns == P.UNIFIED_COLUMNS
    norm = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in P.UNIFIED_COLUMNS]   # CSV has no NULL vs ''
    a, b = uni.select(*norm), back.select(*norm)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_star_over_type_inferred_load(spark, uni, tmp_path):
    """The reference loads the unified CSV with inferSchema (numbers, dates and
    booleans come back typed); the silver rules and the typed layer must still
    work under ANSI mode (no CAST_INVALID_INPUT from comparisons with '')."""
    from stargrain.sources.delimited import read_inferred_csv, write_delimited
    out = str(tmp_path / "u")
    write_delimited(uni.coalesce(1), out, encoding="UTF-8", line_sep="\n")
    inferred = read_inferred_csv(spark, out)
    assert dict(inferred.dtypes)["violation_count"] in ("int", "bigint")
    t = P.typed(P.silver(P.bronze(inferred)))
    g = P.star(t)
    assert g["fact_food_inspections"].count() == \
        P.star(P.typed(P.silver(P.bronze(uni))))["fact_food_inspections"].count()


def test_audit_columns_in_published_tables(spark, uni, tmp_path):
    P.publish(spark, uni, str(tmp_path / "t2"))
    cols = {n: set(spark.table(n).columns) for n in ["bronze_food_inspections", "silver_food_inspections",
                                                       "silver_food_inspections_transformed", "fact_food_inspections",
                                                       "bridge_inspection_violation", "dim_restaurant"]}
    assert {"bronze_load_timestamp", "bronze_load_date", "source_system"} <= cols["bronze_food_inspections"]
    assert "silver_load_timestamp" in cols["silver_food_inspections"]
    assert "typed_load_timestamp" in cols["silver_food_inspections_transformed"]
    assert "load_timestamp" in cols["fact_food_inspections"] and "load_timestamp" in cols["bridge_inspection_violation"]
    assert "load_at" in cols["dim_restaurant"]
