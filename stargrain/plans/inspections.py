"""The food-inspection flow of the reference, composed from stargrain operators.

Two raw city layouts -> one unified 35-column table -> bronze (all strings)
-> silver (expectations) -> typed silver -> star schema (7 dimensions, SCD2
restaurant dimension, fact, bridge).  Workflow steps of the desktop tool
become DataFrame steps; the hosted pipeline's tables become functions.

Order-dependent steps use explicit orderings (the tool relies on row
arrival order): keep-first uses (file name, piece position, all columns)
as the tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stargrain.functions import keys as K
from stargrain.functions import rules as R
from stargrain.functions.text import (bool_text, double_or_null, int_or_null, is_blank, lat_from_point,
                                      long_from_point, lower_or_null, pad_left, parse_date, point_text,
                                      to_number_lenient)
from stargrain.operators.cleanse import auto_text, cleanse
from stargrain.operators.dims import calendar_dimension, hash_dimension
from stargrain.operators.facts import Lookup, build_bridge, lookup_keys
from stargrain.operators.ordered import sequence
from stargrain.operators.quality import Expectation, kept, metrics, observe_stream
from stargrain.operators.reshape import packed_slots, regex_parse, slots_to_rows, split_to_rows
from stargrain.operators.rows import unique_first
from stargrain.operators.scd2 import scd2_apply, scd2_current, scd2_final, scd2_stage
from stargrain.operators.summarize import any_true, concat_agg, mode_agg, summarize_back
from stargrain.session import partitions_for
from stargrain.sources.delimited import read_delimited

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (column names and layouts).
# ---------------------------------------------------------------------------
CITY_A_COLUMNS = ["Inspection ID", "DBA Name", "AKA Name", "License #", "Facility Type", "Risk", "Address", "City",
                  "State", "Zip", "Inspection Date", "Inspection Type", "Results", "Violations", "Latitude",
                  "Longitude", "Location"]
CITY_A_GROUP = ["Inspection ID", "DBA Name", "AKA Name", "License #", "Facility Type", "Risk", "Address", "City",
                "State", "Zip", "Inspection Date", "Inspection Type", "Results", "Latitude", "Longitude",
                "inspection_date_std", "inspection_year", "inspection_month", "inspection_quarter",
                "derived_violation_score", "results_std"]
CITY_B_IDS = ["Restaurant Name", "Inspection Type", "Inspection Date", "Inspection Score", "Street Number",
              "Street Name", "Street Direction", "Street Type", "Street Unit", "Street Address", "Zip Code",
              "Inspection Month", "Inspection Year", "Lat Long Location", "FileName"]
CITY_B_SLOTS = 25
INSPECTION_BYTES = 1 << 20   # bytes of the input files for each partition of the shuffles by inspection
# the fields that AutoField finds to be numbers
CITY_A_NUMBERS = ["Inspection ID", "License #", "Zip"]
CITY_B_NUMBERS = ["Inspection Score", "Street Number", "Zip Code"]
VIOLATION_PATTERN = R.VIOLATION_PATTERN
UNIFIED_COLUMNS = [
    "inspection_id", "dba_name", "aka_name", "license_number", "facility_type", "risk_category", "address", "city",
    "state", "zip_code", "inspection_date", "inspection_type", "latitude", "longitude", "location",
    "source_filename", "inspection_year", "inspection_month", "inspection_quarter", "violation_score",
    "results_std", "violation_code", "violation_description", "violation_comments_original",
    "is_violation_critical", "is_violation_urgent", "violation_severity", "violation_sequence", "violation_count",
    "all_violation_codes", "critical_violation", "urgent_violation", "all_violation_descriptions", "source_city",
    "filename"]
CALENDAR_START, CALENDAR_END = "2018-01-01", "2028-12-31"
SOURCE_SYSTEM = "desktop_etl"   # audit label of the bronze rows (never compared)
# names of the data quality rules
RULE_NAMES = ["valid_restaurant_name", "valid_inspection_date", "valid_inspection_type", "valid_zip_code", "valid_chicago_results",
              "valid_dallas_score", "has_at_least_one_violation", "valid_dallas_high_score_violations", "valid_dallas_pass_no_critical_urgent"]
# columns of the published star tables
FACT_COLUMNS = ["inspection_key", "inspection_business_key", "restaurant_key", "date_key", "location_key", "inspection_type_key",
                "inspection_result_key", "risk_category_key", "violation_score", "violation_count", "critical_violation",
                "urgent_violation", "inspection_id", "license_number", "city", "inspection_date"]
BRIDGE_COLUMNS = ["inspection_key", "violation_key", "violation_sequence", "is_violation_critical", "is_violation_urgent", "violation_score",
                  "violation_code", "violation_description", "violation_comments_original", "violation_severity"]
RESTAURANT_COLUMNS = ["restaurant_key", "restaurant_id", "license_number", "dba_name", "aka_name", "facility_type", "risk_category", "city",
                      "effective_date", "expiration_date", "is_current", "row_version"]
RESTAURANT_ATTRIBUTES = ["license_number", "dba_name", "aka_name", "facility_type", "risk_category", "city"]
# ---------------------------------------------------------------------------


def city_b_slot_columns(i: int) -> dict[str, str]:
    memo = "Violation  Memo - 20" if i == 20 else f"Violation Memo - {i}"   # two blanks in slot 20
    return {"Violation_Description": f"Violation Description - {i}", "Violation_Points": f"Violation Points - {i}",
            "Violation_Detail": f"Violation Detail - {i}", "Violation_Memo": memo}


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _text(c: Column) -> Column:
    """Value as written to the unified delimited file (booleans as True/False)."""
    return c.cast("string")


def _bool_text(c: Column) -> Column:
    return F.when(c, F.lit("True")).when(~c, F.lit("False"))


# ---------------------------------------------------------------------------
# City A: packed violation text
# ---------------------------------------------------------------------------
def city_a_unified(raw: DataFrame, output_file: str = "Chicago.csv", field_width: int | None = None, flags: bool = False) -> DataFrame:
    """``field_width`` cuts the parsed violation fields (the workflow's own field size is 254); by default they stay whole.
    ``flags`` adds the two flags across an inspection's rows that the workflow computes and drops before the union (B15)."""
    df = cleanse(raw, collapse=True, trim=True, drop_null_rows=True)                      # R7
    df = auto_text(df, CITY_A_NUMBERS)                                                     # R5
    df = (df.withColumn("inspection_date_std", parse_date(_c("Inspection Date"), "yyyy/MM/dd"))   # F7
            .withColumn("inspection_year", F.year("inspection_date_std"))
            .withColumn("inspection_month", F.month("inspection_date_std"))
            .withColumn("inspection_quarter", F.quarter("inspection_date_std"))
            .withColumn("derived_violation_score", R.city_a_score(_c("Results")))          # B2
            .withColumn("results_std", R.city_a_result(_c("Results"))))                    # B3
    # all that follows stays within an inspection: its rows are brought together while they are still packed, and each
    # different set of what they share gets a number, which stands for it in the steps on violations
    shared = [c for c in CITY_A_GROUP if c != "Inspection ID"]
    df = df.where(_c("Inspection ID").isNotNull()).repartition(partitions_for(raw, INSPECTION_BYTES), _c("Inspection ID"))
    number = F.dense_rank().over(Window.partitionBy(_c("Inspection ID")).orderBy(*[_c(c) for c in shared]))
    df = df.select("Inspection ID", number.alias("_set"), *[_c(c) for c in [*shared, *[c for c in df.columns if c not in CITY_A_GROUP]]])
    df = split_to_rows(df, "Violations", "|", pos="_piece")                                # R1
    df = regex_parse(df, "Violations", VIOLATION_PATTERN,                                  # R6
                     ["violation_code", "violation_description", "violation_comments"], ignore_case=True,
                     max_len=field_width)
    df = cleanse(df, ["violation_code", "violation_description", "violation_comments"],   # R8
                 collapse=True, trim=True, drop_null_rows=False)
    df = df.withColumn("violation_comments", F.when(is_blank("violation_comments"), F.lit(""))
                       .otherwise(F.trim("violation_comments")))
    crit, urg = R.city_a_violation_flags("violation_description", "violation_comments")   # B5
    df = (df.withColumn("is_violation_critical", crit).withColumn("is_violation_urgent", urg)
            .withColumn("_number", to_number_lenient("violation_code"))
            .withColumn("violation_severity", R.city_a_severity("is_violation_critical", "is_violation_urgent",
                                                                 "violation_code", "_number")).drop("_number"))       # B6
    df = df.where((F.trim("violation_code") != "") & (F.trim("violation_description") != ""))   # P6: neither NULL nor blank
    df = df.withColumn("_code_num", F.col("violation_code").try_cast("bigint"))
    df = unique_first(df, ["Inspection ID", "violation_code"], ["FileName", "_piece"], carried=shared)     # A5
    df = sequence(df, ["Inspection ID"], ["_code_num", "violation_code"], out="violation_sequence")  # O1 + W1
    df = df.where(F.col("violation_sequence") >= 1)                                       # P8 guard
    # A1 and J2, on the id alone as the workflow does: an id with two sets of attributes has two
    # summaries, and each of its rows meets both
    df = summarize_back(df, "Inspection ID", ["Inspection ID", "_set"], {
        "violation_count": lambda w: F.count("violation_code").over(w),
        "all_violation_codes": lambda w: concat_agg("violation_code", "|", ["violation_sequence"], over=w),
        "critical_violation": lambda w: any_true("is_violation_critical", over=w),
        "urgent_violation": lambda w: any_true("is_violation_urgent", over=w),
        "all_violation_descriptions": lambda w: concat_agg("violation_description", "|", ["violation_sequence"], over=w),
        "total_violations": lambda w: F.max("violation_sequence").over(w)})
    out = df.select(
        _c("Inspection ID").alias("inspection_id"), _c("DBA Name").alias("dba_name"),
        _c("AKA Name").alias("aka_name"), _c("License #").alias("license_number"),
        _c("Facility Type").alias("facility_type"), _c("Risk").alias("risk_category"),
        _c("Address").alias("address"), _c("City").alias("city"), _c("State").alias("state"),
        _c("Zip").alias("zip_code"), F.col("inspection_date_std").cast("string").alias("inspection_date"),
        _c("Inspection Type").alias("inspection_type"), _c("Latitude").alias("latitude"),
        _c("Longitude").alias("longitude"), _c("Location").alias("location"),
        _c("FileName").alias("source_filename"),
        _text(F.col("inspection_year")).alias("inspection_year"),
        _text(F.col("inspection_month")).alias("inspection_month"),
        _text(F.col("inspection_quarter")).alias("inspection_quarter"),
        _text(F.col("derived_violation_score")).alias("violation_score"), "results_std",
        "violation_code", "violation_description", F.col("violation_comments").alias("violation_comments_original"),
        _bool_text(F.col("is_violation_critical")).alias("is_violation_critical"),
        _bool_text(F.col("is_violation_urgent")).alias("is_violation_urgent"), "violation_severity",
        _text(F.col("violation_sequence")).alias("violation_sequence"),
        _text(F.col("violation_count")).alias("violation_count"), "all_violation_codes",
        _bool_text(F.col("critical_violation")).alias("critical_violation"),
        _bool_text(F.col("urgent_violation")).alias("urgent_violation"), "all_violation_descriptions",
        F.lit("Chicago").alias("source_city"), F.lit(output_file).alias("filename"),
        *_cross_flags(flags, "derived_violation_score"))
    return out


def _cross_flags(wanted: bool, score: str) -> list[Column]:
    found = R.cross_flags(score, "violation_count", "results_std", "critical_violation") if wanted else {}
    return [_bool_text(c).alias(name) for name, c in found.items()]


# ---------------------------------------------------------------------------
# City B: 25 slot groups side by side
# ---------------------------------------------------------------------------
def city_b_unified(raw: DataFrame, output_file: str = "Dallas.csv", comment_width: int | None = None,
                   alias_width: int | None = None, flags: bool = False) -> DataFrame:
    """``flags`` adds B15's two flags, as for the other city.  ``comment_width`` and ``alias_width`` cut the comments and the alias (the workflow's own field sizes are 2000
    and 50); by default they stay whole.  A slot column that the file lacks counts as empty."""
    cut = lambda c, n: c if n is None else F.substring(c, 1, n)
    # R7 is done on a row's own columns here, on the fields of its slots when these are rows: an empty slot stays empty
    slots = [city_b_slot_columns(i) for i in range(1, CITY_B_SLOTS + 1)]
    fields = [c for s in slots for c in s.values() if c in raw.columns]
    df = cleanse(raw, [c for c in raw.columns if c not in fields], collapse=True, trim=True, drop_null_rows=True)    # R7
    typed_slots = [{f: _c(c) if c in fields else F.lit(None).cast("string") for f, c in s.items()} for s in slots]
    df = df.select(*[_c(c) for c in df.columns if c not in fields], packed_slots(df, typed_slots, slot_col="_slot").alias("_slots"))    # R2
    df = auto_text(df, [c for c in CITY_B_NUMBERS if c in df.columns])                         # R5
    date_txt = F.date_format(parse_date(_c("Inspection Date"), "yyyy-MM-dd"), "yyyy-MM-dd")
    df = (df.withColumn("inspection_id", F.md5(F.concat(F.coalesce(_c("Restaurant Name"), F.lit("")), F.lit("|"),
                                                        F.coalesce(date_txt, F.lit("")))))   # F8
            .withColumn("inspection_date_std", parse_date(_c("Inspection Date"), "yyyy-MM-dd"))
            .withColumn("inspection_year", F.year("inspection_date_std"))
            .withColumn("inspection_month", F.month("inspection_date_std"))
            .withColumn("inspection_quarter", F.quarter("inspection_date_std"))
            .withColumn("results_std", R.score_result(_c("Inspection Score")))               # B7
            .withColumn("address", R.street_address(_c("Street Number"), _c("Street Name"), _c("Street Direction"),
                                                    _c("Street Type"), _c("Street Unit")))          # B12
            .withColumn("zip_code", F.when(_c("Zip Code").isNotNull(), pad_left(_c("Zip Code"), 5))
                        .otherwise(F.lit("")))
            .withColumn("license_number", F.concat(F.lit("DALLAS-"), F.col("inspection_id")))
            .withColumn("dba_name", F.trim(F.upper(_c("Restaurant Name"))))
            .withColumn("aka_name", cut(F.col("dba_name"), alias_width))
            .withColumn("risk_category", R.score_risk(_c("Inspection Score")))                     # B13
            .withColumn("facility_type", F.lit("Restaurant")))
    # as for the other city: one shuffle of packed rows, and a number for each different set of what an inspection's rows share
    shared = [*[c for c in CITY_B_IDS if c != "FileName"], *[c for c in df.columns if c not in raw.columns and c not in ("inspection_id", "_slots")]]
    df = df.repartition(partitions_for(raw, INSPECTION_BYTES), "inspection_id")
    number = F.dense_rank().over(Window.partitionBy("inspection_id").orderBy(*[_c(c) for c in shared]))
    df = df.select("inspection_id", number.alias("_set"), *[_c(c) for c in shared], "FileName", "_slots")
    df = slots_to_rows(df, ["inspection_id", "_set", *shared, "FileName"], "_slots")      # R2+R3 fused (R4)
    df = cleanse(df, list(slots[0]), collapse=True, trim=True, drop_null_rows=False)       # R7
    df = df.where(F.trim("Violation_Description") != "")                                     # P7: neither NULL nor blank
    desc_num = to_number_lenient(F.regexp_replace("Violation_Description", r"\*(\d+)", "$1"))
    df = (df.withColumn("violation_number", desc_num.try_cast("bigint"))                    # B14 (overwrites slot no.)
            .withColumn("violation_code", F.col("violation_number").cast("string"))
            .withColumn("Violation_Description", F.trim("Violation_Description"))
            .withColumn("Violation_Points", F.when(is_blank("Violation_Points"), F.lit(0.0))
                        .otherwise(to_number_lenient("Violation_Points")))                     # B8
            .withColumn("Violation_Detail", F.coalesce(F.trim("Violation_Detail"), F.lit("")))
            .withColumn("Violation_Memo", F.coalesce(F.trim("Violation_Memo"), F.lit("")))
            .withColumn("violation_comments_clean",
                        cut(R.city_b_comments("Violation_Detail", "Violation_Memo"), comment_width))    # B9
            .withColumn("_number", to_number_lenient("Violation_Points")))
    crit, urg = R.city_b_violation_flags("Violation_Description", "violation_comments_clean", "Violation_Points", "_number")
    df = (df.withColumn("is_violation_critical", crit).withColumn("is_violation_urgent", urg)      # B10
            .withColumn("violation_severity", R.points_severity("Violation_Points", "_number")).drop("_number"))   # B11
    df = unique_first(df, ["inspection_id", "violation_code"], ["FileName", "_slot"], carried=shared)       # O1 + A5 after sort
    df = sequence(df, ["inspection_id"], ["violation_code", "_slot"], out="violation_sequence")  # W1
    df = df.where(F.col("violation_sequence") >= 1)                                       # P8 guard
    df = summarize_back(df, "inspection_id", ["inspection_id"], {                            # A2, J2
        "violation_count": lambda w: F.count("violation_code").over(w),
        "critical_violation": lambda w: any_true("is_violation_critical", over=w),
        "urgent_violation": lambda w: any_true("is_violation_urgent", over=w),
        "total_violation_points": lambda w: F.sum("Violation_Points").over(w),
        "all_violation_codes": lambda w: concat_agg("violation_code", "|", ["violation_sequence"], over=w),
        "all_violation_descriptions": lambda w: concat_agg("Violation_Description", "|", ["violation_sequence"], over=w),
        "total_violations": lambda w: F.max("violation_sequence").over(w),
        "mode_violation_code": lambda w: mode_agg("violation_code", over=w)})
    loc = _c("Lat Long Location")
    lat, lon = lat_from_point(loc), long_from_point(loc)                                     # F16
    return df.select(
        "inspection_id", "dba_name", "aka_name", "license_number", "facility_type", "risk_category", "address",
        F.lit("Dallas").alias("city"), F.lit("Texas").alias("state"), "zip_code",
        F.col("inspection_date_std").cast("string").alias("inspection_date"),
        _c("Inspection Type").alias("inspection_type"), lat.alias("latitude"), lon.alias("longitude"),
        point_text(lat, lon).alias("location"), _c("FileName").alias("source_filename"),
        _text(F.col("inspection_year")).alias("inspection_year"),
        _text(F.col("inspection_month")).alias("inspection_month"),
        _text(F.col("inspection_quarter")).alias("inspection_quarter"),
        _c("Inspection Score").alias("violation_score"), "results_std", "violation_code",
        F.col("Violation_Description").alias("violation_description"),
        F.col("violation_comments_clean").alias("violation_comments_original"),
        _bool_text(F.col("is_violation_critical")).alias("is_violation_critical"),
        _bool_text(F.col("is_violation_urgent")).alias("is_violation_urgent"), "violation_severity",
        _text(F.col("violation_sequence")).alias("violation_sequence"),
        _text(F.col("violation_count")).alias("violation_count"), "all_violation_codes",
        _bool_text(F.col("critical_violation")).alias("critical_violation"),
        _bool_text(F.col("urgent_violation")).alias("urgent_violation"), "all_violation_descriptions",
        F.lit("Dallas").alias("source_city"), F.lit(output_file).alias("filename"),
        *_cross_flags(flags, "total_violation_points"))


def unified(spark: SparkSession, city_a_paths: list[str], city_b_paths: list[str]) -> DataFrame:
    """S1-S4 scans of both layouts -> the 35 aligned columns (O5), all strings."""
    a = city_a_unified(read_delimited(spark, city_a_paths, sep="\t"))
    b = city_b_unified(read_delimited(spark, city_b_paths, sep="\t", multiline=True))
    return a.select(*UNIFIED_COLUMNS).unionByName(b.select(*UNIFIED_COLUMNS))


# ---------------------------------------------------------------------------
# Bronze / silver / typed silver
# ---------------------------------------------------------------------------
def _filled(column: str) -> str:
    return f"coalesce(length({column}), 0) > 0"


def _only_in(city: str, condition: str) -> str:
    """A rule for one city's rows: true for those of another (unknown if the city is)."""
    return f"CASE WHEN source_city <> '{city}' THEN true WHEN source_city = '{city}' THEN ({condition}) END"


def _number(column: str) -> str:
    return f"try_cast({column} AS int)"


_CONDITIONS = [
    _filled("dba_name"), _filled("inspection_date"), _filled("inspection_type"), "length(zip_code) IN (4, 5)",
    _only_in("Chicago", "results_std IS NOT NULL"), _only_in("Dallas", f"{_number('violation_score')} <= 100"), f"{_number('violation_count')} >= 1",
    _only_in("Dallas", f"violation_score IS NULL OR violation_count IS NULL OR {_number('violation_score')} < 90 OR {_number('violation_count')} <= 3"),
    _only_in("Dallas", "results_std <> 'PASS' OR (critical_violation = 'False' AND urgent_violation = 'False')"),
]
# the first four only count, the others drop
SILVER_RULES = [Expectation(name, condition, "warn" if i < 4 else "drop") for i, (name, condition) in enumerate(zip(RULE_NAMES, _CONDITIONS))]


def bronze(df: DataFrame, audit: bool = False) -> DataFrame:
    """Raw rows as received (the all-string unified table) + source system;
    ``audit`` adds the load timestamp and date (S13)."""
    out = df.withColumn("source_system", F.lit(SOURCE_SYSTEM))
    if audit:
        out = out.withColumn("bronze_load_timestamp", F.current_timestamp()) \
            .withColumn("bronze_load_date", F.current_date())
    return out


def silver(bronze_df: DataFrame, audit: bool = False) -> DataFrame:
    out = kept(bronze_df, SILVER_RULES)
    return out.withColumn("silver_load_timestamp", F.current_timestamp()) if audit else out


def silver_metrics(bronze_df: DataFrame) -> DataFrame:
    return metrics(bronze_df, SILVER_RULES)


# how each text column of the unified table is typed; the others stay text
_TYPES = {
    bool_text: [c for c in UNIFIED_COLUMNS if c.endswith(("_critical", "_urgent")) or c in ("critical_violation", "urgent_violation")],
    int_or_null: ["violation_score", *[c for c in UNIFIED_COLUMNS if c.endswith(("_count", "_sequence", "_year", "_month", "_quarter"))]],
    double_or_null: ["latitude", "longitude"],
    lower_or_null: ["city"],
    (lambda c: F.try_to_date(F.col(c).cast("string"))): ["inspection_date"],
}


def typed(silver_df: DataFrame, audit: bool = False) -> DataFrame:
    """T2 typed silver (same function for batch and stream)."""
    out = silver_df.withColumns({c: how(c) for how, columns in _TYPES.items() for c in columns})
    return out.withColumn("typed_load_timestamp", F.current_timestamp()) if audit else out


# ---------------------------------------------------------------------------
# Gold: star schema
# ---------------------------------------------------------------------------
def location_bk() -> Column:
    return K.business_key(F.lower("address"), F.lower("city"), F.lower("state"), F.col("zip_code"))


def risk_bk(level: Column) -> Column:
    return K.business_key(level, R.risk_priority(level).cast("string"))


def _risk_levels(t: DataFrame) -> DataFrame:
    levels = t.where(F.col("risk_category").isNotNull()).select(R.risk_level("risk_category").alias("risk_level"))
    return levels.withColumn("priority_level", R.risk_priority("risk_level")).distinct()          # A7


def dimension_specs() -> dict[str, dict]:
    """The hash dimensions: the same description builds them in batch and as streams."""
    low, high = R.score_range("results_std")
    return {
        "dim_location": {
            "attrs": ["address", "city", "state", "zip_code", "latitude", "longitude", "location"], "not_null": ["address", "city", "state"],
            "bk_name": "location_business_key", "bk": location_bk(), "sk_name": "location_key"},
        "dim_violation": {
            "attrs": ["violation_code", "violation_description", "violation_severity", "city"],
            "not_null": ["violation_code", "violation_description"], "bk_name": "violation_business_key",
            "bk": K.business_key("violation_code", "city"), "sk_name": "violation_key",
            "derive": {"is_critical": R.is_critical_severity("violation_severity"), "violation_category": R.violation_category("violation_severity")},
            "select": ["violation_key", "violation_business_key", "violation_code", "violation_description", "violation_category",
                       "violation_severity", "is_critical", "city"]},
        "dim_inspection_type": {
            "attrs": ["inspection_type", "city"], "not_null": ["inspection_type"], "bk_name": "inspection_type_business_key",
            "bk": K.business_key("inspection_type", "city"), "sk_name": "inspection_type_key",
            "derive": {"inspection_category": R.inspection_category("inspection_type")},
            "select": ["inspection_type_key", "inspection_type_business_key", "inspection_type", "inspection_category", "city"]},
        "dim_inspection_result": {
            "attrs": ["results_std"], "not_null": ["results_std"], "bk_name": "result_business_key", "bk": K.business_key("results_std"),
            "sk_name": "inspection_result_key",
            "derive": {"result_code": F.col("results_std"), "result_name": F.col("results_std"), "result_category": R.result_category("results_std"),
                       "score_range_min": low, "score_range_max": high},
            "select": ["inspection_result_key", "result_business_key", "result_code", "result_name", "result_category", "score_range_min",
                       "score_range_max"]},
        "dim_risk_category": {
            "source": _risk_levels, "attrs": ["risk_level", "priority_level"], "not_null": [], "bk_name": "risk_business_key",
            "bk": risk_bk(F.col("risk_level")), "sk_name": "risk_category_key"},
    }


def hash_dimensions(t: DataFrame) -> dict[str, DataFrame]:
    out = {}
    for name, spec in dimension_specs().items():
        spec = dict(spec)
        source = spec.pop("source", lambda x: x)
        spec["attrs"] = {c: c for c in spec["attrs"]}
        out[name] = hash_dimension(source(t), **spec)
    return out


def dim_date(spark: SparkSession) -> DataFrame:
    """The reference's fixed 2018-2028 calendar (4,018 days)."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(CALENDAR_START)),
                                                      F.to_date(F.lit(CALENDAR_END)),
                                                      F.expr("interval 1 day"))).alias("full_date"))
    return calendar_dimension(days)


def restaurant_id() -> Column:
    return F.concat(F.col("license_number"), F.lit("-"), F.col("city"))


def restaurant_stage(t: DataFrame) -> DataFrame:
    """Snapshots of the restaurants, in batch or as a stream."""
    known = t.where(F.col("license_number").isNotNull() & F.col("dba_name").isNotNull()
                    & F.col("city").isNotNull() & F.col("inspection_date").isNotNull())
    return scd2_stage(known.withColumn("restaurant_id", restaurant_id()), ["restaurant_id"], RESTAURANT_ATTRIBUTES, "inspection_date")


def restaurant_final(versions: DataFrame, sk: str = "md5_60") -> DataFrame:
    return scd2_final(versions, "restaurant_id", as_date=True, sk_name="restaurant_key", sk_method=sk).select(*RESTAURANT_COLUMNS)


def dim_restaurant(t: DataFrame, tracked: list[str] | None = None, sk: str = "md5_60") -> DataFrame:
    """SCD2 stage -> apply -> final (T5-T8).  ``tracked=None`` tracks every
    staged column incl. the inspection date (the reference's configuration)."""
    return restaurant_final(scd2_apply(restaurant_stage(t), ["restaurant_id"], "inspection_date", tracked=tracked), sk)


def dimensions(t: DataFrame) -> dict[str, DataFrame]:
    return {"dim_date": dim_date(t.sparkSession), **hash_dimensions(t), "dim_restaurant": dim_restaurant(t)}


def inspection_rows(t: DataFrame) -> DataFrame:
    """The typed rows with the business keys of their inspection and its dimensions."""
    return t.withColumns({
        "inspection_business_key": F.concat(F.col("inspection_id"), F.lit("-"), F.col("city")),
        "date_key": K.date_key("inspection_date"),
        "restaurant_id": restaurant_id(),
        "location_business_key": location_bk(),
        "inspection_type_business_key": K.business_key("inspection_type", "city"),
        "result_business_key": K.business_key("results_std"),
        "risk_business_key": risk_bk(R.risk_level("risk_category")),
    }).withColumn("inspection_key", K.surrogate_key("inspection_business_key"))


def fact_lookups(dims: dict[str, DataFrame]) -> list[Lookup]:
    keys = [("dim_location", "location"), ("dim_inspection_type", "inspection_type"), ("dim_inspection_result", "result"), ("dim_risk_category", "risk")]
    names = {"result": "inspection_result_key", "risk": "risk_category_key"}
    return [Lookup(scd2_current(dims["dim_restaurant"]), "restaurant_id", "restaurant_key"),
            *[Lookup(dims[d], f"{k}_business_key", names.get(k, f"{k}_key")) for d, k in keys]]


def fact(t: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row per inspection (its first violation) with the keys of the given dimensions."""
    first = unique_first(t.withColumn("inspection_business_key", F.concat(F.col("inspection_id"), F.lit("-"), F.col("city"))),
                         ["inspection_business_key"], ["violation_sequence"])                # A6 (deterministic)
    return lookup_keys(inspection_rows(first), fact_lookups(dims)).select(*FACT_COLUMNS)


def bridge_rows(t: DataFrame) -> DataFrame:
    """The typed rows with the business keys of their inspection and violation."""
    return t.withColumn("inspection_business_key", F.concat(F.col("inspection_id"), F.lit("-"), F.col("city"))) \
        .withColumn("violation_business_key", K.business_key("violation_code", "city"))


def bridge(t: DataFrame, fact_table: DataFrame, dim_violation: DataFrame) -> DataFrame:
    """The violations of the inspections that have a fact row."""
    return build_bridge(bridge_rows(t), fact_table, "inspection_business_key", "inspection_key",
                        [Lookup(dim_violation, "violation_business_key", "violation_key")]).select(*BRIDGE_COLUMNS)


def star(t: DataFrame) -> dict[str, DataFrame]:
    """All gold tables as queries on the typed silver table.  :func:`publish` stores the
    dimensions first and builds the fact and the bridge from the stored tables."""
    dims = dimensions(t)
    facts = fact(t, dims)
    return {**dims, "fact_food_inspections": facts, "bridge_inspection_violation": bridge(t, facts, dims["dim_violation"])}


# ---------------------------------------------------------------------------
# The same flow as streaming tables (T1-T4, T9, T10): each table is an
# available-now stream into parquet with its own checkpoint; dimensions are
# streaming dedups (state per business key); fact and bridge are
# stream-static joins against the dimension tables as they are at run time.
# ---------------------------------------------------------------------------
def stream_dimension(t: DataFrame, attrs: list[str], not_null: list[str], bk_name: str, bk: Column, sk_name: str,
                     source=None, derive: dict[str, Column] | None = None, select: list[str] | None = None) -> DataFrame:
    """One of :func:`dimension_specs` over a stream (A6/T3: arbitrary survivor per key)."""
    rows = (source(t) if source else t).select(*attrs)
    for c in not_null:
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.withColumn(bk_name, bk).dropDuplicates([bk_name])
    rows = rows.withColumns({sk_name: K.surrogate_key(bk_name), **(derive or {})})
    return rows.select(*(select or [sk_name, bk_name, *attrs, *(derive or {})]))


def stream_tables(spark: SparkSession, unified_dir: str, root: str, change_feed: bool = False, late_rows: bool = False) -> dict[str, str]:
    """Run bronze -> silver -> typed -> dims -> fact -> bridge as streams.

    ``unified_dir`` holds the unified table as parquet files (new files are
    picked up by the next run), or with ``change_feed`` its change log (S10:
    inserts and post-images become bronze rows); ``root`` is a folder on shared
    storage.  Returns the output folder of every table; all have the columns
    of the batch tables.  ``metrics`` among them has the silver rules' counters of every
    run and batch.  With ``late_rows`` facts without some dimension row and violations without
    their fact are kept waiting and looked up again by the next run, where the reference
    leaves such facts without keys and drops such violations.
    """
    from stargrain.sources.changes import CHANGE_TYPE, COMMIT_TS, COMMIT_VERSION, stream_changes
    from stargrain.streaming.history import MetricsHistory
    from stargrain.streaming.stores import late_lookups, late_table, retry_waiting
    from stargrain.streaming.streams import incremental_scd2, run_available_now, run_foreach_batch, scd2_store, stored

    def run(df, name):
        run_available_now(df, f"{root}/{name}", f"{root}/_checkpoints/{name}")
        return f"{root}/{name}"

    def src(path):
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    out = {}
    if change_feed:
        feed = stream_changes(spark, unified_dir, spark.read.parquet(unified_dir).schema, types=["insert", "update_postimage"])
        feed = feed.drop(CHANGE_TYPE, COMMIT_VERSION, COMMIT_TS)
    else:
        feed = src(unified_dir)
    out["bronze"] = run(bronze(feed), "bronze")
    with MetricsHistory(spark, f"{root}/metrics"):
        out["silver"] = run(silver(observe_stream(src(out["bronze"]), SILVER_RULES, "silver")), "silver")
    out["metrics"] = f"{root}/metrics"
    out["typed"] = run(typed(src(out["silver"])), "typed")
    t = src(out["typed"])
    for name, spec in dimension_specs().items():
        out[name] = run(stream_dimension(t, **spec), name)
    # SCD2 restaurant dimension: a streaming stage into the change log, the touched restaurants' history rebuilt
    run_foreach_batch(restaurant_stage(t), incremental_scd2(f"{root}/restaurant_log", f"{root}/restaurant_versions",
                                                            ["restaurant_id"], "inspection_date"),
                      f"{root}/_checkpoints/restaurant")
    empty = scd2_apply(restaurant_stage(spark.read.parquet(out["typed"]).where("false")), ["restaurant_id"], "inspection_date")
    versions = stored(spark, f"{root}/restaurant_versions", empty.schema)
    if "sg_epoch" in versions.columns:
        versions = scd2_store(spark, f"{root}/restaurant_versions", ["restaurant_id"])
    for name, df in (("dim_restaurant", restaurant_final(versions)), ("dim_date", dim_date(spark))):
        out[name] = f"{root}/{name}"
        df.write.mode("overwrite").parquet(out[name])
    # fact: streaming dedup per inspection + stream-static lookups (point in time, §4.3-8)
    dims = {name: spark.read.parquet(path) for name, path in out.items() if name.startswith("dim_")}
    f = inspection_rows(t).dropDuplicates(["inspection_business_key"])
    if late_rows:
        def dimensions_now(s):
            return fact_lookups({name: s.read.parquet(path) for name, path in out.items() if name.startswith("dim_")})

        def bridge_lookups(s):
            fact_now = late_table(s, f"{root}/fact_rows")
            return [Lookup(fact_now, "inspection_business_key", "inspection_key"),
                    Lookup(s.read.parquet(out["dim_violation"]), "violation_business_key", "violation_key")]

        waiting = {"fact_food_inspections": "fact_rows", "bridge_inspection_violation": "bridge_rows"}

        def keep(rows, body, lookups, name):
            run_foreach_batch(rows, body, f"{root}/_checkpoints/{name}")
            retry_waiting(spark, f"{root}/{name}", lookups)
            return late_table(spark, f"{root}/{name}")

        # the fact is all rows, a waiting one with NULL keys; the bridge those with a fact, whether their code is known or not
        for name, rows, lookups, columns, needed in (
                ("fact_food_inspections", f, dimensions_now, FACT_COLUMNS, "inspection_key"),
                ("bridge_inspection_violation", bridge_rows(t), bridge_lookups, BRIDGE_COLUMNS, "inspection_key")):
            keep(rows, late_lookups(f"{root}/{waiting[name]}", lookups), lookups, waiting[name]) \
                .where(F.col(needed).isNotNull()).select(*columns).write.mode("overwrite").parquet(f"{root}/{name}")
            out[name] = f"{root}/{name}"
        return out
    out["fact_food_inspections"] = run(lookup_keys(f, fact_lookups(dims)).select(*FACT_COLUMNS), "fact_food_inspections")
    out["bridge_inspection_violation"] = run(bridge(t, spark.read.parquet(out["fact_food_inspections"]), dims["dim_violation"]),
                                             "bridge_inspection_violation")
    return out


# ---------------------------------------------------------------------------
# Tables for ad-hoc SQL (§3.3)
# ---------------------------------------------------------------------------
TABLE_NAMES = {
    "source": "source_food_inspections_data",
    "bronze": "bronze_food_inspections",
    "silver": "silver_food_inspections",
    "typed": "silver_food_inspections_transformed",
}


def publish(spark: SparkSession, unified_df: DataFrame, root: str) -> dict[str, str]:
    """Write every layer as a parquet table under ``root`` (shared storage) and
    register a temp view per table under the pipeline's table names, so the
    same ad-hoc SQL runs against them.  Each table is read back from its
    files before the next layer is built (a lineage cut per layer)."""
    paths: dict[str, str] = {}

    def save(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
        back = spark.read.parquet(path)
        back.createOrReplaceTempView(name)
        return back

    src = save(unified_df, TABLE_NAMES["source"])
    br = save(bronze(src, audit=True), TABLE_NAMES["bronze"])
    sv = save(silver(br, audit=True), TABLE_NAMES["silver"])
    t = save(typed(sv, audit=True), TABLE_NAMES["typed"])
    stamp = lambda df, name: df.withColumn(name, F.current_timestamp())
    dims = {name: save(stamp(df, "load_at") if name == "dim_restaurant" else df, name) for name, df in dimensions(t).items()}
    facts = save(stamp(fact(t, dims), "load_timestamp"), "fact_food_inspections")
    save(stamp(bridge(t, facts, dims["dim_violation"]), "load_timestamp"), "bridge_inspection_violation")
    return paths
