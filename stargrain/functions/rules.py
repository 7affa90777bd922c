"""Business rule tables (B1-B20) as Column builders.

Each function takes column names/Columns and returns a Column, so the same
rule serves the city pipelines, the dimensions and the fact (one shared
definition instead of a repeated CASE, §4.1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stargrain.functions.text import ColLike, _c, contains_any, first_match, full_match, is_blank, to_number_lenient

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
ZIP_PATTERN = r"\d{5}(-\d{4})?"
VIOLATION_PATTERN = r"(\d+)\.\s*([^-]+?)\s*-\s*Comments:\s*(.+?)\s*$"
CITY_A_SCORES = {"Pass": 90, "Pass w/ Conditions": 80, "Fail": 70, "No Entry": 0}
CITY_A_RESULTS = {
    "Pass": "PASS",
    "Pass w/ Conditions": "PASS_CONDITIONS",
    "Fail": "FAIL",
    "No Entry": "NO_ENTRY",
    "Out of Business": "OUT_OF_BUSINESS",
    "Business Not Located": "NOT_LOCATED",
}
CITY_A_OTHER_RESULT = "OTHER"
CITY_A_TEXT_CRITICAL = ["Critical", "CRITICAL", "Serious"]
CITY_A_TEXT_URGENT = ["Urgent", "URGENT"]
CITY_A_DESC_CRITICAL = ["CRITICAL", "PRIORITY FOUNDATION", "SERIOUS"]
CITY_A_COMMENT_CRITICAL = ["CRITICAL"]
CITY_A_URGENT = ["URGENT"]
CITY_B_DESC_CRITICAL = ["CRITICAL", "PRIORITY", "MAJOR"]
CITY_B_COMMENT_CRITICAL = ["CRITICAL"]
CITY_B_DESC_URGENT = ["URGENT", "IMMINENT"]
CITY_B_COMMENT_URGENT = ["URGENT"]
VIOLATION_CATEGORIES = {
    "Critical": "Food Safety - Critical",
    "Urgent": "Food Safety - Urgent",
    "Serious": "Food Safety - Serious",
    "Moderate": "Sanitation - Moderate",
}
VIOLATION_CATEGORY_DEFAULT = "General Compliance"
INSPECTION_CATEGORIES = [
    ("routine", "Routine"),
    ("follow", "Follow-up"),
    ("complaint", "Complaint"),
    ("re-inspection", "Re-Inspection"),
]
INSPECTION_CATEGORY_DEFAULT = "Other"
RISK_LEVELS = [("high", "1", "High", 1), ("medium", "2", "Medium", 2), ("low", "3", "Low", 3)]
RISK_UNKNOWN = ("Unknown", 99)
RESULT_SCORE_RANGES = {"PASS": (90, 100), "PASS_CONDITIONS": (70, 89), "FAIL": (0, 69)}
# ---------------------------------------------------------------------------


# B1 -------------------------------------------------------------------------
def zip_invalid(zip_code: ColLike) -> Column:
    z = _c(zip_code)
    return z.isNull() | ~full_match(z, ZIP_PATTERN)


def validity_flags(name: ColLike, date: ColLike, results: ColLike, zip_code: ColLike,
                   record_id: ColLike) -> dict[str, Column]:
    """The 'no validation error' flags; computed, never filtered on."""
    flags = {
        "is_name_blank": is_blank(name),
        "is_date_blank": is_blank(date),
        "is_results_blank": is_blank(results),
        "is_zip_invalid": zip_invalid(zip_code),
        "is_id_blank": is_blank(record_id),
    }
    ok = F.lit(True)
    for v in flags.values():
        ok = ok & ~v
    flags["is_valid_record"] = ok
    return flags


HIGH_SCORE, MANY_VIOLATIONS = 90, 3


def record_flags(violations: ColLike, license_number: ColLike) -> dict[str, Column]:
    """The two flags beside them that no validity depends on."""
    return {"has_violations": ~is_blank(violations), "is_license_null": is_blank(license_number)}


def cross_flags(score: ColLike, violations: ColLike, result: ColLike, any_critical: ColLike) -> dict[str, Column]:
    """Flags that contradict each other across an inspection's rows: a high score (or many points) with more than three
    violations, and a pass with a critical one.  An unknown part makes a flag false."""
    false = F.lit(False)
    return {"high_score_many_violations": F.coalesce((_c(score) >= HIGH_SCORE) & (_c(violations) > MANY_VIOLATIONS), false),
            "pass_with_critical": F.coalesce((_c(result) == "PASS") & _c(any_critical), false)}


# B2 / B3 ----------------------------------------------------------------------
def city_a_score(results: ColLike) -> Column:
    r = _c(results)
    return first_match([(r == k, v) for k, v in CITY_A_SCORES.items()], None).cast("int")


def city_a_result(results: ColLike) -> Column:
    r = _c(results)
    return first_match([(r == k, v) for k, v in CITY_A_RESULTS.items()], CITY_A_OTHER_RESULT)


# B4 / B5 / B6 -------------------------------------------------------------------
def city_a_text_flags(text: ColLike) -> tuple[Column, Column]:
    """Whole-text critical/urgent flags (the tool's Contains ignores case)."""
    return contains_any(text, CITY_A_TEXT_CRITICAL), contains_any(text, CITY_A_TEXT_URGENT)


def city_a_violation_flags(desc: ColLike, comments: ColLike) -> tuple[Column, Column]:
    critical = contains_any(desc, CITY_A_DESC_CRITICAL) | contains_any(comments, CITY_A_COMMENT_CRITICAL)
    urgent = contains_any(desc, CITY_A_URGENT) | contains_any(comments, CITY_A_URGENT)
    return critical, urgent


def city_a_severity(critical: ColLike, urgent: ColLike, code: ColLike, number: ColLike | None = None) -> Column:
    """``number``: a column that holds the code's number already, so that it is not found again for every comparison."""
    n = to_number_lenient(code) if number is None else _c(number)
    return first_match([
        (_c(critical), "Critical"),
        (_c(urgent), "Urgent"),
        ((n >= 1) & (n <= 14), "Priority Foundation"),
        ((n >= 15) & (n <= 29), "Core"),
    ], "General")


# B7 / B11 / B13 -----------------------------------------------------------------
def score_result(score: ColLike) -> Column:
    s = _c(score)
    n = to_number_lenient(s)
    return first_match([
        (s.isNull(), "UNKNOWN"),
        (n >= 90, "PASS"),
        (n >= 70, "PASS_CONDITIONS"),
        (n < 70, "FAIL"),
    ], "UNKNOWN")


def points_severity(points: ColLike, number: ColLike | None = None) -> Column:
    n = to_number_lenient(points) if number is None else _c(number)
    return first_match([(n >= 10, "Critical"), (n >= 6, "Serious"), (n >= 3, "Moderate")], "Minor")


def score_risk(score: ColLike) -> Column:
    n = to_number_lenient(score)
    return first_match([(n >= 90, "Low Risk"), (n >= 70, "Medium Risk")], "High Risk")


# B8 / B9 / B10 -------------------------------------------------------------------
def city_b_comments(detail: ColLike, memo: ColLike) -> Column:
    d, m = _c(detail), _c(memo)
    left = F.when(~is_blank(d), F.concat(d, F.lit(" | "))).otherwise(F.lit(""))
    right = F.when(~is_blank(m), m).otherwise(F.lit(""))
    return F.trim(F.concat(left, right))


def city_b_violation_flags(desc: ColLike, comments: ColLike, points: ColLike, number: ColLike | None = None) -> tuple[Column, Column]:
    n = to_number_lenient(points) if number is None else _c(number)
    critical = (contains_any(desc, CITY_B_DESC_CRITICAL) | contains_any(comments, CITY_B_COMMENT_CRITICAL)
                | (n >= 8))
    urgent = (contains_any(desc, CITY_B_DESC_URGENT) | contains_any(comments, CITY_B_COMMENT_URGENT)
              | (n >= 10))
    return critical, urgent


# B12 ------------------------------------------------------------------------------
def street_address(number: ColLike, name: ColLike, direction: ColLike, street_type: ColLike,
                   unit: ColLike) -> Column:
    """number + name + direction + type + unit, blank parts left out, trimmed."""
    def part(c, trailing=" "):
        c = _c(c)
        return F.when(~is_blank(c), F.concat(c, F.lit(trailing))).otherwise(F.lit(""))
    return F.trim(F.concat(
        F.coalesce(_c(number).cast("string"), F.lit("")), F.lit(" "),
        part(name), part(direction), part(street_type), part(unit, ""),
    ))


# B16-B19 --------------------------------------------------------------------------
def violation_category(severity: ColLike) -> Column:
    s = _c(severity)
    return first_match([(s == k, v) for k, v in VIOLATION_CATEGORIES.items()], VIOLATION_CATEGORY_DEFAULT)


def is_critical_severity(severity: ColLike) -> Column:
    return F.coalesce(_c(severity).isin("Critical", "Urgent"), F.lit(False))


def inspection_category(inspection_type: ColLike) -> Column:
    t = F.lower(_c(inspection_type))
    return first_match([(t.contains(w), v) for w, v in INSPECTION_CATEGORIES], INSPECTION_CATEGORY_DEFAULT)


def result_category(result: ColLike) -> Column:
    r = _c(result)
    return first_match([(r.isin("PASS", "PASS_CONDITIONS"), "Pass"), (r == "FAIL", "Fail")], "Other")


def score_range(result: ColLike) -> tuple[Column, Column]:
    r = _c(result)
    lo = first_match([(r == k, v[0]) for k, v in RESULT_SCORE_RANGES.items()], None).cast("int")
    hi = first_match([(r == k, v[1]) for k, v in RESULT_SCORE_RANGES.items()], None).cast("int")
    return lo, hi


def risk_level(risk: ColLike) -> Column:
    r = F.lower(_c(risk))
    return first_match([(r.contains(w) | r.contains(d), lvl) for w, d, lvl, _ in RISK_LEVELS], RISK_UNKNOWN[0])


def risk_priority(level: ColLike) -> Column:
    lv = _c(level)
    return first_match([(lv == lvl, p) for _, _, lvl, p in RISK_LEVELS], RISK_UNKNOWN[1]).cast("int")
