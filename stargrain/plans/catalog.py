"""Registered queries over the driver's tables, each with its SQL oracle.

Every query reads whole tables (no id subsets, no row caps) and exercises
one or more operators of the inventory on an analogue of the reference's
data: orders stand in for inspections, lineitem for violations, customer
for restaurants/locations, part for violation codes, events for the SCD2
change log, documents/pages for packed text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same tables) are collected by the decorator below.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.functions import keys as K
from stargrain.functions import rules as R
from stargrain.functions.text import (bool_text, contains_any, double_or_null, first_match, int_or_null,
                                      lat_from_point, long_from_point, lower_or_null, pad_left, parse_date,
                                      point_text, regex_replace)
from stargrain.operators.cleanse import auto_field, cleanse, field_types
from stargrain.operators.dims import calendar_dates, calendar_dimension, hash_dimension
from stargrain.operators.facts import Lookup, build_bridge, lookup_keys, refresh_missing_keys
from stargrain.operators.joins import lookup_key, semi_join
from stargrain.operators.ordered import RANGE, ordered, sequence
from stargrain.operators.quality import Expectation, kept, metrics, quarantine
from stargrain.operators.rows import distinct_keys, unique_first, with_total
from stargrain.sources.changes import (COMMIT_TS, COMMIT_VERSION, apply_changes_snapshot, diff_snapshots,
                                      read_changes)
from stargrain.operators.scd2 import (END, START, scd2_apply, scd2_final, scd2_lookup_as_of, scd2_lookup_current,
                                     scd2_stage)
from stargrain.operators.quality import observe_stream
from stargrain.session import partitions_for, scratch_dir
from stargrain.streaming.streams import (incremental_scd2, run_available_now, run_foreach_batch, scd2_store,
                                         stream_source)
from stargrain.operators.summarize import (any_true, attach_summary, concat_agg, count_by, having, mode_agg,
                                           summarize)
from stargrain.operators.profile import outlier_counts, pattern_histogram, profile
from stargrain.operators.reshape import (cross_tab, regex_parse, select_map, slots_to_rows, split_to_rows,
                                        union_all, unpivot)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# SQL snippet: md5_60 surrogate key of a business-key expression.
def _sk(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


# ---------------------------------------------------------------------------
# Minimum slice: business key -> hash dimension -> fact lookup (J3, P9, §2.13)
# ---------------------------------------------------------------------------
def customer_dimension(customer: DataFrame) -> DataFrame:
    """Restaurant-like dimension; AUTOMOBILE customers are filtered out by the
    NOT NULL rule (segment is NULLed for them) so the fact has misses."""
    return hash_dimension(
        customer,
        attrs={"c_custkey": "c_custkey", "c_name": "c_name",
               "segment": F.nullif(F.col("c_mktsegment"), F.lit("AUTOMOBILE")),
               "c_nationkey": "c_nationkey"},
        not_null=["c_custkey", "segment"],
        bk_name="customer_bk", bk=K.business_key("c_custkey"),
        sk_name="customer_key",
    )


@query("fact_key_lookup", f"""
WITH dim AS (
  SELECT DISTINCT md5(CAST(c_custkey AS VARCHAR)) AS customer_bk
  FROM customer WHERE c_custkey IS NOT NULL AND nullif(c_mktsegment, 'AUTOMOBILE') IS NOT NULL
)
SELECT o.o_orderkey, o.o_custkey, {_sk('d.customer_bk')} AS customer_key, o.o_totalprice
FROM orders o LEFT JOIN dim d ON md5(CAST(o.o_custkey AS VARCHAR)) = d.customer_bk
""")
def q_fact_key_lookup(spark, d):
    dim = customer_dimension(table(spark, d, "customer"))
    fact = table(spark, d, "orders").withColumn("customer_bk", K.business_key("o_custkey"))
    out = lookup_key(fact, dim, "customer_bk", "customer_key")
    return out.select("o_orderkey", "o_custkey", "customer_key", "o_totalprice")


# ---------------------------------------------------------------------------
# Union by name and source-file column
# ---------------------------------------------------------------------------
@query("union_parties", """
SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, c_acctbal AS acct_balance,
       c_mktsegment AS segment, 'customer' AS party_type, 'customer.parquet' AS source_file FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier', 'supplier.parquet' FROM supplier
""")
def q_union_parties(spark, d):
    cust = select_map(with_source_file(table(spark, d, "customer")),
                      {"c_custkey": "party_key", "c_name": "party_name", "c_nationkey": "nation_key",
                       "c_acctbal": "acct_balance", "c_mktsegment": "segment", "source_file": "source_file"})
    supp = select_map(with_source_file(table(spark, d, "supplier")),
                      {"s_suppkey": "party_key", "s_name": "party_name", "s_nationkey": "nation_key",
                       "s_acctbal": "acct_balance", "source_file": "source_file"})
    return union_all([cust.withColumn("party_type", F.lit("customer")),
                      supp.withColumn("party_type", F.lit("supplier"))])


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """File of origin of each row, from the scan's hidden metadata."""
    return df.withColumn(name, F.col("_metadata.file_name"))


# ---------------------------------------------------------------------------
# Cleanse (R7, F5)
# ---------------------------------------------------------------------------
_WS_SQL = "[ \\t\\n\\r\\f]+"


@query("cleanse_text", f"""
SELECT doc_id, lang, source, trim(regexp_replace(text, '{_WS_SQL}', ' ', 'g')) AS text_clean,
       CAST(length(trim(regexp_replace(text, '{_WS_SQL}', ' ', 'g'))) AS INTEGER) AS clean_chars
FROM documents
WHERE (doc_id IS NOT NULL) OR (trim(coalesce(lang, '')) <> '') OR (trim(coalesce(source, '')) <> '')
   OR (trim(coalesce(regexp_replace(text, '{_WS_SQL}', ' ', 'g'), '')) <> '')
""")
def q_cleanse_text(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.col("text").alias("text_clean"))
    out = cleanse(docs, ["text_clean"], collapse=True, trim=True, drop_null_rows=True)
    return out.withColumn("clean_chars", F.length("text_clean"))


# ---------------------------------------------------------------------------
# Profile, value patterns, AutoField
# ---------------------------------------------------------------------------
_ORDERS_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


def _profile_sql(tbl: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, t) in enumerate(cols, start=1):
        s = t == "string"
        parts.append(
            f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
            + (f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS n_blank, " if s else "CAST(0 AS BIGINT) AS n_blank, ")
            + f"count(DISTINCT {c}) AS n_distinct, "
            + (f"CAST(min(length({c})) AS INTEGER) AS min_len, CAST(max(length({c})) AS INTEGER) AS max_len, "
               if s else "CAST(NULL AS INTEGER) AS min_len, CAST(NULL AS INTEGER) AS max_len, ")
            + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value "
               if t in ("bigint", "int", "double") else
               "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value ")
            + f"FROM {tbl}")
    return "\nUNION ALL\n".join(parts)


@query("profile_orders", _profile_sql("orders", _ORDERS_COLS))
def q_profile_orders(spark, d):
    return profile(table(spark, d, "orders"), exact=True)


_PAT_SQL = "regexp_replace(regexp_replace(CAST({c} AS VARCHAR), '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g')"


@query("profile_patterns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {_PAT_SQL.format(c=c)} AS pattern, count(*) AS n FROM customer GROUP BY 2"
    for c in ["c_custkey", "c_name", "c_mktsegment"]))
def q_profile_patterns(spark, d):
    return pattern_histogram(table(spark, d, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query("profile_outliers", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, lo AS lower_fence, hi AS upper_fence, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n_outliers
FROM lineitem, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
  FROM (SELECT quantile_disc({c}, 0.25)::DOUBLE AS q1, quantile_disc({c}, 0.75)::DOUBLE AS q3 FROM lineitem)) GROUP BY lo, hi"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def q_profile_outliers(spark, d):
    """IQR fences from an approximate quantile sketch: no exact SQL twin."""
    # ranks exact up to a million rows, then within a millionth of them
    return outlier_counts(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], accuracy=1_000_000)


def _orders_as_text(orders: DataFrame) -> DataFrame:
    return orders.select(
        *[F.col(c).cast("string").alias(c) for c, _ in _ORDERS_COLS],
        F.to_date("o_orderdate").cast("string").alias("order_day"),
        (F.col("o_orderstatus") == "F").cast("string").alias("is_final"),
    )


# Texts that only look like numbers or dates, by the row's key.
_AUTO_TRAPS = {
    "huge_number": ["99999999999999999999", "12"], "impossible_day": ["2024-02-30", "2024-02-28"], "leading_zero": ["00501", "10001"],
    "wide_number": ["9223372036854775807", "-9223372036854775808"], "big_double": ["1e308", "-2.5"], "beyond_double": ["1e400", "3"],
    "moment": ["2024-02-29 23:59:59", "1999-12-31T00:00:00.25"], "small": ["-128", "127"], "signed": ["+7", "-32768"],
}


def _auto_source(orders: DataFrame) -> DataFrame:
    return _orders_as_text(orders).withColumns({
        name: F.when(F.col("o_orderkey").cast("bigint") % 2 == 0, F.lit(a)).otherwise(F.lit(b)) for name, (a, b) in _AUTO_TRAPS.items()})


_AUTO_SQL_SRC = ", ".join([f"CAST({c} AS VARCHAR) AS {c}" for c, _ in _ORDERS_COLS]
                          + ["CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day", "CAST(o_orderstatus = 'F' AS VARCHAR) AS is_final"]
                          + [f"CASE WHEN o_orderkey % 2 = 0 THEN '{a}' ELSE '{b}' END AS {n}" for n, (a, b) in _AUTO_TRAPS.items()])
_AUTO_COLS = [c for c, _ in _ORDERS_COLS] + ["order_day", "is_final", *_AUTO_TRAPS]


def _auto_field_sql() -> str:
    """The narrowest type whose TRY_CAST holds every value: no leading zeros, whole numbers exact."""
    tests = [("boolean", "lower({c}) IN ('true', 'false')")]
    tests += [(spark_type, "TRY_CAST({c} AS " + duck + ") IS NOT NULL AND NOT contains({c}, '.') AND NOT contains(lower({c}), 'e')"
               " AND NOT regexp_matches({c}, '^[+-]?0[0-9]')") for spark_type, duck in
              (("tinyint", "TINYINT"), ("smallint", "SMALLINT"), ("int", "INTEGER"), ("bigint", "BIGINT"))]
    tests.append(("double", "coalesce(isfinite(TRY_CAST({c} AS DOUBLE)), false) AND NOT regexp_matches({c}, '^[+-]?0[0-9]') AND "
                            "(contains({c}, '.') OR contains(lower({c}), 'e') OR TRY_CAST({c} AS HUGEINT) = TRY_CAST(TRY_CAST({c} AS DOUBLE) AS HUGEINT))"))
    tests += [("date", "length({c}) = 10 AND TRY_CAST({c} AS DATE) IS NOT NULL"), ("timestamp", "length({c}) > 10 AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL")]
    parts = []
    for i, c in enumerate(_AUTO_COLS, start=1):
        cases = [f"WHEN coalesce(bool_and({t.format(c=c)}) FILTER (WHERE {c} IS NOT NULL), false) THEN '{name}'" for name, t in tests]
        parts.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, CASE WHEN count({c}) = 0 THEN 'string' "
                     + " ".join(cases) + f" ELSE 'string' END AS inferred_type, coalesce(max(length({c})), 0) AS longest, count({c}) AS n_values FROM t")
    every = "\nUNION ALL\n".join(parts)
    return f"""WITH t AS (SELECT {_AUTO_SQL_SRC} FROM orders)
SELECT ordinal, column_name, inferred_type, CASE WHEN inferred_type = 'string' THEN longest::INTEGER END AS size, n_values FROM ({every})"""


@query("auto_field_types", _auto_field_sql())
def q_auto_field_types(spark, d):
    return field_types(_auto_source(table(spark, d, "orders")))


@query("auto_field_cast", """
SELECT o_orderkey::BIGINT AS o_orderkey, o_custkey::BIGINT AS o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_orderstatus = 'F' AS is_final,
  CASE WHEN o_orderkey % 2 = 0 THEN '99999999999999999999' ELSE '12' END AS huge_number, CASE WHEN o_orderkey % 2 = 0 THEN '2024-02-30' ELSE '2024-02-28' END AS impossible_day,
  CASE WHEN o_orderkey % 2 = 0 THEN '00501' ELSE '10001' END AS leading_zero, CASE WHEN o_orderkey % 2 = 0 THEN 9223372036854775807 ELSE -9223372036854775808 END AS wide_number,
  (CASE WHEN o_orderkey % 2 = 0 THEN -128 ELSE 127 END)::TINYINT AS small
FROM orders
""")
def q_auto_field_cast(spark, d):
    """The casts themselves: texts that fit no type stay as they are."""
    out, types = auto_field(_auto_source(table(spark, d, "orders")))
    keys = [F.col(c).cast("bigint").alias(c) for c in ("o_orderkey", "o_custkey")]
    return out.select(*keys, "order_day", "is_final", "huge_number", "impossible_day", "leading_zero", "wide_number", "small")


# ---------------------------------------------------------------------------
# Validity flags, dates, rule tables
# ---------------------------------------------------------------------------
def _zip_of(acctbal: str, nation: str):
    z = F.floor(F.col(acctbal) * 10).cast("bigint").cast("string")
    return F.when(F.col(acctbal) >= 5000, F.concat(z, F.lit("-"), F.lpad(F.col(nation).cast("string"), 4, "0"))) \
        .otherwise(z)


_ZIP_SQL = ("CASE WHEN c_acctbal >= 5000 THEN CAST(CAST(floor(c_acctbal * 10) AS BIGINT) AS VARCHAR) || '-' || "
            "lpad(CAST(c_nationkey AS VARCHAR), 4, '0') ELSE CAST(CAST(floor(c_acctbal * 10) AS BIGINT) AS VARCHAR) END")


@query("validity_flags", f"""
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, nullif(c_mktsegment, 'BUILDING') AS results, {_ZIP_SQL} AS zip_code
           FROM customer)
SELECT c_custkey, zip_code,
  (c_name IS NULL OR c_name = '') AS is_name_blank,
  (c_mktsegment IS NULL OR c_mktsegment = '') AS is_date_blank,
  (results IS NULL OR results = '') AS is_results_blank,
  (zip_code IS NULL OR NOT regexp_full_match(zip_code, '\\d{{5}}(-\\d{{4}})?')) AS is_zip_invalid,
  (CAST(c_custkey AS VARCHAR) IS NULL OR CAST(c_custkey AS VARCHAR) = '') AS is_id_blank,
  NOT (c_name IS NULL OR c_name = '') AND NOT (c_mktsegment IS NULL OR c_mktsegment = '')
   AND NOT (results IS NULL OR results = '') AND NOT (zip_code IS NULL OR NOT regexp_full_match(zip_code, '\\d{{5}}(-\\d{{4}})?'))
   AND NOT (CAST(c_custkey AS VARCHAR) IS NULL OR CAST(c_custkey AS VARCHAR) = '') AS is_valid_record
FROM c
""")
def q_validity_flags(spark, d):
    c = table(spark, d, "customer").withColumn("zip_code", _zip_of("c_acctbal", "c_nationkey")) \
        .withColumn("results", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    flags = R.validity_flags("c_name", "c_mktsegment", "results", "zip_code", F.col("c_custkey").cast("string"))
    return c.select("c_custkey", "zip_code", *[v.alias(k) for k, v in flags.items()])


@query("parse_dates", """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d.%m.%Y')
                                    ELSE strftime(o_orderdate, '%Y/%m/%d') END AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%Y/%m/%d') AS DATE) AS order_date,
  CAST(year(CAST(try_strptime(date_text, '%Y/%m/%d') AS DATE)) AS INTEGER) AS order_year,
  CAST(month(CAST(try_strptime(date_text, '%Y/%m/%d') AS DATE)) AS INTEGER) AS order_month,
  CAST(quarter(CAST(try_strptime(date_text, '%Y/%m/%d') AS DATE)) AS INTEGER) AS order_quarter
FROM t
""")
def q_parse_dates(spark, d):
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM.yyyy")) \
        .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    o = o.select("o_orderkey", txt.alias("date_text")).withColumn("order_date", parse_date("date_text", "yyyy/MM/dd"))
    return o.select("o_orderkey", "date_text", "order_date", F.year("order_date").alias("order_year"),
                    F.month("order_date").alias("order_month"), F.quarter("order_date").alias("order_quarter"))


# Analogue: the order priority stands for the free-text inspection result.
def results_text():
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    return first_match([
        ((s == "P") & (p == "5-LOW"), "Business Not Located"),
        ((s == "O") & (p == "4-NOT SPECIFIED"), "Closed"),
        (p == "1-URGENT", "Fail"),
        (p == "2-HIGH", "Pass w/ Conditions"),
        (p == "3-MEDIUM", "Pass"),
        (p == "4-NOT SPECIFIED", "No Entry"),
        (p == "5-LOW", "Out of Business"),
    ], None)


_RESULTS_SQL = """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Business Not Located'
  WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'Closed'
  WHEN o_orderpriority = '1-URGENT' THEN 'Fail' WHEN o_orderpriority = '2-HIGH' THEN 'Pass w/ Conditions'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'Pass' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'No Entry'
  WHEN o_orderpriority = '5-LOW' THEN 'Out of Business' END"""
_RESULT_STD_SQL = """CASE WHEN results = 'Pass' THEN 'PASS' WHEN results = 'Pass w/ Conditions' THEN 'PASS_CONDITIONS'
  WHEN results = 'Fail' THEN 'FAIL' WHEN results = 'No Entry' THEN 'NO_ENTRY' WHEN results = 'Out of Business'
  THEN 'OUT_OF_BUSINESS' WHEN results = 'Business Not Located' THEN 'NOT_LOCATED' ELSE 'OTHER' END"""


@query("status_map", f"""
WITH t AS (SELECT o_orderkey, {_RESULTS_SQL} AS results FROM orders)
SELECT o_orderkey, results,
  CAST(CASE WHEN results = 'Pass' THEN 90 WHEN results = 'Pass w/ Conditions' THEN 80 WHEN results = 'Fail' THEN 70
            WHEN results = 'No Entry' THEN 0 END AS INTEGER) AS score,
  {_RESULT_STD_SQL} AS results_std
FROM t
""")
def q_status_map(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", results_text().alias("results"))
    return o.select("o_orderkey", "results", R.city_a_score("results").alias("score"),
                    R.city_a_result("results").alias("results_std"))


def _num_sql(x: str) -> str:
    return f"coalesce(TRY_CAST(nullif(regexp_extract(trim(CAST({x} AS VARCHAR)), '^-?[0-9]+(\\.[0-9]+)?', 0), '') AS DOUBLE), 0)"


@query("score_bands", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
   CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(CAST(2 * l_quantity AS INTEGER) AS VARCHAR) END AS score_text,
   CAST(round(l_discount * 100) AS INTEGER) AS points FROM lineitem)
SELECT *,
  CASE WHEN score_text IS NULL THEN 'UNKNOWN' WHEN {_num_sql('score_text')} >= 90 THEN 'PASS'
       WHEN {_num_sql('score_text')} >= 70 THEN 'PASS_CONDITIONS' WHEN {_num_sql('score_text')} < 70 THEN 'FAIL'
       ELSE 'UNKNOWN' END AS result,
  CASE WHEN {_num_sql('points')} >= 10 THEN 'Critical' WHEN {_num_sql('points')} >= 6 THEN 'Serious'
       WHEN {_num_sql('points')} >= 3 THEN 'Moderate' ELSE 'Minor' END AS severity,
  CASE WHEN {_num_sql('score_text')} >= 90 THEN 'Low Risk' WHEN {_num_sql('score_text')} >= 70 THEN 'Medium Risk'
       ELSE 'High Risk' END AS risk
FROM t
""")
def q_score_bands(spark, d):
    li = table(spark, d, "lineitem")
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  F.when(F.col("l_quantity") == 50, F.lit(None).cast("string"))
                   .otherwise((2 * F.col("l_quantity")).cast("int").cast("string")).alias("score_text"),
                  F.round(F.col("l_discount") * 100).cast("int").alias("points"))
    return t.select("*", R.score_result("score_text").alias("result"), R.points_severity("points").alias("severity"),
                    R.score_risk("score_text").alias("risk"))


def _contains_sql(c: str, words) -> str:
    return "coalesce(" + " OR ".join(f"contains(upper({c}), '{w.upper()}')" for w in words) + ", false)"


# A word for each arm of the word rules, dealt out by document.
_RULE_WORDS = ["", "Critical", "urgent", "SERIOUS", "Priority", "major", "Imminent", "priority foundation"]
_NOTE_WORDS = ["", "critical", "", "URGENT", "", ""]


def _dealt_sql(words: list[str]) -> str:
    return f"CASE doc_id % {len(words)} " + " ".join(f"WHEN {i} THEN ' {w}'" for i, w in enumerate(words)) + " END"


def _dealt(words: list[str]):
    return F.element_at(F.array(*[F.lit(f" {w}") for w in words]), (F.col("doc_id") % len(words) + 1).cast("int"))


@query("keyword_flags", f"""
WITH documents AS (SELECT doc_id, text || {_dealt_sql(_RULE_WORDS)} AS text, source || {_dealt_sql(_NOTE_WORDS)} AS source, n_chars FROM documents)
SELECT doc_id,
  {_contains_sql('text', R.CITY_A_TEXT_CRITICAL)} AS text_critical,
  {_contains_sql('text', R.CITY_A_TEXT_URGENT)} AS text_urgent,
  ({_contains_sql('text', R.CITY_B_DESC_CRITICAL)} OR {_contains_sql('source', R.CITY_B_COMMENT_CRITICAL)}
   OR {_num_sql('CAST(n_chars % 13 AS VARCHAR)')} >= 8) AS line_critical,
  ({_contains_sql('text', R.CITY_B_DESC_URGENT)} OR {_contains_sql('source', R.CITY_B_COMMENT_URGENT)}
   OR {_num_sql('CAST(n_chars % 13 AS VARCHAR)')} >= 10) AS line_urgent,
  {_contains_sql('text', ['license'])} AS has_license,
  {_contains_sql('text', ['password', 'secret', 'api_key', 'token'])} AS has_secret
FROM documents
""")
def q_keyword_flags(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat("text", _dealt(_RULE_WORDS)).alias("text"),
                                               F.concat("source", _dealt(_NOTE_WORDS)).alias("source"), "n_chars")
    crit, urg = R.city_a_text_flags("text")
    points = (F.col("n_chars") % 13).cast("string")
    bcrit, burg = R.city_b_violation_flags("text", "source", points)
    return docs.select("doc_id", crit.alias("text_critical"), urg.alias("text_urgent"),
                       bcrit.alias("line_critical"), burg.alias("line_urgent"),
                       contains_any("text", ["license"]).alias("has_license"),
                       contains_any("text", ["password", "secret", "api_key", "token"]).alias("has_secret"))


# ---------------------------------------------------------------------------
# Text to rows, regex parse and replace
# ---------------------------------------------------------------------------
@query("split_lines", """
SELECT doc_id, CAST(generate_subscripts(parts, 1) AS INTEGER) AS line_no, unnest(parts) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
""")
def q_split_lines(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("line"))
    return split_to_rows(docs, "line", "\n", pos="line_no").select("doc_id", "line_no", "line")


@query("split_url_segments", """
SELECT page_id, CAST(generate_subscripts(parts, 1) AS INTEGER) AS seg_no, unnest(parts) AS segment
FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)
""")
def q_split_url_segments(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("segment"))
    return split_to_rows(pages, "segment", "/", pos="seg_no").select("page_id", "seg_no", "segment")


VIOLATION_PATTERN = R.VIOLATION_PATTERN


def _packed_part_sql() -> str:
    return ("CAST(p_size AS VARCHAR) || '. ' || upper(p_name) || CASE WHEN p_type = 'PROMO' THEN '-SPECIAL' ELSE '' END"
            " || CASE WHEN p_type = 'ECONOMY' THEN ' - comments: ' ELSE ' - Comments: ' END || p_type || ' ' || p_brand")


@query("regex_parse_brand", f"""
WITH t AS (SELECT p_partkey, {_packed_part_sql()} AS packed FROM part)
SELECT p_partkey, packed,
  nullif(regexp_extract(packed, '(?i){VIOLATION_PATTERN}', 1), '') AS violation_code,
  nullif(regexp_extract(packed, '(?i){VIOLATION_PATTERN}', 2), '') AS violation_description,
  nullif(regexp_extract(packed, '(?i){VIOLATION_PATTERN}', 3), '') AS violation_comments,
  nullif(regexp_extract(packed, '(?i)brand#(\\d+)', 1), '') AS brand_no
FROM t
""")
def q_regex_parse_brand(spark, d):
    p = table(spark, d, "part")
    packed = F.concat(p.p_size.cast("string"), F.lit(". "), F.upper("p_name"),
                      F.when(F.col("p_type") == "PROMO", F.lit("-SPECIAL")).otherwise(F.lit("")),
                      F.when(F.col("p_type") == "ECONOMY", F.lit(" - comments: ")).otherwise(F.lit(" - Comments: ")),
                      F.col("p_type"), F.lit(" "), F.col("p_brand"))
    t = p.select("p_partkey", packed.alias("packed"))
    t = regex_parse(t, "packed", VIOLATION_PATTERN,
                    ["violation_code", "violation_description", "violation_comments"], ignore_case=True)
    return regex_parse(t, "packed", r"brand#(\d+)", ["brand_no"], ignore_case=True)


@query("regex_replace_point", """
WITH t AS (SELECT event_id, props,
   CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS lat, CAST(CAST(-value AS DECIMAL(12,2)) AS VARCHAR) AS lon
   FROM events),
p AS (SELECT event_id, regexp_replace(props, '^\\{"k": (\\d+)\\}$', '\\1') AS k_text,
   CASE WHEN lat IS NOT NULL AND lat <> '' AND lon IS NOT NULL AND lon <> '' THEN '(' || lat || ', ' || lon || ')'
        ELSE '' END AS location FROM t)
SELECT event_id, k_text, location,
  CASE WHEN location IS NOT NULL AND location <> '' AND contains(location, '(') AND contains(location, ',')
       THEN trim(regexp_replace(location, '^.*\\(([\\-\\d\\.]+)\\s*,.*$', '\\1')) ELSE '' END AS latitude,
  CASE WHEN location IS NOT NULL AND location <> '' AND contains(location, '(') AND contains(location, ',')
        AND contains(location, ')')
       THEN trim(regexp_replace(location, '^[^\\(]*\\([^\\,]*,\\s*([\\-\\d\\.]+)[\\)\\s].*$', '\\1')) ELSE '' END
       AS longitude
FROM p
""")
def q_regex_replace_point(spark, d):
    e = table(spark, d, "events")
    t = e.select("event_id", regex_replace("props", r'^\{"k": (\d+)\}$', "$1").alias("k_text"),
                 point_text(F.col("value").cast("decimal(12,2)").cast("string"),
                            (-F.col("value")).cast("decimal(12,2)").cast("string")).alias("location"))
    return t.select("event_id", "k_text", "location", lat_from_point("location").alias("latitude"),
                    long_from_point("location").alias("longitude"))


# ---------------------------------------------------------------------------
# Unpivot, cross tab, slot groups
# ---------------------------------------------------------------------------
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# No two lineitem rows are fully equal; these columns identify a row.
LINE_ID = LINE_KEYS + ["l_returnflag", "l_linestatus", "l_shipdate"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("unpivot_measures", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate, measure_name,
       measure_value
FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
                      l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure_name VALUE measure_value)
""")
def q_unpivot_measures(spark, d):
    return unpivot(table(spark, d, "lineitem"), LINE_ID, MEASURES, "measure_name", "measure_value")


@query("cross_tab_measures", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate, l_quantity,
       l_extendedprice, l_discount, l_tax FROM lineitem
""")
def q_cross_tab_measures(spark, d):
    """Unpivot then CrossTab back (First): the identity on a unique key."""
    long = unpivot(table(spark, d, "lineitem"), LINE_ID, MEASURES, "measure_name", "measure_value")
    return cross_tab(long, LINE_ID, "measure_name", "measure_value", MEASURES, agg="first")


SLOTS = 25      # as many as the wide layout has


@query("slots_to_rows", """
SELECT l_orderkey, l_linenumber, sum(l_quantity) AS qty, max(l_partkey) AS max_part
FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def q_slots_to_rows(spark, d):
    """Lines of an order side by side (one slot group per line number, CrossTab
    with sum/max), then the slot groups back to rows (R4, narrow ``inline``).
    A wide row has 25 slots; line numbers beyond it, and those that are NULL,
    stand on further rows of their order."""
    li = table(spark, d, "lineitem")
    number, slots = F.col("l_linenumber"), range(1, SLOTS + 1)
    li = li.withColumn("part", F.floor((number - 1) / SLOTS)).withColumn("slot", F.coalesce(F.pmod(number - 1, F.lit(SLOTS)) + 1, F.lit(1)))
    # as many partitions as the input needs: a task holds the wide rows of its own orders alone
    li = li.repartition(partitions_for(li, 2 << 20), "l_orderkey", "part")
    wide = li.groupBy("l_orderkey", "part").pivot("slot", list(slots)).agg(
        F.sum("l_quantity").alias("qty"), F.max("l_partkey").alias("max_part"), F.count(F.lit(1)).alias("lines"))
    rows = slots_to_rows(wide, ["l_orderkey", "part"], [{c: f"{i}_{c}" for c in ("qty", "max_part", "lines")} for i in slots], slot_col="slot")
    again = (F.col("part") * SLOTS + F.col("slot")).cast(li.schema["l_linenumber"].dataType)
    return rows.select("l_orderkey", again.alias("l_linenumber"), "qty", "max_part")


# ---------------------------------------------------------------------------
# Keep-first, sequence, summaries and join-back
# ---------------------------------------------------------------------------
_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("unique_first", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus) = 1
""")
def q_unique_first(spark, d):
    return unique_first(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate", "l_partkey", "l_suppkey"])


@query("line_sequence", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate) AS line_seq
FROM lineitem
""")
def q_line_sequence(spark, d):
    li = table(spark, d, "lineitem").select(*LINE_ID)
    # orders have a handful of lines: plain windows; hot_key_sequence below checks the range layout
    seq = sequence(li, ["l_orderkey"], LINE_ID[1:], out="line_seq")
    return seq.select(*LINE_KEYS, "line_seq")


_HOT_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]


@query("hot_key_sequence", f"""
WITH t AS (SELECT CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_orderkey END AS hot_key, * FROM lineitem)
SELECT hot_key, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
  row_number() OVER w AS seq, lag(l_quantity) OVER w AS prev_qty,
  lead(l_shipdate) OVER w AS next_ship
FROM t WINDOW w AS (PARTITION BY hot_key ORDER BY {", ".join(_HOT_ORDER)})
""")
def q_hot_key_sequence(spark, d):
    """Sequence, lag and lead where one key holds over a third of lineitem (all
    'N' lines share key -1): the range layout splits the hot key over many tasks
    and the boundary table stitches it back."""
    li = table(spark, d, "lineitem")
    t = li.select(F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("hot_key"),
                  *LINE_ID, "l_quantity")
    out = ordered(t, ["hot_key"], _HOT_ORDER, seq="seq", prev={"prev_qty": "l_quantity"},
                  nxt={"next_ship": "l_shipdate"}, layout=RANGE)
    return out.drop("l_quantity")


@query("conversation_turns", """
SELECT conv_id, turn, role, row_number() OVER w AS turn_seq, lag(role) OVER w AS prev_role,
       lead(turn) OVER w AS next_turn, CAST(length(text) AS INTEGER) AS text_chars
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def q_conversation_turns(spark, d):
    """Keyed sequence with previous/next values (W1, W4, W5) on conversation turns."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("text_chars"))
    return ordered(c, ["conv_id"], ["turn"], seq="turn_seq", prev={"prev_role": "role"}, nxt={"next_turn": "turn"})


@query("source_label_summary", """
WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)
SELECT d.source, count(*) AS n_docs, count(l.doc_id) AS n_labeled,
       coalesce(bool_or(l.toxic = 1), false) AS any_toxic, CAST(sum(l.quality) AS BIGINT) AS quality_sum
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id GROUP BY d.source
""")
def q_source_label_summary(spark, d):
    """Left lookup of partial labels (one row per document first, so the join
    cannot multiply documents), then a grouped summary with Max(bool)."""
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"),
                                                              F.max("toxic").alias("toxic"))
    docs = table(spark, d, "documents").select("doc_id", "source")
    j = docs.join(labels.withColumn("labeled", F.lit(1)), "doc_id", "left")
    return summarize(j, ["source"], {"n_docs": F.count(F.lit(1)), "n_labeled": F.count("labeled"),
                                     "any_toxic": any_true(F.col("toxic") == 1),
                                     "quality_sum": F.sum("quality").cast("bigint")})


@query("hot_key_fill", f"""
WITH t AS (SELECT CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_orderkey END AS hot_key, *,
                  CASE WHEN l_discount < 0.05 THEN NULL ELSE l_discount END AS disc FROM lineitem)
SELECT hot_key, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
  last_value(disc IGNORE NULLS) OVER (PARTITION BY hot_key ORDER BY {", ".join(_HOT_ORDER)}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS disc_filled
FROM t
""")
def q_hot_key_fill(spark, d):
    """Forward fill (the carry step of the as-of lookup) over the same hot key:
    the last non-NULL discount so far, with small discounts NULLed; forced
    through the range layout so the carried value crosses piece boundaries."""
    li = table(spark, d, "lineitem")
    t = li.select(F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("hot_key"),
                  *LINE_ID, F.when(F.col("l_discount") < 0.05, F.lit(None)).otherwise(F.col("l_discount"))
                  .alias("disc"))
    out = ordered(t, ["hot_key"], _HOT_ORDER, carry={"disc_filled": "disc"}, layout=RANGE)
    return out.drop("disc")


def order_summary(li: DataFrame) -> DataFrame:
    return summarize(li, ["l_orderkey"], {
        "line_count": F.count("l_partkey"),
        "all_parts": concat_agg("l_partkey", "|", ["l_linenumber", "l_partkey", "l_suppkey"]),
        "any_returned": any_true(F.col("l_returnflag") == "R"),
        "total_qty": F.sum("l_quantity"),
        "total_price": F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("decimal(18,2)"),
        "max_line": F.max("l_linenumber"),
        "mode_flag": mode_agg("l_returnflag"),
    })


@query("summarize_orders", """
WITH m AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
mode AS (SELECT l_orderkey, arg_min(l_returnflag, (-n, l_returnflag)) AS mode_flag FROM m GROUP BY l_orderkey)
SELECT l.l_orderkey, count(l_partkey) AS line_count,
  string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS all_parts,
  coalesce(bool_or(l_returnflag = 'R'), false) AS any_returned, sum(l_quantity) AS total_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total_price,
  max(l_linenumber) AS max_line, any_value(mode.mode_flag) AS mode_flag
FROM lineitem l JOIN mode USING (l_orderkey) GROUP BY l.l_orderkey
""")
def q_summarize_orders(spark, d):
    return order_summary(table(spark, d, "lineitem"))


@query("attach_summary", """
WITH s AS (SELECT l_orderkey, count(l_partkey) AS line_count, sum(l_quantity) AS order_qty,
                  coalesce(bool_or(l_returnflag = 'R'), false) AS any_returned FROM lineitem GROUP BY l_orderkey)
SELECT l.l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, line_count, order_qty, any_returned,
       l_quantity / order_qty AS qty_share
FROM lineitem l JOIN s USING (l_orderkey)
""")
def q_attach_summary(spark, d):
    li = table(spark, d, "lineitem")
    s = summarize(li, ["l_orderkey"], {"line_count": F.count("l_partkey"), "order_qty": F.sum("l_quantity"),
                                       "any_returned": any_true(F.col("l_returnflag") == "R")})
    out = attach_summary(li.select(*LINE_KEYS, "l_quantity"), s, ["l_orderkey"])
    return out.withColumn("qty_share", F.col("l_quantity") / F.col("order_qty"))


# ---------------------------------------------------------------------------
# Semi-joins, IN (subquery HAVING LIMIT), counts
# ---------------------------------------------------------------------------
@query("semi_join_keys", """
SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def q_semi_join_keys(spark, d):
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    keys = distinct_keys(li, ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return semi_join(table(spark, d, "orders"), keys, ["o_orderkey"])


@query("in_having_limit", """
SELECT * FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1 ORDER BY o_custkey LIMIT 5)
""")
def q_in_having_limit(spark, d):
    """The 5 smallest keys with more than one row, then all their rows.  The
    limit is the feature (a sample of keys for a report); the key list is
    5 rows by construction, so it is broadcast."""
    o = table(spark, d, "orders")
    keys = having(o, ["o_custkey"], 1).select("o_custkey").orderBy("o_custkey").limit(5)
    return semi_join(o, keys, ["o_custkey"])


@query("flag_counts", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL
""")
def q_flag_counts(spark, d):
    return count_by(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("distinct_vs_rows", """
SELECT count(DISTINCT l_orderkey) AS unique_orders, count(*) AS total_lines FROM lineitem
""")
def q_distinct_vs_rows(spark, d):
    return table(spark, d, "lineitem").agg(F.count_distinct("l_orderkey").alias("unique_orders"),
                                           F.count(F.lit(1)).alias("total_lines"))


@query("having_top", """
SELECT l_returnflag, l_linestatus, l_discount, l_tax, l_suppkey, count(*) AS n FROM lineitem
GROUP BY ALL HAVING count(*) > 5 ORDER BY n DESC, l_returnflag, l_linestatus, l_discount, l_tax, l_suppkey LIMIT 1
""")
def q_having_top(spark, d):
    """GROUP BY 5 columns HAVING COUNT(*) > 5, pick one (ordered, so the pick
    is deterministic).  Top-1 is a distributed take-ordered."""
    by = ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_suppkey"]
    g = having(table(spark, d, "lineitem"), by, 5)
    return g.orderBy(F.col("n").desc(), *by).limit(1)


@query("total_over", """
SELECT o_orderkey, o_custkey, o_orderstatus, count(*) OVER () AS total_rows FROM orders
""")
def q_total_over(spark, d):
    return with_total(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))


@query("numeric_filter", """
WITH s AS (SELECT l_orderkey, CAST(CAST(sum(l_quantity) AS INTEGER) AS VARCHAR) AS score_text,
                  CAST(count(*) AS VARCHAR) AS count_text FROM lineitem GROUP BY l_orderkey)
SELECT * FROM s WHERE TRY_CAST(score_text AS INTEGER) >= 90 AND TRY_CAST(count_text AS INTEGER) > 3
""")
def q_numeric_filter(spark, d):
    s = summarize(table(spark, d, "lineitem"), ["l_orderkey"], {
        "score_text": F.sum("l_quantity").cast("int").cast("string"),
        "count_text": F.count(F.lit(1)).cast("string")})
    return s.where((F.col("score_text").try_cast("int") >= 90) & (F.col("count_text").try_cast("int") > 3))


# ---------------------------------------------------------------------------
# Identity text: md5 ids, addresses, zip padding
# ---------------------------------------------------------------------------
@query("hash_id", """
SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR) || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS inspection_id,
       'DALLAS-' || md5(CAST(o_custkey AS VARCHAR) || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS license_number
FROM orders
""")
def q_hash_id(spark, d):
    o = table(spark, d, "orders")
    iid = F.md5(F.concat(o.o_custkey.cast("string"), F.lit("|"), F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", iid.alias("inspection_id"),
                    F.concat(F.lit("DALLAS-"), iid).alias("license_number"))


@query("address_zip", """
SELECT c_custkey,
  trim(coalesce(CAST(c_custkey AS VARCHAR), '') || ' ' ||
       CASE WHEN n_name IS NOT NULL AND n_name <> '' THEN n_name || ' ' ELSE '' END ||
       CASE WHEN nullif(substr(c_mktsegment, 1, 1), 'A') IS NOT NULL AND nullif(substr(c_mktsegment, 1, 1), 'A') <> ''
            THEN nullif(substr(c_mktsegment, 1, 1), 'A') || ' ' ELSE '' END ||
       CASE WHEN c_mktsegment IS NOT NULL AND c_mktsegment <> '' THEN c_mktsegment || ' ' ELSE '' END) AS address,
  CASE WHEN c_nationkey IS NULL THEN '' WHEN length(CAST(c_nationkey AS VARCHAR)) >= 5 THEN CAST(c_nationkey AS VARCHAR)
       ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip_code,
  trim(upper(c_name)) AS dba_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def q_address_zip(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    direction = F.nullif(F.substring("c_mktsegment", 1, 1), F.lit("A"))
    return j.select("c_custkey",
                    R.street_address("c_custkey", "n_name", direction, "c_mktsegment", F.lit("")).alias("address"),
                    F.when(F.col("c_nationkey").isNull(), F.lit("")).otherwise(pad_left("c_nationkey", 5))
                     .alias("zip_code"),
                    F.trim(F.upper("c_name")).alias("dba_name"))


# ---------------------------------------------------------------------------
# Expectations
# ---------------------------------------------------------------------------
LINE_RULES = [
    Expectation("valid_quantity", "l_quantity IS NOT NULL AND l_quantity > 0", "warn"),
    Expectation("open_line_is_final", "nullif(l_linestatus, 'O') = 'F'", "warn"),
    Expectation("valid_discount", "l_discount <= 0.08", "drop"),
    Expectation("returned_price", "l_returnflag <> 'R' OR l_extendedprice > 1000", "drop"),
    Expectation("tax_or_final", "l_tax < 0.07 OR l_linestatus = 'F'", "drop"),
]


def _ok_sql(r: Expectation) -> str:
    return f"coalesce(({r.predicate}), false)"


@query("expect_metrics", "\nUNION ALL\n".join(
    f"SELECT '{r.name}' AS rule, '{r.action}' AS action, count(*) FILTER (WHERE {_ok_sql(r)}) AS passed, "
    f"count(*) FILTER (WHERE NOT {_ok_sql(r)}) AS failed FROM lineitem" for r in LINE_RULES))
def q_expect_metrics(spark, d):
    return metrics(table(spark, d, "lineitem"), LINE_RULES)


@query("expect_kept", "SELECT * FROM lineitem WHERE " + " AND ".join(
    _ok_sql(r) for r in LINE_RULES if r.action == "drop"))
def q_expect_kept(spark, d):
    return kept(table(spark, d, "lineitem"), LINE_RULES)


@query("expect_quarantine", "SELECT *, concat_ws('|', " + ", ".join(
    f"CASE WHEN NOT {_ok_sql(r)} THEN '{r.name}' END" for r in LINE_RULES if r.action == "drop")
    + ") AS failed_rules FROM lineitem WHERE NOT (" + " AND ".join(
    _ok_sql(r) for r in LINE_RULES if r.action == "drop") + ")")
def q_expect_quarantine(spark, d):
    return quarantine(table(spark, d, "lineitem"), LINE_RULES)


# ---------------------------------------------------------------------------
# Typed layer
# ---------------------------------------------------------------------------
def orders_text(o: DataFrame) -> DataFrame:
    """Orders as the all-string bronze layer would hold them, with junk."""
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(s == "P", F.lit("abc")).when((s == "O") & (p == "5-LOW"), F.lit(""))
         .otherwise(F.col("o_totalprice").cast("string")).alias("total_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(s == "F", F.lit("True")).when(s == "O", F.lit("false")).alias("is_final"),
        F.when(p == "4-NOT SPECIFIED", F.lit("")).otherwise(p).alias("city"),
        F.when(p == "2-HIGH", F.lit("")).otherwise(F.substring(p, 1, 1)).alias("priority_num"),
    )


def typed_layer(t: DataFrame) -> DataFrame:
    """The typed projection (stateless, same function for batch and stream)."""
    return t.select(
        F.col("order_key").try_cast("bigint").alias("order_key"),
        double_or_null("total_price").alias("total_price"),
        parse_date("order_date", "yyyy-MM-dd").alias("order_date"),
        bool_text("is_final").alias("is_final"),
        lower_or_null("city").alias("city"),
        int_or_null("priority_num").alias("priority_num"),
    )


@query("typed_layer", """
WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
   CASE WHEN o_orderstatus = 'P' THEN 'abc' WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN ''
        ELSE CAST(o_totalprice AS VARCHAR) END AS total_price,
   strftime(o_orderdate, '%Y-%m-%d') AS order_date,
   CASE WHEN o_orderstatus = 'F' THEN 'True' WHEN o_orderstatus = 'O' THEN 'false' END AS is_final,
   CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS city,
   CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE substr(o_orderpriority, 1, 1) END AS priority_num
   FROM orders)
SELECT TRY_CAST(order_key AS BIGINT) AS order_key,
  CASE WHEN total_price IS NOT NULL AND total_price <> '' THEN TRY_CAST(total_price AS DOUBLE) END AS total_price,
  CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
  coalesce(lower(is_final) = 'true', false) AS is_final,
  CASE WHEN city IS NOT NULL AND city <> '' THEN lower(city) END AS city,
  CASE WHEN priority_num IS NOT NULL AND priority_num <> '' THEN TRY_CAST(priority_num AS INTEGER) END AS priority_num
FROM t
""")
def q_typed_layer(spark, d):
    return typed_layer(orders_text(table(spark, d, "orders")))


# ---------------------------------------------------------------------------
# Dimensions (S14, B16-B20, §2.13)
# ---------------------------------------------------------------------------
@query("dim_date", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS full_date FROM b)
SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key, full_date,
  CAST(year(full_date) AS INTEGER) AS year, strftime(full_date, '%Y') AS year_name,
  CAST(quarter(full_date) AS INTEGER) AS quarter, 'Q' || quarter(full_date) AS quarter_name,
  year(full_date) || '-Q' || quarter(full_date) AS year_quarter, CAST(month(full_date) AS INTEGER) AS month,
  strftime(full_date, '%B') AS month_name, strftime(full_date, '%b') AS month_name_short,
  strftime(full_date, '%Y-%m') AS year_month, CAST(day(full_date) AS INTEGER) AS day,
  CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, strftime(full_date, '%A') AS day_of_week_name,
  strftime(full_date, '%a') AS day_of_week_short, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
  CAST(ceil(day(full_date) / 7) AS INTEGER) AS week_of_month, dayofweek(full_date) IN (0, 6) AS is_weekend,
  dayofweek(full_date) IN (1, 2, 3, 4, 5) AS is_weekday,
  CAST(CASE WHEN month(full_date) >= 10 THEN year(full_date) + 1 ELSE year(full_date) END AS INTEGER) AS fiscal_year,
  CASE WHEN month(full_date) IN (10, 11, 12) THEN 1 WHEN month(full_date) IN (1, 2, 3) THEN 2
       WHEN month(full_date) IN (4, 5, 6) THEN 3 ELSE 4 END AS fiscal_quarter
FROM d
""")
def q_dim_date(spark, d):
    """Calendar over the span of the order dates (the reference uses a fixed
    2018-2028 span; :func:`calendar_dates` takes any bounds)."""
    o = table(spark, d, "orders")
    return calendar_dimension(calendar_dates(o, F.min("o_orderdate"), F.max("o_orderdate")))


def _risk_sql(c: str) -> str:
    lc = f"lower({c})"
    return (f"CASE WHEN contains({lc}, 'high') OR contains({lc}, '1') THEN 'High' "
            f"WHEN contains({lc}, 'medium') OR contains({lc}, '2') THEN 'Medium' "
            f"WHEN contains({lc}, 'low') OR contains({lc}, '3') THEN 'Low' ELSE 'Unknown' END")


_PRIORITY_SQL = "CAST(CASE {l} WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 ELSE 99 END AS INTEGER)"


def priority_dimension(orders: DataFrame) -> DataFrame:
    """dim_risk_category: order priority -> (risk level, priority), B19."""
    t = orders.where(F.col("o_orderpriority").isNotNull()) \
        .select(R.risk_level("o_orderpriority").alias("risk_level"))
    t = t.withColumn("priority_level", R.risk_priority("risk_level"))
    return hash_dimension(t, attrs={"risk_level": "risk_level", "priority_level": "priority_level"}, not_null=[],
                          bk_name="risk_business_key",
                          bk=K.business_key("risk_level", F.col("priority_level").cast("string")),
                          sk_name="risk_category_key")


_DIM_PRIORITY_SQL = f"""
WITH t AS (SELECT DISTINCT {_risk_sql('o_orderpriority')} AS risk_level FROM orders WHERE o_orderpriority IS NOT NULL),
u AS (SELECT risk_level, {_PRIORITY_SQL.format(l='risk_level')} AS priority_level FROM t)
SELECT {_sk("md5(risk_level || '|' || CAST(priority_level AS VARCHAR))")} AS risk_category_key,
       md5(risk_level || '|' || CAST(priority_level AS VARCHAR)) AS risk_business_key, risk_level, priority_level
FROM u"""


@query("dim_priority", _DIM_PRIORITY_SQL)
def q_dim_priority(spark, d):
    return priority_dimension(table(spark, d, "orders"))


def status_dimension(orders: DataFrame) -> DataFrame:
    """dim_inspection_result: standardised result -> category and score range, B18."""
    t = orders.select(R.city_a_result(results_text()).alias("results_std"))
    lo, hi = R.score_range("results_std")
    return hash_dimension(t, attrs={"results_std": "results_std"}, not_null=["results_std"],
                          bk_name="result_business_key", bk=K.business_key("results_std"),
                          sk_name="inspection_result_key",
                          derive={"result_code": F.col("results_std"), "result_name": F.col("results_std"),
                                  "result_category": R.result_category("results_std"),
                                  "score_range_min": lo, "score_range_max": hi},
                          select=["inspection_result_key", "result_business_key", "result_code", "result_name",
                                  "result_category", "score_range_min", "score_range_max"])


_DIM_STATUS_SQL = f"""
WITH r AS (SELECT {_RESULTS_SQL} AS results FROM orders),
t AS (SELECT DISTINCT {_RESULT_STD_SQL} AS results_std FROM r)
SELECT {_sk('md5(results_std)')} AS inspection_result_key, md5(results_std) AS result_business_key,
  results_std AS result_code, results_std AS result_name,
  CASE WHEN results_std IN ('PASS', 'PASS_CONDITIONS') THEN 'Pass' WHEN results_std = 'FAIL' THEN 'Fail' ELSE 'Other' END
    AS result_category,
  CAST(CASE results_std WHEN 'PASS' THEN 90 WHEN 'PASS_CONDITIONS' THEN 70 WHEN 'FAIL' THEN 0 END AS INTEGER)
    AS score_range_min,
  CAST(CASE results_std WHEN 'PASS' THEN 100 WHEN 'PASS_CONDITIONS' THEN 89 WHEN 'FAIL' THEN 69 END AS INTEGER)
    AS score_range_max
FROM t WHERE results_std IS NOT NULL"""


@query("dim_status", _DIM_STATUS_SQL)
def q_dim_status(spark, d):
    return status_dimension(table(spark, d, "orders"))


def _customer_nation(spark, d) -> DataFrame:
    # nation/region: broadcast by the planner's own size check (file size under
    # spark.sql.autoBroadcastJoinThreshold), no extra job
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")


# Segments as kinds of inspection, so that every category occurs.
_SEGMENT_KINDS = {"AUTOMOBILE": "Routine ", "BUILDING": "Follow-up ", "FURNITURE": "Complaint ", "MACHINERY": "Re-Inspection "}
_SEGMENT_TYPE_SQL = "(CASE " + " ".join(f"WHEN c_mktsegment = '{k}' THEN '{v}'" for k, v in _SEGMENT_KINDS.items()) + " ELSE '' END || c_mktsegment)"


def segment_type():
    kind = first_match([(F.col("c_mktsegment") == k, v) for k, v in _SEGMENT_KINDS.items()], "")
    return F.concat(kind, F.col("c_mktsegment"))


def segment_dimension(cn: DataFrame) -> DataFrame:
    """dim_inspection_type: (segment, city) with the B17 category."""
    return hash_dimension(cn, attrs={"inspection_type": segment_type(), "city": F.lower("n_name")},
                          not_null=["inspection_type"], bk_name="inspection_type_business_key",
                          bk=K.business_key("inspection_type", "city"), sk_name="inspection_type_key",
                          derive={"inspection_category": R.inspection_category("inspection_type")},
                          select=["inspection_type_key", "inspection_type_business_key", "inspection_type",
                                  "inspection_category", "city"])


_CN_SQL = "customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"


def _first_sql(src: str, bk: str, order: str) -> str:
    return f"SELECT * FROM ({src}) QUALIFY row_number() OVER (PARTITION BY {bk} ORDER BY {order}) = 1"


_TYPE_SRC = (f"SELECT {_SEGMENT_TYPE_SQL} AS inspection_type, lower(n_name) AS city, "
             f"md5(concat_ws('|', {_SEGMENT_TYPE_SQL}, lower(n_name))) AS bk FROM {_CN_SQL} WHERE c_mktsegment IS NOT NULL")


@query("dim_segment", f"""
WITH t AS ({_first_sql(_TYPE_SRC, 'bk', 'inspection_type, city')})
SELECT {_sk('bk')} AS inspection_type_key, bk AS inspection_type_business_key, inspection_type,
  CASE WHEN contains(lower(inspection_type), 'routine') THEN 'Routine'
       WHEN contains(lower(inspection_type), 'follow') THEN 'Follow-up'
       WHEN contains(lower(inspection_type), 'complaint') THEN 'Complaint'
       WHEN contains(lower(inspection_type), 're-inspection') THEN 'Re-Inspection' ELSE 'Other' END
    AS inspection_category, city
FROM t
""")
def q_dim_segment(spark, d):
    return segment_dimension(_customer_nation(spark, d))


def part_dimension(part: DataFrame) -> DataFrame:
    """dim_violation: (size code, type) with severity, category and critical flag."""
    return hash_dimension(
        part,
        attrs={"violation_code": F.col("p_size").cast("string"), "violation_description": "p_name",
               "violation_severity": R.points_severity(F.floor(F.col("p_size") / 5)), "city": F.lower("p_type")},
        not_null=["violation_code", "violation_description"],
        bk_name="violation_business_key", bk=K.business_key("violation_code", "city"), sk_name="violation_key",
        derive={"violation_category": R.violation_category("violation_severity"),
                "is_critical": R.is_critical_severity("violation_severity")},
        select=["violation_key", "violation_business_key", "violation_code", "violation_description",
                "violation_category", "violation_severity", "is_critical", "city"])


_SEV_SQL = (f"CASE WHEN {_num_sql('floor(p_size / 5)')} >= 10 THEN 'Critical' "
            f"WHEN {_num_sql('floor(p_size / 5)')} >= 6 THEN 'Serious' "
            f"WHEN {_num_sql('floor(p_size / 5)')} >= 3 THEN 'Moderate' ELSE 'Minor' END")
_PART_SRC = (f"SELECT CAST(p_size AS VARCHAR) AS violation_code, p_name AS violation_description, "
             f"{_SEV_SQL} AS violation_severity, lower(p_type) AS city, "
             f"md5(concat_ws('|', CAST(p_size AS VARCHAR), lower(p_type))) AS bk FROM part "
             f"WHERE p_size IS NOT NULL AND p_name IS NOT NULL")


@query("dim_part_type", f"""
WITH t AS ({_first_sql(_PART_SRC, 'bk', 'violation_code, violation_description, violation_severity, city')})
SELECT {_sk('bk')} AS violation_key, bk AS violation_business_key, violation_code, violation_description,
  CASE violation_severity WHEN 'Critical' THEN 'Food Safety - Critical' WHEN 'Urgent' THEN 'Food Safety - Urgent'
       WHEN 'Serious' THEN 'Food Safety - Serious' WHEN 'Moderate' THEN 'Sanitation - Moderate'
       ELSE 'General Compliance' END AS violation_category,
  violation_severity, coalesce(violation_severity IN ('Critical', 'Urgent'), false) AS is_critical, city
FROM t
""")
def q_dim_part_type(spark, d):
    return part_dimension(table(spark, d, "part"))


def place_attrs() -> dict:
    return {"address": F.concat(F.upper("c_mktsegment"), F.lit(" ROAD")), "city": F.col("n_name"),
            "state": F.col("r_name"), "zip_code": F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
            "latitude": F.col("c_acctbal"), "longitude": -F.col("c_acctbal")}


def place_bk(address="address", city="city", state="state", zip_code="zip_code"):
    return K.business_key(F.lower(F.col(address)), F.lower(F.col(city)), F.lower(F.col(state)), F.col(zip_code))


def place_dimension(cn: DataFrame) -> DataFrame:
    """dim_location: address x city x state x zip; NULL-safe ``concat_ws`` key (trap §4.3-5)."""
    return hash_dimension(cn, attrs=place_attrs(), not_null=["address", "city", "state"],
                          bk_name="location_business_key", bk=place_bk(), sk_name="location_key")


_PLACE_SRC = (f"SELECT upper(c_mktsegment) || ' ROAD' AS address, n_name AS city, r_name AS state, "
              f"lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code, c_acctbal AS latitude, -c_acctbal AS longitude "
              f"FROM {_CN_SQL}")
_PLACE_BK = "md5(concat_ws('|', lower(address), lower(city), lower(state), zip_code))"


@query("dim_place", f"""
WITH s AS (SELECT *, {_PLACE_BK} AS bk FROM ({_PLACE_SRC})
           WHERE address IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL),
t AS ({_first_sql('SELECT * FROM s', 'bk', 'address, city, state, zip_code, latitude, longitude')})
SELECT {_sk('bk')} AS location_key, bk AS location_business_key, address, city, state, zip_code, latitude, longitude
FROM t
""")
def q_dim_place(spark, d):
    return place_dimension(_customer_nation(spark, d))


# ---------------------------------------------------------------------------
# Fact and bridge (T9, T10, J3-J5, A6, date keys)
# ---------------------------------------------------------------------------
def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_dimensions(spark, d) -> dict[str, DataFrame]:
    """The dimensions of the order fact as stored tables.  The customers are joined to their places once for the two
    dimensions that need it, and the writes, which wait for nothing of each other, are submitted together."""
    o, cn = table(spark, d, "orders"), _stored(_customer_nation(spark, d), "customer_nation")
    made = {"dim_customer": customer_dimension(table(spark, d, "customer")), "dim_place": place_dimension(cn), "dim_segment": segment_dimension(cn),
            "dim_status": status_dimension(o), "dim_priority": priority_dimension(o)}
    with ThreadPoolExecutor(len(made)) as pool:
        return dict(zip(made, pool.map(_stored, made.values(), made)))


def order_keys(spark, d) -> DataFrame:
    """The fact's key columns alone: they depend on the order key, so no dimension is looked up and one column is read."""
    keys = table(spark, d, "orders").select("o_orderkey").distinct()
    keys = keys.withColumn("inspection_business_key", F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")))
    return keys.withColumn("inspection_key", K.surrogate_key("inspection_business_key"))


def fact_orders_df(spark, d, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """T9 on the analogue: one row per order with the keys of five dimensions.

    The dimensions are read from their stored tables, so the fact's plan scans
    each source once; keep-first works on the order rows, and adaptive
    execution broadcasts a dimension once its size is known to be small.
    """
    dims = dims or order_dimensions(spark, d)
    f = table(spark, d, "orders").withColumn("inspection_business_key", F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")))
    f = unique_first(f, ["inspection_business_key"])          # A6: one row per inspection
    cn = _customer_nation(spark, d).select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", "n_name", "r_name")
    f = f.join(cn, f.o_custkey == cn.c_custkey, "left").drop("c_custkey")
    attrs = place_attrs()
    f = f.withColumns({
        "inspection_key": K.surrogate_key("inspection_business_key"),
        "date_key": K.date_key("o_orderdate"),
        "customer_bk": K.business_key(F.col("o_custkey").cast("string")),
        "location_business_key": K.business_key(F.lower(attrs["address"]), F.lower(attrs["city"]),
                                                F.lower(attrs["state"]), attrs["zip_code"]),
        "inspection_type_business_key": K.business_key(segment_type(), F.lower("n_name")),
        "results_std": R.city_a_result(results_text()),
        "risk_level": R.risk_level("o_orderpriority"),
    })
    f = f.withColumns({
        "result_business_key": K.business_key("results_std"),
        "risk_business_key": K.business_key("risk_level", R.risk_priority("risk_level").cast("string")),
    })
    f = lookup_keys(f, [
        Lookup(dims["dim_customer"], "customer_bk", "customer_key"),
        Lookup(dims["dim_place"], "location_business_key", "location_key"),
        Lookup(dims["dim_segment"], "inspection_type_business_key", "inspection_type_key"),
        Lookup(dims["dim_status"], "result_business_key", "inspection_result_key"),
        Lookup(dims["dim_priority"], "risk_business_key", "risk_category_key"),
    ])
    return f.select("inspection_key", "inspection_business_key", "customer_key", "date_key", "location_key",
                    "inspection_type_key", "inspection_result_key", "risk_category_key",
                    F.col("o_totalprice").alias("order_total"), F.col("o_orderstatus").alias("order_status"),
                    "o_orderkey", F.to_date("o_orderdate").alias("order_date"))


_FACT_SQL = f"""
WITH s AS (SELECT o.*, c_mktsegment, c_nationkey, c_acctbal, n_name, r_name
           FROM orders o LEFT JOIN ({_CN_SQL}) ON o.o_custkey = c_custkey),
f AS (SELECT *, 'order-' || CAST(o_orderkey AS VARCHAR) AS bk,
        md5(CAST(o_custkey AS VARCHAR)) AS customer_bk,
        md5(concat_ws('|', lower(upper(c_mktsegment) || ' ROAD'), lower(n_name), lower(r_name),
                      lpad(CAST(c_nationkey AS VARCHAR), 5, '0'))) AS location_bk,
        md5(concat_ws('|', {_SEGMENT_TYPE_SQL}, lower(n_name))) AS type_bk,
        {_RESULTS_SQL} AS results FROM s),
g AS (SELECT *, md5({_RESULT_STD_SQL}) AS result_bk, {_risk_sql('o_orderpriority')} AS risk_level FROM f),
h AS (SELECT *, md5(risk_level || '|' || CAST({_PRIORITY_SQL.format(l='risk_level')} AS VARCHAR)) AS risk_bk FROM g),
dc AS (SELECT DISTINCT md5(CAST(c_custkey AS VARCHAR)) AS k FROM customer
       WHERE c_custkey IS NOT NULL AND nullif(c_mktsegment, 'AUTOMOBILE') IS NOT NULL),
dp AS (SELECT DISTINCT {_PLACE_BK} AS k FROM ({_PLACE_SRC})
       WHERE address IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL),
dt AS (SELECT DISTINCT bk AS k FROM ({_TYPE_SRC})),
dr AS (SELECT DISTINCT result_bk AS k FROM g),
dk AS (SELECT DISTINCT risk_bk AS k FROM h WHERE o_orderpriority IS NOT NULL)
SELECT {_sk('h.bk')} AS inspection_key, h.bk AS inspection_business_key,
  CASE WHEN dc.k IS NOT NULL THEN {_sk('dc.k')} END AS customer_key,
  CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
  CASE WHEN dp.k IS NOT NULL THEN {_sk('dp.k')} END AS location_key,
  CASE WHEN dt.k IS NOT NULL THEN {_sk('dt.k')} END AS inspection_type_key,
  CASE WHEN dr.k IS NOT NULL THEN {_sk('dr.k')} END AS inspection_result_key,
  CASE WHEN dk.k IS NOT NULL THEN {_sk('dk.k')} END AS risk_category_key,
  o_totalprice AS order_total, o_orderstatus AS order_status, o_orderkey, CAST(o_orderdate AS DATE) AS order_date
FROM h LEFT JOIN dc ON h.customer_bk = dc.k LEFT JOIN dp ON h.location_bk = dp.k LEFT JOIN dt ON h.type_bk = dt.k
  LEFT JOIN dr ON h.result_bk = dr.k LEFT JOIN dk ON h.risk_bk = dk.k"""


@query("fact_orders", _FACT_SQL)
def q_fact_orders(spark, d):
    return fact_orders_df(spark, d)


@query("bridge_order_part", f"""
WITH fact AS ({_FACT_SQL}),
dv AS (SELECT DISTINCT bk AS k FROM ({_PART_SRC}))
SELECT fact.inspection_key,
  CASE WHEN dv.k IS NOT NULL THEN {_sk('dv.k')} END AS violation_key,
  l_linenumber AS violation_sequence, coalesce(l_returnflag = 'R', false) AS is_violation_critical,
  CAST(p_size AS VARCHAR) AS violation_code, l_quantity, l_partkey, l_suppkey
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  JOIN fact ON 'order-' || CAST(l_orderkey AS VARCHAR) = fact.inspection_business_key
  LEFT JOIN dv ON md5(concat_ws('|', CAST(p_size AS VARCHAR), lower(p_type))) = dv.k
""")
def q_bridge_order_part(spark, d):
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    det = li.join(p.select("p_partkey", "p_size", "p_type"), li.l_partkey == p.p_partkey, "left")
    det = det.withColumn("violation_business_key", K.business_key(F.col("p_size").cast("string"), F.lower("p_type")))
    # the inspection business key is 'order-' || orderkey, a one-to-one function
    # of the order key: join the fact on the numeric key (cheaper to hash and
    # compare than the string), same rows
    # of the fact the bridge takes the key alone, which no dimension adds to
    out = build_bridge(det, order_keys(spark, d).select("inspection_key", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "inspection_key",
                       [Lookup(_stored(part_dimension(p), "dim_part_type"), "violation_business_key", "violation_key")])
    return out.select("inspection_key", "violation_key", F.col("l_linenumber").alias("violation_sequence"),
                      F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("is_violation_critical"),
                      F.col("p_size").cast("string").alias("violation_code"), "l_quantity", "l_partkey", "l_suppkey")


# ---------------------------------------------------------------------------
# Change feed between two snapshots
# ---------------------------------------------------------------------------
CHANGE_TS = "2024-02-01 00:00:00"


def customer_snapshots(spark, d) -> tuple[DataFrame, DataFrame]:
    """Old = customer; new = AUTOMOBILE customers deleted, BUILDING balances
    raised by 100, suppliers added as new keys."""
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    new = c.where(F.col("c_mktsegment") != "AUTOMOBILE").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
    added = s.select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"),
                     F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                     F.lit("SUPPLIER").alias("c_mktsegment"))
    return c, new.unionByName(added)


_NEW_SNAPSHOT_SQL = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""


@query("changes_between", f"""
WITH n AS ({_NEW_SNAPSHOT_SQL}), o AS (SELECT * FROM customer),
j AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS key, o.c_custkey AS ok, n.c_custkey AS nk,
        o.c_name AS o_name, o.c_nationkey AS o_nat, o.c_acctbal AS o_bal, o.c_mktsegment AS o_seg,
        n.c_name AS n_name, n.c_nationkey AS n_nat, n.c_acctbal AS n_bal, n.c_mktsegment AS n_seg
      FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey)
SELECT key AS c_custkey, n_name AS c_name, n_nat AS c_nationkey, n_bal AS c_acctbal, n_seg AS c_mktsegment,
       'insert' AS _change_type FROM j WHERE ok IS NULL
UNION ALL SELECT key, o_name, o_nat, o_bal, o_seg, 'delete' FROM j WHERE nk IS NULL
UNION ALL SELECT key, o_name, o_nat, o_bal, o_seg, 'update_preimage' FROM j
  WHERE ok IS NOT NULL AND nk IS NOT NULL AND (o_name, o_nat, o_bal, o_seg) IS DISTINCT FROM (n_name, n_nat, n_bal, n_seg)
UNION ALL SELECT key, n_name, n_nat, n_bal, n_seg, 'update_postimage' FROM j
  WHERE ok IS NOT NULL AND nk IS NOT NULL AND (o_name, o_nat, o_bal, o_seg) IS DISTINCT FROM (n_name, n_nat, n_bal, n_seg)
""")
def q_changes_between(spark, d):
    old, new = customer_snapshots(spark, d)
    ch = diff_snapshots(old, new, ["c_custkey"], version=2, commit_ts=CHANGE_TS)
    return ch.drop(COMMIT_VERSION, COMMIT_TS)


@query("changes_applied", _NEW_SNAPSHOT_SQL)
def q_changes_applied(spark, d):
    """Replaying the change feed (version 1 = full load as inserts, version 2 =
    the diff) gives the new snapshot back."""
    old, new = customer_snapshots(spark, d)
    v1 = diff_snapshots(old.limit(0), old, ["c_custkey"], version=1, commit_ts=CHANGE_TS)
    v2 = diff_snapshots(old, new, ["c_custkey"], version=2, commit_ts=CHANGE_TS)
    feed = read_changes(v1.unionByName(v2), since_version=1)
    return apply_changes_snapshot(feed, ["c_custkey"])


# ---------------------------------------------------------------------------
# SCD2 over the events change log
# key user_id, sequence ts
# ---------------------------------------------------------------------------
def event_versions(spark, d, tracked: list[str] | None) -> DataFrame:
    e = table(spark, d, "events")
    attrs = ["event_type"] if tracked else ["event_type", "value", "props"]
    stage = scd2_stage(e, ["user_id"], attrs, "ts")
    return scd2_apply(stage, ["user_id"], "ts", tracked=tracked)


_STAGE_SQL = "SELECT DISTINCT user_id, event_type, ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL"
_TRACKED_SQL = f"""
WITH s AS ({_STAGE_SQL}),
t AS (SELECT user_id, ts, max(event_type) AS event_type FROM s GROUP BY user_id, ts),
m AS (SELECT *, lag(event_type) OVER w AS prev, row_number() OVER w AS rn FROM t
      WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
v AS (SELECT user_id, event_type, ts FROM m WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS start_at, lead(ts) OVER w AS end_at,
       row_number() OVER w AS row_version
FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""


@query("scd2_stage", _STAGE_SQL)
def q_scd2_stage(spark, d):
    return scd2_stage(table(spark, d, "events"), ["user_id"], ["event_type"], "ts")


@query("scd2_tracked", _TRACKED_SQL)
def q_scd2_tracked(spark, d):
    v = event_versions(spark, d, ["event_type"])
    return v.select("user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at"), "row_version")


@query("scd2_ignore_nulls", """
WITH s AS (SELECT DISTINCT user_id, nullif(event_type, 'view') AS event_type, ts FROM events
           WHERE user_id IS NOT NULL AND ts IS NOT NULL),
t AS (SELECT user_id, ts, max(event_type) AS event_type FROM s GROUP BY user_id, ts),
f AS (SELECT user_id, ts, last_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type FROM t),
m AS (SELECT *, lag(event_type) OVER w AS prev, row_number() OVER w AS rn FROM f
      WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
v AS (SELECT user_id, event_type, ts FROM m WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS start_at, lead(ts) OVER w AS end_at,
       row_number() OVER w AS row_version
FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts)
""")
def q_scd2_ignore_nulls(spark, d):
    """``ignore_null_updates=True``: a NULL attribute in a snapshot means
    "unchanged" (here every 'view' event carries a NULL type), so the last
    non-NULL value is carried forward before changes are detected."""
    e = table(spark, d, "events").withColumn("event_type", F.nullif(F.col("event_type"), F.lit("view")))
    stage = scd2_stage(e, ["user_id"], ["event_type"], "ts")
    v = scd2_apply(stage, ["user_id"], "ts", tracked=["event_type"], ignore_null_updates=True)
    return v.select("user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at"), "row_version")


@query("scd2_versions", """
WITH s AS (SELECT DISTINCT user_id, event_type, value, props, ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id, ts
                                                ORDER BY event_type DESC, value DESC, props DESC) = 1),
m AS (SELECT *, lag((event_type, value, props, ts)) OVER w AS prev, row_number() OVER w AS rn FROM t
      WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
v AS (SELECT * FROM m WHERE rn = 1 OR prev IS DISTINCT FROM (event_type, value, props, ts))
SELECT user_id, event_type, value, props, ts AS start_at, lead(ts) OVER w AS end_at,
       row_number() OVER w AS row_version
FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts)
""")
def q_scd2_versions(spark, d):
    """All columns tracked, the sequence included (the reference's literal
    configuration): every new sequence value opens a version."""
    v = event_versions(spark, d, None)
    return v.select("user_id", "event_type", "value", "props", F.col(START).alias("start_at"),
                    F.col(END).alias("end_at"), "row_version")


@query("scd2_final", f"""
WITH v AS ({_TRACKED_SQL})
SELECT user_id, event_type, start_at AS effective_at, coalesce(end_at, TIMESTAMP '9999-12-31 00:00:00') AS expiration_at,
       end_at IS NULL AS is_current, row_version,
       {_sk("CAST(user_id AS VARCHAR) || '|' || CAST(epoch_us(start_at) AS VARCHAR)")} AS version_key
FROM v
""")
def q_scd2_final(spark, d):
    v = event_versions(spark, d, ["event_type"])
    f = scd2_final(v, "user_id", as_date=False)
    return f.select("user_id", "event_type", "effective_at", "expiration_at", "is_current", "row_version",
                    "version_key")


@query("scd2_as_of", f"""
WITH v AS ({_TRACKED_SQL})
SELECT e.event_id, e.user_id, e.ts, v.row_version AS version_row, v.event_type AS version_type
FROM events e LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.start_at AND (v.end_at IS NULL OR e.ts < v.end_at)
""")
def q_scd2_as_of(spark, d):
    v = event_versions(spark, d, ["event_type"])
    facts = table(spark, d, "events").select("event_id", "user_id", "ts")
    out = scd2_lookup_as_of(facts, v, ["user_id"], "ts", START, ["row_version", "event_type"])
    return out.select("event_id", "user_id", "ts", F.col("row_version").alias("version_row"),
                      F.col("event_type").alias("version_type"))


@query("scd2_current_lookup", f"""
WITH v AS ({_TRACKED_SQL})
SELECT o.o_orderkey, o.o_custkey, v.row_version AS current_version, v.event_type AS current_type
FROM orders o LEFT JOIN (SELECT * FROM v WHERE end_at IS NULL) v ON o.o_custkey = v.user_id
""")
def q_scd2_current_lookup(spark, d):
    """P10 + J3: facts join the *current* version only (one per key)."""
    v = scd2_final(event_versions(spark, d, ["event_type"]), "user_id", as_date=False)
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey"))
    cur = v.select(F.col("user_id").alias("o_custkey"), F.col("row_version").alias("current_version"),
                   F.col("event_type").alias("current_type"), "is_current")
    return scd2_lookup_current(o, cur, ["o_custkey"], ["current_version", "current_type"])


# ---------------------------------------------------------------------------
# Streaming tables (T1-T4, S9, A6/T3, E1 in a stream, incremental SCD2)
# Each runs readStream -> transform -> parquet sink (availableNow) under the
# session's shared checkpoint folder and returns the sink read back.
# ---------------------------------------------------------------------------
def _stream_of(spark, d, name: str, max_files: int | None = None) -> DataFrame:
    schema = table(spark, d, name).schema
    return stream_source(spark, d, schema, glob=f"{name}.parquet", max_files_per_trigger=max_files)


def _run_stream(spark, df: DataFrame, name: str) -> DataFrame:
    root = scratch_dir(spark, name)
    run_available_now(df, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("stream_bronze", "SELECT *, 'events_feed' AS source_system FROM events")
def q_stream_bronze(spark, d):
    return _run_stream(spark, _stream_of(spark, d, "events").withColumn("source_system", F.lit("events_feed")),
                       "stream_bronze")


@query("stream_silver", ORACLE["expect_kept"])
def q_stream_silver(spark, d):
    src = observe_stream(_stream_of(spark, d, "lineitem"), LINE_RULES, "silver_expectations")
    return _run_stream(spark, kept(src, LINE_RULES), "stream_silver")


@query("stream_dim", f"""
SELECT DISTINCT {_sk('md5(event_type)')} AS event_type_key, md5(event_type) AS event_type_business_key, event_type
FROM events WHERE event_type IS NOT NULL
""")
def q_stream_dim(spark, d):
    s = _stream_of(spark, d, "events").select("event_type").where(F.col("event_type").isNotNull())
    s = s.withColumn("event_type_business_key", K.business_key("event_type"))
    s = s.dropDuplicates(["event_type_business_key"])      # A6/T3: streaming dedup (state per key)
    s = s.withColumn("event_type_key", K.surrogate_key("event_type_business_key"))
    return _run_stream(spark, s.select("event_type_key", "event_type_business_key", "event_type"), "stream_dim")


@query("stream_fact", f"""
WITH f AS (SELECT o_orderkey, {_RESULTS_SQL} AS results, {_risk_sql('o_orderpriority')} AS risk_level,
                  o_orderdate FROM orders)
SELECT o_orderkey, {_sk(f"md5({_RESULT_STD_SQL})")} AS inspection_result_key,
  {_sk(f"md5(risk_level || '|' || CAST({_PRIORITY_SQL.format(l='risk_level')} AS VARCHAR))")} AS risk_category_key,
  CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key
FROM f
""")
def q_stream_fact(spark, d):
    """Stream-static joins: the streaming orders look up two dimensions."""
    o = table(spark, d, "orders")
    s = _stream_of(spark, d, "orders")
    s = (s.withColumn("result_business_key", K.business_key(R.city_a_result(results_text())))
          .withColumn("risk_level", R.risk_level("o_orderpriority"))
          .withColumn("risk_business_key", K.business_key("risk_level", R.risk_priority("risk_level").cast("string")))
          .withColumn("date_key", K.date_key("o_orderdate")))
    s = lookup_keys(s, [
        Lookup(status_dimension(o), "result_business_key", "inspection_result_key"),
        Lookup(priority_dimension(o), "risk_business_key", "risk_category_key"),
    ])
    return _run_stream(spark, s.select("o_orderkey", "inspection_result_key", "risk_category_key", "date_key"),
                       "stream_fact")


@query("stream_scd2", _TRACKED_SQL)
def q_stream_scd2(spark, d):
    """Streaming stage (dedup) -> foreachBatch: add the batch to the change log,
    recompute the history of the keys it touched."""
    root = scratch_dir(spark, "stream_scd2")
    stage = scd2_stage(_stream_of(spark, d, "events"), ["user_id"], ["event_type"], "ts")
    body = incremental_scd2(f"{root}/log", f"{root}/versions", ["user_id"], "ts", tracked=["event_type"])
    run_foreach_batch(stage, body, f"{root}/checkpoint")
    v = scd2_store(spark, f"{root}/versions", ["user_id"])
    return v.select("user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at"), "row_version")


@query("stream_risk_dim", _DIM_PRIORITY_SQL)
def q_stream_risk_dim(spark, d):
    """``distinct()`` then ``dropDuplicates(bk)`` chained in one stream
    (two stateful operators in append mode), as the risk dimension does."""
    s = _stream_of(spark, d, "orders").where(F.col("o_orderpriority").isNotNull())
    s = s.select(R.risk_level("o_orderpriority").alias("risk_level"))
    s = s.withColumn("priority_level", R.risk_priority("risk_level")).distinct()
    s = s.withColumn("risk_business_key", K.business_key("risk_level", F.col("priority_level").cast("string")))
    s = s.dropDuplicates(["risk_business_key"])
    s = s.withColumn("risk_category_key", K.surrogate_key("risk_business_key"))
    return _run_stream(spark, s.select("risk_category_key", "risk_business_key", "risk_level", "priority_level"),
                       "stream_risk_dim")
