"""Queries that run the two city flows, the file sources and sinks and the remaining
dimension forms on the given tables, registered in the catalog like the others."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import rules as R
from stargrain.operators.facts import Lookup, refresh_missing_keys
from stargrain.operators.ordered import run_sequence, sequence
from stargrain.operators.scd2 import scd2_final, scd2_transformed
from stargrain.operators.summarize import concat_agg, summarize
from stargrain.plans import inspections as P
from stargrain.plans.catalog import (_TRACKED_SQL, LINE_ID, _sk, customer_dimension, event_versions, query, table)
from stargrain.session import partitions_for, scratch_dir
from stargrain.sources.delimited import (read_delimited, read_inferred_csv, save_named, scan_named, write_delimited)

# ---------------------------------------------------------------------------
# The city flows: lines of an order become its violations
# ---------------------------------------------------------------------------
_STATUS = {"F": "Pass", "O": "Fail", "P": "Pass w/ Conditions"}
_A_NAMES = ["plain item", "critical item", "URGENT item", "serious item", "priority foundation item"]
_A_COMMENTS = ["all good", "fix it urgent", "a CRITICAL leak", "see notes"]
_LINE_ORDER = ", ".join(LINE_ID[1:])


def _pick(words: list[str], n) -> F.Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (n % len(words) + 1).cast("int"))


def _pick_sql(words: list[str], n: str) -> str:
    return f"([{', '.join(repr(w) for w in words)}])[({n}) % {len(words)} + 1]"


def _by_order(lines: DataFrame) -> DataFrame:
    """The lines of an order together, in as many partitions as the input needs: sorts and packed rows of a task do not grow with it."""
    return lines.repartition(partitions_for(lines, 2 << 20), "l_orderkey")


def city_a_raw(spark, d) -> DataFrame:
    """Orders in the first city's layout: the lines packed into one text, with stray blanks, tabs and no-break spaces."""
    li = _by_order(table(spark, d, "lineitem").where(F.col("l_orderkey").isNotNull()).select(*LINE_ID))
    piece = F.concat((F.col("l_partkey") % 35 + 1).cast("string"), F.lit(". "), F.upper(_pick(_A_NAMES, F.col("l_suppkey"))),
                     F.lit("\u00a0 - Comments: "), _pick(_A_COMMENTS, F.col("l_partkey")), F.lit("\t"))
    packed = sequence(li.withColumn("piece", piece), ["l_orderkey"], LINE_ID[1:], out="n").groupBy("l_orderkey") \
        .agg(concat_agg("piece", " | ", ["n"]).alias("Violations"))
    o = table(spark, d, "orders")
    text = {
        "Inspection ID": F.col("o_orderkey").cast("string"), "DBA Name": F.concat(F.lit(" Cafe  "), F.col("o_custkey").cast("string")),
        "AKA Name": F.lit(None).cast("string"), "License #": F.concat(F.lit("+"), F.col("o_custkey").cast("string")), "Facility Type": F.lit("Restaurant"),
        "Risk": F.col("o_orderpriority"), "Address": F.lit("1 Main St"), "City": F.lit("Chicago"), "State": F.lit("IL"), "Zip": F.lit("60614.0"),
        "Inspection Date": F.date_format("o_orderdate", "yyyy/MM/dd"), "Inspection Type": F.lit("Canvass"),
        "Results": F.coalesce(*[F.when(F.col("o_orderstatus") == k, v) for k, v in _STATUS.items()]), "Violations": F.col("Violations"),
        "Latitude": F.lit("41.9"), "Longitude": F.lit("-87.6"), "Location": F.lit("(41.9, -87.6)"), "FileName": F.lit("a.tsv")}
    return o.join(packed, o.o_orderkey == packed.l_orderkey).select(*[c.alias(n) for n, c in text.items()])


_A_LINES = f"""
lines AS (
  SELECT l_orderkey, l_partkey % 35 + 1 AS code, upper({_pick_sql(_A_NAMES, 'l_suppkey')}) AS description, {_pick_sql(_A_COMMENTS, 'l_partkey')} AS comments,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS piece FROM lineitem),
firsts AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, code ORDER BY piece) = 1),
flags AS (
  SELECT *, (contains(description, 'CRITICAL') OR contains(description, 'PRIORITY FOUNDATION') OR contains(description, 'SERIOUS')
             OR contains(upper(comments), 'CRITICAL')) AS critical,
         (contains(description, 'URGENT') OR contains(upper(comments), 'URGENT')) AS urgent,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY code) AS n FROM firsts),
summary AS (
  SELECT l_orderkey, count(*) AS violations, string_agg(code::VARCHAR, '|' ORDER BY n) AS codes, bool_or(critical) AS any_critical,
         bool_or(urgent) AS any_urgent, string_agg(description, '|' ORDER BY n) AS descriptions FROM flags GROUP BY l_orderkey)"""


def _flag_sql(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' ELSE 'False' END"


@query("city_a_flow", f"""
WITH {_A_LINES}
SELECT o_orderkey::VARCHAR AS inspection_id, 'Cafe ' || o_custkey::VARCHAR AS dba_name, o_custkey::VARCHAR AS license_number, '60614' AS zip_code,
  strftime(o_orderdate, '%Y-%m-%d') AS inspection_date, month(o_orderdate)::VARCHAR AS inspection_month, quarter(o_orderdate)::VARCHAR AS inspection_quarter,
  CASE o_orderstatus WHEN 'F' THEN '90' WHEN 'P' THEN '80' WHEN 'O' THEN '70' END AS violation_score,
  CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'P' THEN 'PASS_CONDITIONS' WHEN 'O' THEN 'FAIL' END AS results_std,
  code::VARCHAR AS violation_code, description AS violation_description, comments AS violation_comments_original,
  {_flag_sql('critical')} AS is_violation_critical, {_flag_sql('urgent')} AS is_violation_urgent,
  CASE WHEN critical THEN 'Critical' WHEN urgent THEN 'Urgent' WHEN code <= 14 THEN 'Priority Foundation' WHEN code <= 29 THEN 'Core' ELSE 'General' END AS violation_severity,
  n::VARCHAR AS violation_sequence, violations::VARCHAR AS violation_count, codes AS all_violation_codes, {_flag_sql('any_critical')} AS critical_violation,
  {_flag_sql('any_urgent')} AS urgent_violation, descriptions AS all_violation_descriptions
FROM flags JOIN summary USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O', 'P')
""")
def q_city_a_flow(spark, d):
    out = P.city_a_unified(city_a_raw(spark, d).where(F.col("Results").isNotNull()))
    return out.select("inspection_id", "dba_name", "license_number", "zip_code", "inspection_date", "inspection_month", "inspection_quarter", "violation_score",
                      "results_std", "violation_code", "violation_description", "violation_comments_original", "is_violation_critical", "is_violation_urgent",
                      "violation_severity", "violation_sequence", "violation_count", "all_violation_codes", "critical_violation", "urgent_violation",
                      "all_violation_descriptions")


_B_NAMES = ["plain item", "Critical item", "MAJOR item", "imminent item", "priority item", "urgent item"]
_B_MEMOS = ["", "memo", "urgent memo", "critical memo"]


def city_b_raw(spark, d) -> DataFrame:
    """Orders in the second city's layout: 25 lines side by side, one file column per field; an order's further lines
    stand on further rows of the file."""
    li = sequence(_by_order(table(spark, d, "lineitem").select(*LINE_ID)), ["l_orderkey"], LINE_ID[1:], out="line") \
        .withColumn("part", F.floor((F.col("line") - 1) / P.CITY_B_SLOTS)).withColumn("n", (F.col("line") - 1) % P.CITY_B_SLOTS + 1)
    fields = {
        "Violation_Description": F.concat(F.lit("*"), (F.col("l_partkey") % 60).cast("string"), F.lit(" "), _pick(_B_NAMES, F.col("l_suppkey"))),
        "Violation_Points": F.when(F.col("l_partkey") % 4 == 0, F.lit("")).otherwise((F.col("l_partkey") % 13).cast("string")),
        "Violation_Detail": F.when(F.col("l_suppkey") % 3 == 0, F.lit("detail")).otherwise(F.lit("")),
        "Violation_Memo": _pick(_B_MEMOS, F.col("l_partkey"))}
    lines = li.select("l_orderkey", "part", F.struct("n", *[c.alias(k) for k, c in fields.items()]).alias("v"))
    # the lines of a part are numbered from 1 without a gap: the i-th in their order is slot i
    packed = lines.groupBy("l_orderkey", "part").agg(F.array_sort(F.collect_list("v")).alias("slots"))
    wide = packed.select("l_orderkey", "part", *[F.get("slots", F.lit(i - 1)).alias(f"s{i}") for i in range(1, P.CITY_B_SLOTS + 1)])
    o = table(spark, d, "orders")
    ids = {
        "Restaurant Name": F.concat(F.lit("Taco "), F.col("o_orderkey").cast("string")), "Inspection Type": F.lit("Routine"),
        "Inspection Date": F.date_format("o_orderdate", "yyyy-MM-dd"), "Inspection Score": (F.col("o_orderkey") % 41 + 60).cast("string"),
        "Street Number": (F.col("o_orderkey") % 900).cast("string"), "Street Name": F.lit("Elm"), "Street Direction": F.lit(""), "Street Type": F.lit("St"),
        "Street Unit": F.lit("4"), "Street Address": F.lit(""), "Zip Code": (F.col("o_orderkey") % 100 + 7500).cast("string"), "Inspection Month": F.lit(""),
        "Inspection Year": F.lit(""), "Lat Long Location": F.lit("Dallas (32.7, -96.8)"),
        "FileName": F.concat(F.lit("b"), F.lpad(F.col("part").cast("string"), 6, "0"), F.lit(".tsv"))}
    columns = [c.alias(n) for n, c in ids.items()]
    for i in range(1, P.CITY_B_SLOTS + 1):
        columns += [F.col(f"s{i}.{field}").alias(name) for field, name in P.city_b_slot_columns(i).items()]
    return o.join(wide, o.o_orderkey == wide.l_orderkey).select(*columns)


_B_LINES = f"""
lines AS (
  SELECT l_orderkey, l_partkey % 60 AS code, '*' || (l_partkey % 60)::VARCHAR || ' ' || {_pick_sql(_B_NAMES, 'l_suppkey')} AS description,
         CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE l_partkey % 13 END AS points,
         trim(CASE WHEN l_suppkey % 3 = 0 THEN 'detail | ' ELSE '' END || {_pick_sql(_B_MEMOS, 'l_partkey')}) AS comments,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS line, (line - 1) % 25 + 1 AS slot FROM lineitem),
firsts AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, code ORDER BY line) = 1),
flags AS (
  SELECT *, (contains(upper(description), 'CRITICAL') OR contains(upper(description), 'PRIORITY') OR contains(upper(description), 'MAJOR')
             OR contains(upper(comments), 'CRITICAL') OR points >= 8) AS critical,
         (contains(upper(description), 'URGENT') OR contains(upper(description), 'IMMINENT') OR contains(upper(comments), 'URGENT') OR points >= 10) AS urgent,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY code::VARCHAR, line) AS n FROM firsts),
summary AS (
  SELECT l_orderkey, count(*) AS violations, string_agg(code::VARCHAR, '|' ORDER BY n) AS codes, bool_or(critical) AS any_critical, bool_or(urgent) AS any_urgent
  FROM flags GROUP BY l_orderkey),
o AS (SELECT *, o_orderkey % 41 + 60 AS score, md5('Taco ' || o_orderkey::VARCHAR || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS id FROM orders)"""


@query("city_b_flow", f"""
WITH {_B_LINES}
SELECT id AS inspection_id, 'TACO ' || o_orderkey::VARCHAR AS dba_name, 'DALLAS-' || id AS license_number,
  (o_orderkey % 900)::VARCHAR || ' Elm St 4' AS address, lpad((o_orderkey % 100 + 7500)::VARCHAR, 5, '0') AS zip_code, strftime(o_orderdate, '%Y-%m-%d') AS inspection_date,
  score::VARCHAR AS violation_score, CASE WHEN score >= 90 THEN 'PASS' WHEN score >= 70 THEN 'PASS_CONDITIONS' ELSE 'FAIL' END AS results_std,
  CASE WHEN score >= 90 THEN 'Low Risk' WHEN score >= 70 THEN 'Medium Risk' ELSE 'High Risk' END AS risk_category, '32.7' AS latitude, '-96.8' AS longitude,
  code::VARCHAR AS violation_code, description AS violation_description, comments AS violation_comments_original,
  {_flag_sql('critical')} AS is_violation_critical, {_flag_sql('urgent')} AS is_violation_urgent,
  CASE WHEN points >= 10 THEN 'Critical' WHEN points >= 6 THEN 'Serious' WHEN points >= 3 THEN 'Moderate' ELSE 'Minor' END AS violation_severity,
  n::VARCHAR AS violation_sequence, violations::VARCHAR AS violation_count, codes AS all_violation_codes,
  {_flag_sql('any_critical')} AS critical_violation, {_flag_sql('any_urgent')} AS urgent_violation
FROM flags JOIN summary USING (l_orderkey) JOIN o ON o_orderkey = l_orderkey
""")
def q_city_b_flow(spark, d):
    return P.city_b_unified(city_b_raw(spark, d)).select(
        "inspection_id", "dba_name", "license_number", "address", "zip_code", "inspection_date", "violation_score", "results_std", "risk_category", "latitude", "longitude",
        "violation_code", "violation_description", "violation_comments_original", "is_violation_critical", "is_violation_urgent", "violation_severity",
        "violation_sequence", "violation_count", "all_violation_codes", "critical_violation", "urgent_violation")


@query("cross_row_flags", f"""
WITH {_A_LINES}
SELECT 'Chicago' AS source_city, o_orderkey::VARCHAR AS inspection_id, code::VARCHAR AS violation_code,
  {_flag_sql("o_orderstatus = 'F' AND violations > 3")} AS high_score_many_violations, {_flag_sql("o_orderstatus = 'F' AND any_critical")} AS pass_with_critical
FROM flags JOIN summary USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O', 'P')
UNION ALL
SELECT * FROM (
WITH {_B_LINES},
total AS (SELECT l_orderkey, sum(points) AS points FROM flags GROUP BY l_orderkey)
SELECT 'Dallas', id, code::VARCHAR, {_flag_sql("total.points >= 90 AND violations > 3")}, {_flag_sql("score >= 90 AND any_critical")}
FROM flags JOIN summary USING (l_orderkey) JOIN total USING (l_orderkey) JOIN o ON o_orderkey = l_orderkey)
""")
def q_cross_row_flags(spark, d):
    """The two flags across an inspection's rows, of both cities."""
    columns = ["source_city", "inspection_id", "violation_code", "high_score_many_violations", "pass_with_critical"]
    a = P.city_a_unified(city_a_raw(spark, d).where(F.col("Results").isNotNull()), flags=True)
    return a.select(*columns).unionByName(P.city_b_unified(city_b_raw(spark, d), flags=True).select(*columns))


# ---------------------------------------------------------------------------
# The exact silver rules (E2-E6) on orders dressed as unified rows
# ---------------------------------------------------------------------------
_SILVER_COLUMNS = {
    "dba_name": "nullif('r' || o_custkey::VARCHAR, 'r7')", "inspection_date": "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '2024-01-01' END",
    "inspection_type": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'Routine' END", "zip_code": "CASE WHEN o_orderkey % 7 = 0 THEN '606' WHEN o_orderkey % 7 = 1 THEN '6061' ELSE '60614' END",
    "source_city": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Chicago' ELSE 'Dallas' END",
    "results_std": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'PASS' ELSE 'FAIL' END",
    "violation_score": "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'x' ELSE (o_orderkey % 50 + 60)::VARCHAR END",
    "violation_count": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE (o_custkey % 7)::VARCHAR END",
    "critical_violation": "CASE WHEN o_orderkey % 3 = 0 THEN 'True' ELSE 'False' END", "urgent_violation": "CASE WHEN o_orderkey % 31 = 0 THEN 'True' ELSE 'False' END",
}
_SILVER_SRC = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in _SILVER_COLUMNS.items()) + " FROM orders"
_IN = "source_city IS NOT NULL AND (source_city <> '{city}' OR {condition})"
_SILVER_TESTS = [
    "dba_name <> ''", "inspection_date <> ''", "inspection_type <> ''", "coalesce(length(zip_code), 0) BETWEEN 4 AND 5",
    _IN.format(city="Chicago", condition="results_std IS NOT NULL"),
    _IN.format(city="Dallas", condition="coalesce(TRY_CAST(violation_score AS INT), 101) <= 100"),
    "coalesce(TRY_CAST(violation_count AS INT), 0) > 0",
    # a score that is no number counts as high, a missing one as low
    _IN.format(city="Dallas", condition="coalesce(TRY_CAST(violation_score AS INT), CASE WHEN violation_score IS NULL THEN 0 ELSE 90 END) < 90 "
                                        "OR coalesce(TRY_CAST(violation_count AS INT), 0) < 4"),
    _IN.format(city="Dallas", condition="coalesce(results_std, 'PASS') <> 'PASS' OR concat(critical_violation, urgent_violation) = 'FalseFalse'"),
]


@query("silver_rule_counts", f"WITH t AS ({_SILVER_SRC})\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE coalesce({test}, false)) AS passed FROM t" for name, test in zip(P.RULE_NAMES, _SILVER_TESTS))
    + "\nUNION ALL SELECT 'kept' AS rule, count(*) FILTER (WHERE " + " AND ".join(f"coalesce({t}, false)" for t in _SILVER_TESTS[4:]) + ") AS passed FROM t")
def q_silver_rule_counts(spark, d):
    columns = [F.expr(sql.replace("::VARCHAR", "::STRING")).alias(name) for name, sql in _SILVER_COLUMNS.items()]
    rows = table(spark, d, "orders").select(*columns)
    counts = P.silver_metrics(rows).select("rule", F.col("passed").cast("bigint").alias("passed"))
    return counts.unionByName(P.silver(rows).agg(F.lit("kept").alias("rule"), F.count(F.lit(1)).alias("passed")).select("rule", "passed"))


@query("record_flags", """
SELECT o_orderkey, NOT (v IS NULL OR v = '') AS has_violations, (l IS NULL OR l = '') AS is_license_null
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN o_orderstatus END AS v, nullif(o_custkey % 4, 0)::VARCHAR AS l FROM orders)
""")
def q_record_flags(spark, d):
    k = F.col("o_orderkey")
    t = table(spark, d, "orders").select(k, F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.col("o_orderstatus")).alias("v"),
                                         F.nullif(F.col("o_custkey") % 4, F.lit(0)).cast("string").alias("l"))
    return t.select("o_orderkey", *[c.alias(n) for n, c in R.record_flags("v", "l").items()])


# ---------------------------------------------------------------------------
# Summaries and sequences that a hot key does not gather in one task
# ---------------------------------------------------------------------------
_HOT_SQL = "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_suppkey END"


@query("hot_group_concat", f"""
WITH t AS (SELECT {_HOT_SQL} AS grp, l_orderkey, l_linenumber, nullif(l_partkey % 7, 3)::VARCHAR AS code, l_returnflag, l_quantity FROM lineitem)
SELECT grp, count(*) AS n, sum(l_quantity) AS quantity, coalesce(string_agg(code, '|' ORDER BY l_orderkey, l_linenumber, code NULLS FIRST, l_returnflag), '') AS codes,
  string_agg(l_returnflag, '' ORDER BY l_orderkey, l_linenumber, code NULLS FIRST, l_returnflag) AS flags
FROM t GROUP BY grp
""")
def q_hot_group_concat(spark, d):
    """Count, Sum and two Concats where one group (a NULL key) holds a third of the rows."""
    t = table(spark, d, "lineitem").select(F.expr(_HOT_SQL).alias("grp"), "l_orderkey", "l_linenumber",
                                           F.nullif(F.col("l_partkey") % 7, F.lit(3)).cast("string").alias("code"), "l_returnflag", "l_quantity")
    return summarize(t, ["grp"], {"n": F.count(F.lit(1)), "quantity": F.sum("l_quantity")},
                     concats={"codes": ("code", "|"), "flags": ("l_returnflag", "")}, order_by=["l_orderkey", "l_linenumber"])


@query("arrival_runs", f"""
WITH t AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events),
m AS (SELECT *, CASE WHEN pos = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY pos) THEN 1 ELSE 0 END AS opens FROM t),
r AS (SELECT *, sum(opens) OVER (ORDER BY pos) AS run FROM m)
SELECT event_id, event_type, run::BIGINT AS run, row_number() OVER (PARTITION BY run ORDER BY pos) AS seq FROM r
""")
def q_arrival_runs(spark, d):
    """W1 on unsorted input: numbers that start again at each change of the event type in arrival order."""
    return run_sequence(table(spark, d, "events").select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], run="run") \
        .select("event_id", "event_type", "run", "seq")


# ---------------------------------------------------------------------------
# Files and tables
# ---------------------------------------------------------------------------
_AWKWARD_SQL = "'caf' || chr(233) || ',\"' || o_orderpriority || '\"' || chr(10) || 'x'"


@query("delimited_round_trip", f"""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, {_AWKWARD_SQL} AS note, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
""")
def q_delimited_round_trip(spark, d):
    """Quotes, separators, line breaks and Latin-1 characters through a CRLF file and back, all text."""
    note = F.concat(F.lit("caf\u00e9,\""), F.col("o_orderpriority"), F.lit("\"\nx"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", note.alias("note"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))
    path = scratch_dir(spark, "delimited")
    write_delimited(rows, path)
    return read_delimited(spark, path, sep=",", multiline=True, source_file=None)


@query("split_quoted_scan", """
SELECT l_orderkey::VARCHAR AS l_orderkey, l_linenumber::VARCHAR AS l_linenumber,
  CASE l_partkey % 3 WHEN 0 THEN 'size 5\" pipe' WHEN 1 THEN 'first' || chr(10) || chr(10) || '\"second\", ' || l_suppkey::VARCHAR ELSE ',' || chr(10) || 'z' END AS note
FROM lineitem
""")
def q_split_quoted_scan(spark, d):
    """Notes with record breaks, quotes and separators, out of files whose byte ranges are read by many tasks."""
    kind = F.col("l_partkey") % 3
    note = F.when(kind == 0, F.lit('size 5" pipe')).when(kind == 1, F.concat(F.lit('first\n\n"second", '), F.col("l_suppkey").cast("string"))).otherwise(F.lit(",\nz"))
    path = scratch_dir(spark, "quoted")
    write_delimited(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", note.alias("note")), path, line_sep="\n")
    return read_delimited(spark, path, sep=",", multiline=True, source_file=None)


@query("delimited_headers", """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, NULL::VARCHAR AS s_phone FROM customer
UNION ALL SELECT s_suppkey::VARCHAR, s_name, 'x' || s_nationkey::VARCHAR FROM supplier
""")
def q_delimited_headers(spark, d):
    """Files whose headers differ in order and columns, under one glob, aligned by name."""
    root = scratch_dir(spark, "headers")
    write_delimited(table(spark, d, "customer").select("c_custkey", "c_name"), f"{root}/a")
    s = table(spark, d, "supplier")
    write_delimited(s.select(F.concat(F.lit("x"), s.s_nationkey.cast("string")).alias("s_phone"), s.s_name.alias("c_name"), s.s_suppkey.alias("c_custkey")), f"{root}/b")
    return read_delimited(spark, f"{root}/*", sep=",", source_file=None).select("c_custkey", "c_name", "s_phone")


@query("inferred_load", "SELECT p_partkey::INTEGER AS p_partkey, p_name, p_size::INTEGER AS p_size, p_size / 4.0::DOUBLE AS quarter_size FROM part")
def q_inferred_load(spark, d):
    path = scratch_dir(spark, "inferred")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size", (F.col("p_size") / 4.0).alias("quarter_size"))
    write_delimited(p, path, encoding="UTF-8", line_sep="\n")
    return read_inferred_csv(spark, path)


@query("named_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_named_table(spark, d):
    """A partitioned table saved under a name, overwritten, and scanned by that name."""
    name, path = f"sg_orders_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "named")
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    save_named(rows.where("o_orderstatus = 'F'"), name, path=path)
    save_named(rows, name, partition_by=["o_orderstatus"], path=path)
    return scan_named(spark, name)


# ---------------------------------------------------------------------------
# Forms of the version table, and key repair
# ---------------------------------------------------------------------------
@query("scd2_transformed", f"""
WITH v AS ({_TRACKED_SQL})
SELECT user_id, event_type, row_version, start_at AS start_dt, end_at AS end_dt, CASE WHEN end_at IS NULL THEN 'Y' ELSE 'N' END AS is_active FROM v
""")
def q_scd2_transformed(spark, d):
    v = scd2_transformed(event_versions(spark, d, ["event_type"]), load_at=False)
    return v.select("user_id", "event_type", "row_version", "start_dt", "end_dt", "is_active")


@query("scd2_final_dates", f"""
WITH v AS ({_TRACKED_SQL})
SELECT user_id, event_type, start_at::DATE AS effective_date, coalesce(end_at::DATE, DATE '9999-12-31') AS expiration_date, end_at IS NULL AS is_current, row_version,
  {_sk("CAST(user_id AS VARCHAR) || '|' || CAST(start_at::DATE AS VARCHAR)")} AS version_key
FROM v
""")
def q_scd2_final_dates(spark, d):
    v = scd2_final(event_versions(spark, d, ["event_type"]), "user_id", as_date=True)
    return v.select("user_id", "event_type", "effective_date", "expiration_date", "is_current", "row_version", "version_key")


@query("refreshed_keys", f"""
WITH dim AS (SELECT DISTINCT md5(CAST(c_custkey AS VARCHAR)) AS customer_bk FROM customer WHERE c_custkey IS NOT NULL AND nullif(c_mktsegment, 'AUTOMOBILE') IS NOT NULL)
SELECT o_orderkey, {_sk('d.customer_bk')} AS customer_key FROM orders LEFT JOIN dim d ON md5(CAST(o_custkey AS VARCHAR)) = d.customer_bk
""")
def q_refreshed_keys(spark, d):
    """Facts loaded before half of the customers existed, repaired from the whole dimension (given twice over: repeated
    dimension rows must not multiply facts)."""
    dim = customer_dimension(table(spark, d, "customer")).select("customer_bk", "customer_key")
    early = dim.where(F.substring("customer_bk", 1, 1) < "8").withColumnRenamed("customer_key", "early_key")
    facts = table(spark, d, "orders").select("o_orderkey", F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("customer_bk"))
    loaded = facts.join(early, "customer_bk", "left").withColumnRenamed("early_key", "customer_key")
    return refresh_missing_keys(loaded, [Lookup(dim.unionByName(dim), "customer_bk", "customer_key")]).select("o_orderkey", "customer_key")
