"""Physical-plan properties the design relies on at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stargrain.operators.ordered import RANGE, ordered
from stargrain.operators.quality import Expectation, kept
from stargrain.operators.rows import unique_first, with_total
from stargrain.plans import catalog, flows
from stargrain.session import input_bytes, partitions_for

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_is_trimmed_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(unique_first(li, ["l_orderkey"], ["l_shipdate"]))
    assert "WindowGroupLimit" in p and p.rindex("WindowGroupLimit") > p.rindex("Exchange hashpartitioning")


def test_drop_rules_reach_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = kept(li, [Expectation("d", "l_discount <= 0.08", "drop")])
    df.collect()
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(l_discount,0.08)" in txt.replace(" ", "")


def test_total_without_single_partition_window(spark):
    p = plan(with_total(spark.read.parquet(f"{SF}/orders.parquet")))
    # only the partial counts (one row per task) meet in one partition
    assert "Window" not in p and "partial_count" in p


def test_the_layout_is_the_callers_choice(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    # plain windows: one exchange, no checkpoint
    plain = plan(ordered(df, ["k"], ["t"], seq="s", parts=8))
    assert "Window" in plain and "ExistingRDD" not in plain
    # the range layout, read back from its checkpoint and stitched by broadcast joins with
    # the (partition-bounded) boundary tables
    layout = plan(ordered(df, ["k"], ["t"], seq="s", parts=8, layout=RANGE))
    assert "ExistingRDD" in layout and "BroadcastHashJoin" in layout
    with pytest.raises(ValueError):
        ordered(df, ["k"], ["t"], seq="s", layout="other")


def test_building_a_plan_runs_no_job(spark):
    names = ["scd2_as_of", "scd2_tracked", "line_sequence", "conversation_turns", "unique_first", "auto_field_types", "profile_outliers"]
    tracker = spark.sparkContext.statusTracker()
    for name in names:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        # reading a Parquet file's schema may take a job of its own
        E.queries()[name](spark, SF)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        assert len(jobs) <= 2, (name, jobs)
    spark.sparkContext.setJobGroup("rest", "rest")


@pytest.mark.parametrize("name", ["scd2_as_of", "fact_orders", "bridge_order_part", "changes_between",
                                  "attach_summary", "in_having_limit"])
def test_no_pairs_within_groups(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_the_fact_scans_each_source_once(spark):
    p = plan(E.queries()["fact_orders"](spark, SF))
    for name in ("orders", "customer", "nation", "region"):
        assert len(re.findall(rf"FileScan parquet[^\n]*/{name}\.parquet", p)) == 1, name


def _small(spark, tmp_path, lines=40):
    """Tables with a few orders, their lines numbered from 1."""
    d = str(tmp_path)
    spark.range(lines).selectExpr("id div 4 AS l_orderkey", "id AS l_partkey", "id % 7 AS l_suppkey", "cast(id % 4 + 1 AS int) AS l_linenumber", "cast(id AS double) AS l_quantity",
                                  "'A' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'2024-01-01' AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(lines // 4).selectExpr("id AS o_orderkey", "id AS o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 AS int)) AS o_orderstatus",
                                       "timestamp_ntz'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{d}/orders.parquet")
    return d


@pytest.mark.parametrize("city, key", [("a", "Inspection ID"), ("b", "inspection_id")])
def test_a_city_flow_shuffles_its_violations_once(spark, tmp_path, city, key):
    d = _small(spark, tmp_path)
    p = plan({"a": flows.q_city_a_flow, "b": flows.q_city_b_flow}[city](spark, d))
    main = p[:p.index("Subquery")] if "Subquery" in p else p
    # the rows of an inspection meet once; windows, summary and join-back stay in that stage
    assert len([x for x in p.splitlines() if "hashpartitioning(" + key in x]) == 1 and "REPARTITION_BY_NUM" in main


def test_cross_row_flags_computes_each_city_once(spark, tmp_path):
    p = plan(flows.q_cross_row_flags(spark, _small(spark, tmp_path)))
    met = [x for x in p.splitlines() if "hashpartitioning(Inspection ID" in x or "hashpartitioning(inspection_id" in x]
    assert len(met) == 2 and all("REPARTITION_BY_NUM" in x for x in met)
    assert not [x for x in p.splitlines() if "Join" in x and ("Inspection ID" in x or "inspection_id" in x)]


def test_partitions_follow_the_input(spark, tmp_path):
    d = _small(spark, tmp_path)
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    size = input_bytes(li)
    assert size == sum(f.stat().st_size for f in (tmp_path / "lineitem.parquet").glob("part-*"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(li) == least and partitions_for(li, size // 50) >= 50 and partitions_for(li, 1, most=300) == 300
    assert input_bytes(spark.range(3)) == 0


def test_slots_to_rows_deals_lines_by_the_input(spark, tmp_path, monkeypatch):
    d = _small(spark, tmp_path)
    monkeypatch.setattr(catalog, "partitions_for", lambda df, per_partition=0: 33)
    p = plan(catalog.q_slots_to_rows(spark, d))
    assert p.count("Exchange") == 1 and ", 33), REPARTITION_BY_NUM" in p
    got = sorted((r.l_orderkey, r.l_linenumber, r.qty, r.max_part) for r in catalog.q_slots_to_rows(spark, d).collect())
    assert got == [(i // 4, i % 4 + 1, float(i), i) for i in range(40)]


def test_city_b_slots_are_filled_in_line_order(spark, tmp_path):
    # 30 lines of one order: 25 stand on the first row, in their order, the others on a second row
    spark.range(30).selectExpr("1L AS l_orderkey", "29 - id AS l_partkey", "id AS l_suppkey", "cast(id + 1 AS int) AS l_linenumber", "'A' AS l_returnflag",
                               "'O' AS l_linestatus", "timestamp_ntz'2024-01-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L AS o_orderkey, timestamp_ntz'2024-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    raw = flows.city_b_raw(spark, str(tmp_path))
    codes = [[r[f"Violation Description - {i}"] for i in range(1, 26)] for r in raw.orderBy("FileName").collect()]
    assert [[c and int(c[1:].split()[0]) for c in row] for row in codes] == [list(range(29, 4, -1)), [4, 3, 2, 1, 0] + [None] * 20]
    p = plan(raw)
    assert "REPARTITION_BY_NUM" in p and "SortAggregate" not in p


def test_cross_row_flags_carries_only_what_it_needs(spark, tmp_path):
    lines = plan(flows.q_cross_row_flags(spark, _small(spark, tmp_path))).splitlines()
    # an inspection's rows are not packed again, its texts not joined, and what its rows share is not sorted with its violations
    assert not [x for x in lines if "Aggregate" in x and ("Inspection ID" in x or "inspection_id" in x)]
    assert not [x for x in lines if "all_violation" in x]
    firsts = [x for x in lines if "WindowGroupLimit" in x]
    assert len(firsts) == 2 and not [x for x in firsts if "DBA Name" in x or "dba_name" in x]
    # the types of the numbers are found without making the violations' texts
    assert not [x for x in lines if "RLIKE(concat_ws" in x]
    assert len([x for x in lines if "functions=[collect_list(struct(k0" in x]) == 1


def test_city_b_slots_meet_packed(spark, tmp_path):
    lines = plan(flows.q_city_b_flow(spark, _small(spark, tmp_path))).splitlines()
    met = next(i for i, x in enumerate(lines) if "hashpartitioning(inspection_id" in x)
    assert [x for x in lines[:met] if "Generate inline(_slots" in x] and not [x for x in lines[:met] if "Violation Description - 25" in x]
