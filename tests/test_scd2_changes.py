import datetime as dt

from pyspark.sql import functions as F

from stargrain.operators.scd2 import END, START, scd2_apply, scd2_final, scd2_lookup_as_of
from stargrain.sources.changes import apply_changes_snapshot, diff_snapshots, read_changes

D = dt.date
MGR = "range"  # the skew-safe layout


def _log(spark):
    rows = [
        ("r1", "A", D(2024, 1, 1)),
        ("r1", "A", D(2024, 1, 5)),    # unchanged repeat
        ("r1", "B", D(2024, 1, 9)),    # change
        ("r1", None, D(2024, 1, 12)),  # change to NULL
        ("r1", "A", D(2024, 1, 20)),   # back to A
        ("r1", "C", D(2024, 1, 7)),    # late, out of order
        ("r2", "X", D(2024, 1, 3)),
        ("r2", "Y", D(2024, 1, 3)),    # two snapshots on one date: largest tuple wins
    ]
    return spark.createDataFrame(rows, "rid string, name string, d date")


def test_scd2_tracked_versions(spark):
    v = scd2_apply(_log(spark), ["rid"], "d", tracked=["name"], parts=4, layout=MGR)
    by = {(r.rid, r.row_version): (r.name, r[START], r[END]) for r in v.collect()}
    assert by[("r1", 1)] == ("A", D(2024, 1, 1), D(2024, 1, 7))
    assert by[("r1", 2)] == ("C", D(2024, 1, 7), D(2024, 1, 9))
    assert by[("r1", 3)] == ("B", D(2024, 1, 9), D(2024, 1, 12))
    assert by[("r1", 4)] == (None, D(2024, 1, 12), D(2024, 1, 20))
    assert by[("r1", 5)] == ("A", D(2024, 1, 20), None)
    assert by[("r2", 1)] == ("Y", D(2024, 1, 3), None)
    assert len(by) == 6


def test_scd2_all_columns_tracked_opens_version_per_date(spark):
    v = scd2_apply(_log(spark), ["rid"], "d", tracked=None, parts=4, layout=MGR)
    assert v.where("rid = 'r1'").count() == 6


def test_scd2_properties(spark):
    v = scd2_final(scd2_apply(_log(spark), ["rid"], "d", tracked=["name"], parts=4, layout=MGR), "rid")
    cur = v.groupBy("rid").agg(F.sum(F.col("is_current").cast("int")).alias("c")).collect()
    assert all(r.c == 1 for r in cur)
    rows = sorted(v.collect(), key=lambda r: (r.rid, r.effective_date))
    for a, b in zip(rows, rows[1:]):
        if a.rid == b.rid:
            assert a.expiration_date == b.effective_date  # contiguous, no overlap


def test_ignore_null_updates(spark):
    v = scd2_apply(_log(spark).where("rid = 'r1'"), ["rid"], "d", tracked=["name"], ignore_null_updates=True, parts=4, layout=MGR)
    names = [r.name for r in sorted(v.collect(), key=lambda r: r[START])]
    assert names == ["A", "C", "B", "A"]  # the NULL update keeps B, then A opens a version


def test_as_of_matches_brute_force(spark):
    v = scd2_apply(_log(spark), ["rid"], "d", tracked=["name"], parts=4, layout=MGR)
    facts = spark.createDataFrame([(1, "r1", D(2023, 12, 31)), (2, "r1", D(2024, 1, 7)), (3, "r1", D(2024, 1, 8)),
                                   (4, "r1", D(2024, 2, 1)), (5, "r2", D(2024, 1, 3)), (6, None, D(2024, 1, 3))],
                                  "fid int, rid string, at date")
    got = {r.fid: r.row_version for r in scd2_lookup_as_of(facts, v, ["rid"], "at", START, ["row_version"], 4, MGR).collect()}
    vs = v.collect()
    for f in facts.collect():
        match = [x.row_version for x in vs if x.rid == f.rid and x[START] <= f.at and (x[END] is None or f.at < x[END])]
        assert got[f.fid] == (match[0] if match else None)


def test_diff_and_replay(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, n string, v double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 5.0), (4, "d", 4.0)], "k int, n string, v double")
    ch = diff_snapshots(old, new, ["k"], version=2, commit_ts="2024-01-01 00:00:00")
    got = sorted((r.k, r._change_type) for r in ch.collect())
    assert got == [(2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "insert")]
    v1 = diff_snapshots(old.limit(0), old, ["k"], version=1, commit_ts="2024-01-01 00:00:00")
    snap = apply_changes_snapshot(read_changes(v1.unionByName(ch), since_version=1), ["k"])
    assert sorted(tuple(r) for r in snap.collect()) == sorted(tuple(r) for r in new.collect())
    assert read_changes(ch, types=["insert"]).count() == 1


def test_scd2_transformed_flags(spark):
    from stargrain.operators.scd2 import scd2_transformed
    v = scd2_transformed(scd2_apply(_log(spark), ["rid"], "d", tracked=["name"], parts=4))
    rows = v.collect()
    assert {r.is_active for r in rows if r.end_dt is None} == {"Y"}
    assert {r.is_active for r in rows if r.end_dt is not None} == {"N"}
    assert "load_at" in v.columns and START not in v.columns


def test_a_repeated_snapshot_key_is_reported(spark):
    import pytest
    from stargrain.sources.changes import diff_snapshots
    old, new = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="repeated"):
        diff_snapshots(old, new, ["k"], version=1).collect()
    assert diff_snapshots(old, new, ["k"], version=1, repeats="least").count() == 2


def test_wide_keys_and_their_check(spark):
    import hashlib
    from stargrain.functions.keys import surrogate_key
    from stargrain.operators.rows import repeated_keys
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "k string").withColumn("sk", surrogate_key("k", "md5_120"))
    assert {r.k: int(r.sk) for r in df.collect()} == {x: int(hashlib.md5(x.encode()).hexdigest()[:30], 16) for x in "ab"}
    assert [(r.k, r.n) for r in repeated_keys(df, ["k"]).collect()] == [("b", 2)]
