"""Property tests (hypothesis) on small random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stargrain.operators.ordered import ordered
from stargrain.operators.quality import Expectation, kept, quarantine
from stargrain.operators.reshape import cross_tab, unpivot
from stargrain.operators.scd2 import END, START, scd2_apply

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

log_rows = st.lists(
    st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["A", "B", None]), st.integers(0, 20)),
    min_size=1, max_size=25)


@SETTINGS
@given(rows=log_rows, layout=st.sampled_from(["plain", "range"]))
def test_scd2_invariants(spark, rows, layout):
    data = [(k, v, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for k, v, d in rows]
    log = spark.createDataFrame(data, "k string, v string, d date")
    vs = scd2_apply(log, ["k"], "d", tracked=["v"], parts=3, layout=layout).collect()
    by_key = {}
    for r in vs:
        by_key.setdefault(r.k, []).append(r)
    assert set(by_key) == {k for k, _, _ in rows}
    for k, versions in by_key.items():
        versions.sort(key=lambda r: r[START])
        assert [r.row_version for r in versions] == list(range(1, len(versions) + 1))
        assert sum(r[END] is None for r in versions) == 1 and versions[-1][END] is None
        for a, b in zip(versions, versions[1:]):
            assert a[END] == b[START]                      # contiguous, no overlap
            assert a.v != b.v if (a.v is not None and b.v is not None) else (a.v is None) != (b.v is None)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=60), parts=st.integers(2, 7))
def test_ordered_equals_windows(spark, keys, parts):
    df = spark.createDataFrame([(k, i, (i * 7) % 5 if i % 3 else None) for i, k in enumerate(keys)],
                               "k int, t int, v int")
    res = ordered(df, ["k"], ["t"], seq="s", prev={"p": "v"}, nxt={"n": "t"}, carry={"c": "v"}, parts=parts,
                  layout="range")
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("t", F.row_number().over(w).alias("s"), F.lag("v").over(w).alias("p"),
                    F.lead("t").over(w).alias("n"),
                    F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    got = sorted(tuple(r) for r in res.select("t", "s", "p", "n", "c").collect())
    want = sorted(tuple(r) for r in ref.collect())
    assert got == want


@SETTINGS
@given(vals=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 120)), st.sampled_from(["Dallas", "Chicago", None])),
                     min_size=1, max_size=30))
def test_kept_plus_quarantine_is_input(spark, vals):
    df = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(vals)], "id int, score int, city string")
    rules = [Expectation("score", "city != 'Dallas' OR (score IS NOT NULL AND score <= 100)", "drop"),
             Expectation("pos", "score >= 0", "drop"), Expectation("w", "city IS NOT NULL", "warn")]
    k = {r.id for r in kept(df, rules).collect()}
    q = {r.id for r in quarantine(df, rules).collect()}
    assert k.isdisjoint(q) and k | q == set(range(len(vals)))


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
                               st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))), min_size=1, max_size=20))
def test_unpivot_crosstab_identity(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "k int, a double, b double")
    back = cross_tab(unpivot(df, ["k"], ["a", "b"], "name", "value"), ["k"], "name", "value", ["a", "b"])
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
