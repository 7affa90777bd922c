import os

from pyspark.sql import functions as F

from stargrain.operators.scd2 import END, START, scd2_apply, scd2_stage
from stargrain.plans.catalog import orders_text, typed_layer
from stargrain.sources.delimited import read_delimited, write_delimited
from stargrain.streaming.streams import (incremental_scd2, run_available_now, run_foreach_batch, scd2_store,
                                         stream_source)


def test_read_delimited_latin1_quotes_multiline(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.tsv").write_bytes('Name\tCity\tNote\nCaf\xe9\tChicago\t"two\nlines"\n'.encode("latin-1"))
    (d / "b.tsv").write_bytes("Name\tCity\tNote\nBar\t\t\n".encode("latin-1"))
    df = read_delimited(spark, [str(d / "a.tsv"), str(d / "b.tsv")], multiline=True)
    rows = sorted((r.Name, r.City, r.Note, r.FileName) for r in df.collect())
    assert rows == [("Bar", None, None, "b.tsv"), ("Café", "Chicago", "two\nlines", "a.tsv")]
    assert all(t == "string" for _, t in df.dtypes)


def test_write_delimited_crlf_latin1(spark, tmp_path):
    df = spark.createDataFrame([("Café", "a,b")], "n string, m string")
    out = str(tmp_path / "out")
    write_delimited(df.coalesce(1), out)
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    raw = open(os.path.join(out, part), "rb").read()
    assert raw == 'n,m\r\nCaf\xe9,"a,b"\r\n'.encode("latin-1")


def _write_parts(spark, df, path, n):
    df.repartition(n).write.mode("overwrite").parquet(path)


def test_stream_equals_batch_typed_layer(spark, tmp_path):
    src = str(tmp_path / "src")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    _write_parts(spark, orders_text(orders), src, 3)
    schema = spark.read.parquet(src).schema
    stream = typed_layer(stream_source(spark, src, schema, max_files_per_trigger=1))
    run_available_now(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = typed_layer(spark.read.parquet(src))
    assert got.count() == want.count() == orders.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_scd2_out_of_order_batches(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = str(tmp_path / "src")
    # batch 1: the later half of the month, batch 2: the earlier half (late data)
    late_first = events.where(F.dayofmonth("ts") >= 15)
    early = events.where(F.dayofmonth("ts") < 15)
    late_first.write.mode("overwrite").parquet(src + "/p1")
    schema = events.schema
    body = incremental_scd2(str(tmp_path / "log"), str(tmp_path / "ver"), ["user_id"], "ts", tracked=["event_type"])
    stage = scd2_stage(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src),
                       ["user_id"], ["event_type"], "ts")
    run_foreach_batch(stage, body, str(tmp_path / "ckpt"))
    early.write.mode("overwrite").parquet(src + "/p2")
    stage = scd2_stage(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src),
                       ["user_id"], ["event_type"], "ts")
    run_foreach_batch(stage, body, str(tmp_path / "ckpt"))
    # an epoch that is run again changes nothing; later epochs hold only the keys they touched
    body(scd2_stage(early, ["user_id"], ["event_type"], "ts"), 1)
    epochs = spark.read.parquet(str(tmp_path / "ver"))
    assert epochs.where("sg_epoch = 1").select("user_id").distinct().count() == early.select("user_id").distinct().count()
    got = scd2_store(spark, str(tmp_path / "ver"), ["user_id"]).select("user_id", "event_type", START, END, "row_version")
    want = scd2_apply(scd2_stage(events, ["user_id"], ["event_type"], "ts"), ["user_id"], "ts",
                      tracked=["event_type"]).select("user_id", "event_type", START, END, "row_version")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_inferred_csv_table_sink_audit_describe(spark, tmp_path):
    from stargrain.sources.delimited import describe, read_inferred_csv, save_table, with_audit
    p = tmp_path / "u.csv"
    p.write_text("a,b,c\n1,x,2.5\n2,y,3.0\n")
    df = read_inferred_csv(spark, str(p))
    assert describe(df) == [("a", "int"), ("b", "string"), ("c", "double")]
    out = str(tmp_path / "t")
    save_table(with_audit(df, "bronze", "desktop_etl"), out)
    back = spark.read.parquet(out)
    assert back.count() == 2 and {"bronze_load_timestamp", "bronze_load_date", "source_system"} <= set(back.columns)


def test_stream_observed_expectations(spark, tmp_path):
    from stargrain.operators.quality import Expectation, kept, observe_stream
    src = str(tmp_path / "src")
    spark.range(10).selectExpr("id", "id % 3 AS m").write.parquet(src)
    rules = [Expectation("m_not_zero", "m <> 0", "drop")]
    s = observe_stream(spark.readStream.schema("id long, m long").parquet(src), rules, "dq")
    prog = run_available_now(kept(s, rules), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    assert prog["observedMetrics"]["dq"]["m_not_zero"] == 4


def test_dedup_stream_with_watermark(spark, tmp_path):
    from stargrain.streaming.streams import dedup_stream
    src = str(tmp_path / "src")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id")
    ev.write.parquet(src + "/a")
    ev.write.parquet(src + "/b")          # every event arrives twice
    s = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(src)
    for et, delay in [(None, None), ("ts", "40 days")]:
        out = str(tmp_path / f"out_{et}")
        run_available_now(dedup_stream(s, ["event_id"], et, delay), out, out + "_ck")
        assert spark.read.parquet(out).count() == ev.count()


def test_read_delimited_unions_different_headers(spark, tmp_path):
    import warnings
    (tmp_path / "a.tsv").write_bytes(b"A\tB\n1\t2\n")
    (tmp_path / "b.tsv").write_bytes(b"B\tC\n3\t4\n")
    (tmp_path / "c.tsv").write_bytes(b"A\tB\n5\t6\n")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        df = read_delimited(spark, [str(tmp_path / n) for n in ["a.tsv", "b.tsv", "c.tsv"]])
    assert any("different headers" in str(x.message) for x in w)
    got = sorted((tuple(r) for r in df.select("A", "B", "C", "FileName").collect()), key=lambda t: t[3])
    assert got == [("1", "2", None, "a.tsv"), (None, "3", "4", "b.tsv"), ("5", "6", None, "c.tsv")]


def test_change_feed_stream_into_bronze(spark, tmp_path):
    from stargrain.sources.changes import diff_snapshots, stream_changes
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "k int, v string")
    log = str(tmp_path / "changes")                       # append-only change log, one commit per write
    diff_snapshots(old.limit(0), old, ["k"], version=1, commit_ts="2024-01-01 00:00:00").write.parquet(log)
    diff_snapshots(old, new, ["k"], version=2, commit_ts="2024-01-02 00:00:00").write.mode("append").parquet(log)
    schema = spark.read.parquet(log).schema
    assert spark.read.parquet(log).count() == 5
    bronze = stream_changes(spark, log, schema, since_version=2, types=["insert", "update_postimage"])
    run_available_now(bronze, str(tmp_path / "bronze"), str(tmp_path / "ck"))
    got = sorted((r.k, r.v, r._change_type) for r in spark.read.parquet(str(tmp_path / "bronze")).collect())
    assert got == [(2, "B", "update_postimage"), (3, "c", "insert")]


def test_header_latin1_and_quoted(spark, tmp_path):
    from stargrain.sources.delimited import header_columns
    (tmp_path / "h.tsv").write_bytes('Caf\xe9 Name\t"Zip\tCode"\r\nx\ty\r\n'.encode("latin-1"))
    assert header_columns(spark, str(tmp_path / "h.tsv")) == ["Café Name", "Zip\tCode"]
    df = read_delimited(spark, str(tmp_path / "h.tsv"))
    assert [tuple(r) for r in df.collect()] == [("x", "y", "h.tsv")]


def test_headers_in_another_order_are_not_mixed_up(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b"a\tb\n1\t2\n")
    (tmp_path / "b.tsv").write_bytes(b"b\ta\n10\t20\n")
    df = read_delimited(spark, str(tmp_path / "*.tsv"), source_file=None)
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "2"), ("20", "10")]


def test_records_of_another_width_are_seen(spark, tmp_path):
    import pytest
    (tmp_path / "m.csv").write_bytes(b"a,b\n1,2\n1,2,3\n4\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path / "m.csv"), sep=",").collect()
    rows = read_delimited(spark, str(tmp_path / "m.csv"), sep=",", corrupt="bad", source_file=None).collect()
    assert [r.bad for r in rows] == [None, "1,2,3", "4"]


def test_header_of_a_compressed_file(spark, tmp_path):
    import gzip
    (tmp_path / "z.tsv.gz").write_bytes(gzip.compress("é\tb\n1\t2\n".encode("latin-1")))
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path / "z.tsv.gz"), source_file=None).collect()] == [("1", "2")]


def test_named_tables(spark):
    from stargrain.sources.delimited import save_named, scan_named
    save_named(spark.range(3), "sg_named_probe")
    save_named(spark.range(5), "sg_named_probe")
    assert scan_named(spark, "sg_named_probe").count() == 5
    spark.sql("DROP TABLE sg_named_probe")


def test_streams_wait_unless_told_otherwise(spark, tmp_path):
    import inspect
    assert inspect.signature(run_available_now).parameters["limit_s"].default is None
    assert inspect.signature(run_foreach_batch).parameters["limit_s"].default is None


def test_a_cluster_must_name_its_checkpoint_folder():
    import pytest
    from stargrain import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
