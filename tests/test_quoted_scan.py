"""The split scan of files with quoted record breaks equals the reader that takes a file in one task."""

import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stargrain.sources import quoted
from stargrain.sources.delimited import read_delimited


@contextmanager
def ranges_of(spark, size):
    """Byte ranges of about ``size``."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def both(spark, path, size, **options):
    with ranges_of(spark, size):
        split = Counter(map(tuple, read_delimited(spark, path, multiline=True, **options).collect()))
        whole = Counter(map(tuple, read_delimited(spark, path, multiline=True, split=False, **options).collect()))
    return split, whole


FIELDS = ["", "plain", "5\" pipe", 'a"b', "caf\xe9", "two\nlines", "three\n\nlines", 'say ""hi""', "a,b", "\n", '""', "x" * 90, "tail\n", ",\n,"]


def _text(rng, rows, end):
    def field(v):
        return v if v in ("", "plain", "5\" pipe", 'a"b', "caf\xe9", "x" * 90) and rng.random() < 0.8 else '"' + v.replace('""', '"').replace('"', '""') + '"'
    lines = ["id,note,more"] + [",".join([str(i), field(rng.choice(FIELDS)), field(rng.choice(FIELDS))]) for i in range(rows)]
    return end.join(lines).replace("\n", end) if end != "\n" else "\n".join(lines)


@pytest.mark.parametrize("size", [17, 64, 301, 100_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_scan_equals_the_one_task_reader(spark, tmp_path, size, end):
    rng = random.Random(size)
    for name in ("a", "b"):
        text = _text(rng, 60, end).replace("\r\r\n", "\r\n")
        (tmp_path / f"{name}.csv").write_bytes((text + (end if name == "a" else "")).encode("latin-1"))
    split, whole = both(spark, str(tmp_path), size, sep=",")
    assert sum(whole.values()) == 120 and split == whole


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    body = "\n".join(f'{i}\t"line\n{i}"\tz' for i in range(3000))
    (tmp_path / "a.tsv").write_text("id\tnote\tz\n" + body + "\n")
    with ranges_of(spark, 4096):
        df = read_delimited(spark, str(tmp_path / "a.tsv"), multiline=True)
        lines = quoted._lines(spark, [str(tmp_path / "a.tsv")], "UTF-8")
        tasks = lines.select("block").distinct().count()
        parts = df.rdd.getNumPartitions()
        got = df.agg(F.count("*"), F.countDistinct("note"), F.max(F.length("note")), F.first("FileName")).first()
    assert tasks >= 10 and parts >= 10
    # other ranges than the first scan's would give other records: the read says so instead
    with ranges_of(spark, 1000), pytest.raises(Exception, match="run the read again"):
        df.count()
    assert tuple(got) == (3000, 3000, 9, "a.tsv")


def test_a_record_over_many_ranges(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'id,note\n1,x\n2,"{long}"\n3,"y ""q"" \n"\n\n4,z\n')
    split, whole = both(spark, str(tmp_path / "a.csv"), 50, sep=",")
    assert split == whole and sum(split.values()) == 4


def test_states_follow_the_ranges(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n' + "".join(f'{i},"a\nb"\n' for i in range(40)))
    with ranges_of(spark, 30):
        lines = quoted._lines(spark, [str(tmp_path / "a.csv")], "UTF-8")
        got = [(r["block"], r["inside"]) for r in quoted.range_states(lines, ",").orderBy("block").collect()]
    text = (tmp_path / "a.csv").read_text()
    starts = [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]
    blocks = [b for b, _ in got]
    # a line belongs to the last range that starts before it (or at the file's start); quotes here are never stray
    for (block, inside), after in zip(got, blocks[1:]):
        ending = [s for s in starts if s <= after][-1]
        nxt = text.find("\n", ending) + 1
        assert inside == (text[:nxt].count('"') % 2 == 1)


def test_headers_are_found_by_tasks(spark, tmp_path, monkeypatch):
    from stargrain.sources import delimited
    for i in range(120):
        (tmp_path / f"f {i:04d}.tsv").write_text(["a\tb\n1\t2\n", "\ufeffb\ta\r\n2\t1\r\n", "c\n"][i % 3], encoding="utf-8", newline="")
    (tmp_path / "g.tsv").write_text("")
    (tmp_path / "big.tsv").write_text("a\tb\n" + "".join(f"{i}\tx\n" for i in range(6_000)))
    # the driver opens no file
    monkeypatch.setattr(delimited, "header_columns", lambda *a: pytest.fail("the driver read a header"))
    files = delimited._files(spark, [str(tmp_path)])
    with ranges_of(spark, 20_000):
        groups = delimited.header_groups(spark, files, encoding="UTF-8")
    assert {h: len(p) for h, p in groups.items()} == {("a", "b"): 41, ("b", "a"): 40, ("c",): 40}
    assert all(p == sorted(p) for p in groups.values()) and sum(map(len, groups.values())) == 121
    with pytest.warns(UserWarning, match="3 different headers"):
        df = read_delimited(spark, str(tmp_path), encoding="UTF-8")
    assert set(df.columns) == {"a", "b", "c", "FileName"}
    assert df.where("a = '1' AND b = '2'").count() == 80 and df.where("b = 'x'").count() == 6_000
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "e.tsv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_delimited(spark, str(tmp_path / "only"))


def test_other_widths_and_headers_stop_the_split_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x\ny"\n2\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_delimited(spark, str(tmp_path / "a.csv"), sep=",", multiline=True).collect()
    kept = read_delimited(spark, str(tmp_path / "a.csv"), sep=",", multiline=True, corrupt="bad", source_file=None).collect()
    assert sorted(map(tuple, kept), key=str) == [("1", "x\ny", None), ("2", None, "2")]
    (tmp_path / "b.csv").write_text("id,other\n1,2\n")
    got = read_delimited(spark, [str(tmp_path / "b.csv")], sep=",", multiline=True, columns=["p", "q"], source_file=None)
    assert [tuple(r) for r in got.collect()] == [("1", "2")]
    (tmp_path / "c.csv").write_text("id,note\n")
    assert read_delimited(spark, str(tmp_path / "c.csv"), sep=",", multiline=True).collect() == []


def test_runs_are_the_stretches_without_a_change():
    import pyarrow as pa

    from stargrain.sources.quoted import _runs
    a, b = pa.array(["x", "x", "x", "y", "y", "x"]), pa.array([0, 0, 8, 8, 8, 8])
    assert _runs(a) == [(0, 3), (3, 5), (5, 6)] and _runs(a, b) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert _runs(a.slice(0, 0)) == [] and _runs(a.slice(1, 1)) == [(0, 1)]
