"""Split scan of delimited files whose quoted fields hold record breaks.

A line can end a record or stand in the middle of a quoted field, and which it is depends on all
quotes before it in the file.  So the file's byte ranges are scanned twice, each time in as many tasks as
there are ranges:

1. Every range reports what it does to the state at its start ("outside" or "inside a quoted field"): where it ends if it
   starts outside, and where if it starts inside.  Lines without a quote change nothing and stay in the JVM.
   A prefix over the ranges (one row each) then fixes the state that each range starts in.
2. Every range puts its lines together to records.  Those that cross a range's end come as pieces; the pieces
   of one record, found by the prefix as well, are joined.

Following the state along a task's lines has no form in SQL functions without sorting and shuffling the text, so
both scans are Arrow functions over a task's lines; fields are parsed by ``from_csv``.  What the driver
sees is a state per range, as many as the splits that Spark's own planner lists there.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# encodings whose quotes and line feeds are the ASCII bytes, and that the JVM decodes by itself
SPLIT_ENCODINGS = ("ISO-8859-1", "US-ASCII", "UTF-8")
_STATE = "path string, block bigint, from_outside boolean, from_inside boolean"
_RECORD = "path string, file string, block bigint, piece int, text string"
# what a row of the second scan is: a record, or a piece of one that goes on in the next range, that came from the one
# before, or both
WHOLE, OPENS, CLOSES, MIDDLE = 0, 1, 2, 3


def first_lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    """(path, line): the first line of every file, read by tasks; empty files have none.

    The rows of a range come in file order, so the first one of a range that starts at 0 is the file's first.  A range that does
    not end its file fills its task alone (the planner packs only smaller ones together), so such a task
    stops after its first rows instead of reading on.
    """
    raw = spark.read.option("lineSep", "\n").text(list(files))
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("more"),
                       text.alias("line"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            paths = batch.column(0)
            # where a file begins in the batch: a path unlike the one before
            found = [(paths[i].as_py(), batch.column(3)[i].as_py()) for i, _ in _runs(paths)
                     if batch.column(1)[i].as_py() == 0 and paths[i].as_py() != before]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["path", "line"])
            if len(batch):
                before = paths[len(batch) - 1].as_py()
                if batch.column(2)[len(batch) - 1].as_py():
                    return

    return lines.mapInArrow(scan, "path string, line string")


def _runs(*columns: pa.Array) -> list[tuple[int, int]]:
    """(from, to) of the stretches of a batch on which all ``columns`` stay the same."""
    n = len(columns[0])
    starts = {0} if n else set()
    for c in columns:
        changes = pc.indices_nonzero(pc.not_equal(c.slice(1), c.slice(0, max(0, n - 1))))
        starts.update(i + 1 for i in changes.to_pylist())
    ordered = sorted(starts)
    return list(zip(ordered, [*ordered[1:], n]))


def _lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(list(files))
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"), text.alias("text"))


def _follower(sep: str):
    """``ends_inside(line, inside)``: whether a quoted field is open at the line's end.  A quote opens a field only as
    its first character; in a quoted field a doubled quote is a quote, any other closes it."""
    def ends_inside(line: str, inside: bool) -> bool:
        at = 0
        if not inside:
            if not line.startswith('"'):
                at = line.find(sep + '"')
                if at < 0:
                    return False
                at += len(sep)
            at += 1
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            at = line.find(sep + '"', at + 1)
            if at < 0:
                return False
            at += len(sep) + 1
    return ends_inside


def range_states(lines: DataFrame, sep: str) -> DataFrame:
    """(path, block, inside): the state at the end of each range that has quotes, by the prefix over the ranges; a range
    without any leaves it as it is."""
    ends_inside = _follower(sep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, done = None, [False, True], []
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in _runs(batch.column(0), batch.column(1)):
                at = batch.column(0)[start].as_py(), batch.column(1)[start].as_py()
                if at != key:
                    if key:
                        done.append((*key, *ends))
                    key, ends = at, [False, True]
                outside, inside = ends
                for text in texts[start:end]:
                    # two equal states stay equal
                    same = outside == inside
                    outside = ends_inside(text, outside)
                    inside = outside if same else ends_inside(text, inside)
                ends = [outside, inside]
        if key:
            done.append((*key, *ends))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "block", "from_outside", "from_inside"])

    moves = lines.where(F.col("text").contains('"')).select("path", "block", "text").mapInArrow(scan, _STATE)
    # a range either fixes the state, or keeps or turns the one before: the last that fixed it, and the turns since
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside").cast("int"))
    turns = F.sum(F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)).over(upto)
    counted = moves.withColumn("turns", turns).withColumn("fix", F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), F.col("turns").alias("turns"))))
    last = F.last("fix", ignorenulls=True).over(upto)
    return counted.withColumn("last", last).select(
        "path", "block", ((F.coalesce("last.state", F.lit(0)) + F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2 == 1).alias("inside"))


def _records(lines: DataFrame, ended: dict[str, list[tuple[int, bool]]], sep: str, columns: Sequence[str] | None) -> DataFrame:
    """Records and pieces of records.  ``ended`` has, by path, the ranges with quotes and the states they end in; ``columns``
    is what the header says, or None if it is not checked."""
    from bisect import bisect_left
    sent = lines.sparkSession.sparkContext.broadcast(ended)
    ends_inside = _follower(sep)
    whole, opens, closes, middle = WHOLE, OPENS, CLOSES, MIDDLE
    header = list(columns) if columns is not None else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, first, quoted, parts, out = None, False, False, False, [], []
        crossed = False  # the open record began in an earlier range

        def leave() -> None:
            if parts:
                out.append((middle if crossed else opens, "\n".join(parts)))
            states = sent.value.get(key[0], [])
            at = bisect_left(states, (key[2], False))
            known = at < len(states) and states[at][0] == key[2]
            # the splits are planned for each scan: if they changed in between, some range with quotes is not known
            if quoted and not (known and states[at][1] == inside):
                raise RuntimeError(f"the ranges of {key[0]} are not those of the first scan; run the read again")

        def rows() -> pa.RecordBatch:
            # all of one range: what it has in common is not repeated in Python
            same = [pa.repeat(pa.scalar(v, f.type), len(out)) for v, f in zip(key, kinds)]
            pieces, records = zip(*out)
            return pa.RecordBatch.from_arrays([*same, pa.array(pieces, pa.int32()), pa.array(records, pa.string())], schema=kinds)

        for batch in batches:
            texts = batch.column(3).to_pylist()
            for start, end in _runs(*(batch.column(i) for i in range(3))):
                at = tuple(batch.column(i)[start].as_py() for i in range(3))
                if at != key:
                    if key:
                        leave()
                        if out:
                            yield rows()
                            out = []
                    key, parts = at, []
                    states = sent.value.get(key[0], [])
                    before = bisect_left(states, (key[2], False)) - 1
                    inside = crossed = before >= 0 and states[before][1]
                    first, quoted = key[2] == 0, False
                for text in texts[start:end]:
                    if text.endswith("\r"):
                        text = text[:-1]
                    was = inside
                    if '"' in text:
                        inside, quoted = ends_inside(text, was), True
                    if not was and not inside:
                        if text == "":
                            continue  # empty lines are no records
                        kind, record = whole, text
                    else:
                        parts.append(text)
                        if inside:
                            continue
                        kind, record = (closes if crossed else whole), "\n".join(parts)
                        parts, crossed = [], False
                    if first:
                        first = False
                        found = next(csv.reader([record.removeprefix("﻿")], delimiter=sep))
                        if header is not None and [c or f"_c{i}" for i, c in enumerate(found)] != header:
                            raise ValueError(f"the header of {key[0]} is {found}, not {header}")
                        continue
                    out.append((kind, record))
                if len(out) >= 8192:
                    yield rows()
                    out = []
        if key:
            leave()
        if out:
            yield rows()

    kinds = pa.schema([("path", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("piece", pa.int32()), ("text", pa.string())])
    return lines.mapInArrow(scan, _RECORD)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross ranges, from their pieces: each belongs to the last range before it that opened one."""
    upto = Window.partitionBy("path").orderBy("block", F.col("piece") == OPENS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.last(F.when(F.col("piece") == OPENS, F.col("block")), ignorenulls=True).over(upto)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n")
    return pieces.withColumn("opened", opened).groupBy("path", "file", "opened").agg(text.alias("text")).select("file", "text")


def read_quoted(spark: SparkSession, files: Sequence[str], schema: StructType, *, sep: str, encoding: str,
                header: Sequence[str] | None, corrupt: str | None, source_file: str | None) -> DataFrame:
    """Rows of ``files`` (one header for all, checked unless ``header`` is None), equal to those of a reader that takes each file
    in one task.  Lines end in LF or CRLF (a break inside a field is read as LF); blank lines are skipped.
    A quote that is never closed makes the rest of its file one record."""
    lines = _lines(spark, files, encoding)
    ended: dict[str, list[tuple[int, bool]]] = {}
    for r in range_states(lines, sep).orderBy("path", "block").toLocalIterator():
        ended.setdefault(r["path"], []).append((r["block"], r["inside"]))
    rows = _records(lines, ended, sep, header)
    records = rows.where(F.col("piece") == WHOLE).select("file", "text")
    if any(inside for states in ended.values() for _, inside in states):
        records = records.unionByName(_joined(rows.where(F.col("piece") != WHOLE)))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE" if corrupt else "FAILFAST"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = records.select("file", F.from_csv("text", _ddl(schema), options).alias("r"))
    fields = [F.col(f"r.`{f.name.replace('`', '``')}`") for f in schema.fields]
    return parsed.select(*fields, *([F.col("file").alias(source_file)] if source_file else []))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
