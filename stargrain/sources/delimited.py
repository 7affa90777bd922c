"""Delimited files and tables."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stargrain.sources.quoted import SPLIT_ENCODINGS, first_lines, read_quoted


def _files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files behind paths, folders and globs, in name order (hidden files left out)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [str(x.getPath()) for x in inner if not x.isDirectory() and x.getPath().getName()[0] not in "._"]
    if not found:
        raise FileNotFoundError(f"no files: {list(paths)}")
    return sorted(found)


def header_columns(spark: SparkSession, path: str, sep: str = "\t", encoding: str = "ISO-8859-1") -> list[str]:
    """Column names from the first line of one file, read by the driver alone (no job)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(conf).open(hadoop)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hadoop)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
        line = reader.readLine()
    finally:
        stream.close()
    if line is None:
        return []
    return _names(line, sep)


def _names(line: str, sep: str) -> list[str]:
    return [c if c != "" else f"_c{i}" for i, c in enumerate(next(csv.reader([line.removeprefix("\ufeff").removesuffix("\r")], delimiter=sep)))]


def header_groups(spark: SparkSession, files: Sequence[str], sep: str = "\t", encoding: str = "ISO-8859-1") -> dict[tuple[str, ...], list[str]]:
    """The files of each header, in name order.  Tasks read the first lines and Spark groups them, so the driver opens
    no file; it sees the distinct headers and the file names that it lists itself.  Files without a line are left out.
    (In an encoding whose line feeds are not one byte the driver reads the headers.)"""
    if encoding.upper() not in SPLIT_ENCODINGS:
        out: dict[tuple[str, ...], list[str]] = {}
        for p in files:
            out.setdefault(tuple(header_columns(spark, p, sep, encoding)), []).append(p)
        return out
    asked = {unquote(p): p for p in files}
    grouped = first_lines(spark, files, encoding.upper()).groupBy("line").agg(F.collect_list("path").alias("paths"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in grouped.toLocalIterator():
        found.setdefault(tuple(_names(r["line"], sep)), []).extend(asked[unquote(p)] for p in r["paths"])
    return {h: sorted(p) for h, p in sorted(found.items(), key=lambda x: min(x[1]))}


def all_string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, paths: str | Sequence[str], *, sep: str = "\t",
                   encoding: str = "ISO-8859-1", multiline: bool = False,
                   columns: Sequence[str] | None = None, source_file: str | None = "FileName",
                   corrupt: str | None = None, split: bool = True) -> DataFrame:
    """S1-S4 + O4: header + delimiter + encoding, every column a string.

    Globs and folders are expanded first and files are grouped by their own
    header: files that share one are one multi-path scan, others are scanned per
    header and unioned by name (a column missing in one group is NULL there)
    with a warning, as the workflow's union does.  The reader checks each
    file's header against the schema.  A record with more or fewer fields than
    the header stops the read, or with ``corrupt`` is kept and its text put in the
    column of that name.  ``multiline`` lets quoted fields hold record breaks (S2):
    such files are split as well (:mod:`stargrain.sources.quoted`); ``split=False``, or an
    encoding in which a quote is not one byte, takes each file in one task.
    ``source_file`` adds the file name of each row.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = _files(spark, paths)
    groups = {tuple(columns): files} if columns else header_groups(spark, files, sep, encoding)
    if not groups:
        raise ValueError(f"no header in {paths}: all files are empty")
    if len(groups) > 1:
        warnings.warn(f"read_delimited: {len(groups)} different headers; unioning by column name")
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", multiline)
              .option("enforceSchema", columns is not None).option("mode", "PERMISSIVE" if corrupt else "FAILFAST"))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    out = None
    for cols, group in groups.items():
        if multiline and split and encoding.upper() in SPLIT_ENCODINGS:
            df = read_quoted(spark, group, all_string_schema([*cols, corrupt] if corrupt else cols), sep=sep, encoding=encoding.upper(),
                             header=cols if columns is None else None, corrupt=corrupt, source_file=source_file)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
            continue
        df = reader.schema(all_string_schema([*cols, corrupt] if corrupt else cols)).csv(group)
        if source_file:
            df = df.withColumn(source_file, F.col("_metadata.file_name"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_inferred_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``inferSchema`` CSV load (one extra pass over the file to infer)."""
    return spark.read.option("inferSchema", True).option("header", True).option("sep", sep).csv(path)


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", encoding: str = "ISO-8859-1",
                    line_sep: str = "\r\n", mode: str = "overwrite") -> None:
    """Header, CRLF, Latin-1, quotes only where needed."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
       .option("lineSep", line_sep).option("quoteAll", False).option("escape", '"').csv(path))


def save_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table (parquet directory)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_named(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Overwrite a table of the session's catalog by name (its files at ``path``, else in the warehouse)."""
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def scan_named(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog."""
    return spark.table(name)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """S12 ``DESCRIBE TABLE``: (column, type) from the schema."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def with_audit(df: DataFrame, prefix: str = "bronze", source_system: str | None = None) -> DataFrame:
    """Load timestamp/date (non-deterministic; never oracle-compared)."""
    out = df.withColumn(f"{prefix}_load_timestamp", F.current_timestamp()) \
        .withColumn(f"{prefix}_load_date", F.current_date())
    if source_system:
        out = out.withColumn("source_system", F.lit(source_system))
    return out
