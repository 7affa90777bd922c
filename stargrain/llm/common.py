"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.session import checkpoint_root, scratch_dir

# The blanks between words in the shingle operators: space and U+0009..U+000D.
BLANK = "[ \\t-\\r]+"
NOT_BLANK = "[^ \\t-\\r]+"
# A-Z to a-z and nothing else, whatever the locale.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: Iterable[str], wish: str) -> str:
    """``wish``, or ``wish`` with underscores before it, that no column has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def q(name: str) -> str:
    """A column name quoted for use in expressions (names may hold dots)."""
    return "`" + name.replace("`", "``") + "`"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and read it back: the lineage ends
    there and a lost executor costs no recomputation of what stands before."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in a fresh folder of the shared checkpoint folder, read back (columns can be read alone)."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` for a function that needs this package: workers get the folder it was loaded from on their
    path, for sessions on one machine; a cluster's executors have the package installed or shipped with the job."""
    environment = df.sparkSession.sparkContext.environment
    root, known = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return df.mapInArrow(function, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda variable holds it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column) -> Column:
    """Exclusive running sums of an ``array<int or bigint>``, in blocks, so that n values cost n * sqrt(n) at most."""

    def whole(v: Column) -> Column:
        n = F.size(v)
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / width).cast("int") - 1)),
                             lambda b: F.slice(v, b * width + 1, width))
        zero = F.lit(0).cast("bigint")

        def running(array: Column, start: Column) -> Column:
            # the last element of the accumulator is the running total
            return F.aggregate(array, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

        def joined(bs: Column) -> Column:
            sums = F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
            return let(running(sums, zero),
                       lambda starts: F.flatten(F.transform(
                           bs, lambda b, i: let(running(b, F.get(starts, i)), lambda r: F.slice(r, 1, F.size(b))))))

        return F.when(n > 0, let(blocks, joined)).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(values, lambda x: x.cast("bigint")), whole)


def utf8_words(text: str | None, pattern) -> list[bytes]:
    """Words of a text by a bytes pattern, A-Z lower-cased."""
    return pattern.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER_TABLE))


_LOWER_TABLE = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
