"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ascending list of the k least distinct 64-bit hashes of a text's word shingles.
Sketches merge (the k least of the union), so a text, a part of a corpus or a whole corpus can be sketched
in parts.  Two sketches estimate resemblance (Jaccard), containment and distinct shingle counts;
texts with fewer than k distinct shingles are compared exactly.

Defined results: null counts as empty; a text without words has an empty sketch; fewer words than a
shingle: the whole sequence is one shingle; two empty sketches have likeness 1, an empty and
another 0; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import BLANK, LOWER, UPPER, let, q

SHINGLE = 5
K = 128
BLANKS = " \t\n\x0b\x0c\r"
# rows of the id order that go to one task
RANGE_ROWS = 2_000
# ranges at most: bounds what is broadcast about them (a few MB)
MOST_RANGES = 100_000


def words(text: Column) -> Column:
    trimmed = F.btrim(F.translate(text, UPPER, LOWER), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK))


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """``array<bigint>``: the k least distinct shingle hashes, ascending."""

    def hashes(w: Column) -> Column:
        full = F.transform(F.sequence(F.lit(0), F.size(w) - shingle),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(shingle)]))
        return F.when(F.size(w) >= shingle, full) \
            .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))) \
            .otherwise(F.array().cast("array<bigint>"))

    # sorted first, so that the distinct step meets an ascending list
    return F.slice(F.array_distinct(F.sort_array(let(words(F.coalesce(text, F.lit(""))), hashes))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Of the k least hashes of the union, the share that both have."""
    def of(u: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(a, b), u))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(common / F.size(u))
    return let(merge(a, b, k), of)


def distinct_count(s: Column, k: int = K) -> Column:
    """Distinct shingles: exact below k, else (k - 1) / the k-th least hash as a share of all hashes."""
    place = (F.element_at(s, -1).cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / F.greatest(place, F.lit(1e-18)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Of a's shingles, the share that b has: from resemblance and the two counts."""
    r, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (na + nb) / ((1 + r) * na)))


def fingerprint(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def sketch_groups(rows: DataFrame, keys: Sequence[str], sketches: str, k: int = K) -> DataFrame:
    """Merged sketch by ``keys``: distinct hashes are grouped by Spark and each key keeps its k least."""
    hashes = rows.select(*keys, F.explode(q(sketches)).alias("hash")).groupBy(*keys, "hash").agg(F.lit(1).alias("one"))
    least = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))).where(F.col("rank") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(sketches))


def _range_of(key: Column, edges: list, kind: str) -> Column:
    """How many of the ascending edges lie below a key: looked up in two steps of about the square root of their number."""
    if not edges:
        return F.lit(0)
    width = max(1, int(len(edges) ** 0.5))
    blocks = [edges[i:i + width] for i in range(0, len(edges), width)]
    literal = lambda values: F.array(*[F.struct(F.lit(i), F.lit(h)) for i, h in values]).cast(f"array<{kind}>")
    below = lambda values: F.size(F.filter(values, lambda e: e < key))
    block = F.greatest(F.lit(0), below(literal([x[0] for x in blocks])) - 1)
    tables = F.array(*[literal(x) for x in blocks])
    return let(block, lambda k: k * width + below(F.get(tables, k)))


def _edges(keys: DataFrame, ranges: int) -> list:
    """The least key of each of about ``ranges`` ranges of the order but the first."""
    # the keys alone are dealt by range, whatever their type; a row for each range comes to the driver
    laid = keys.repartitionByRange(ranges, F.col("key")).groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("least"))
    return sorted((tuple(r["least"]) for r in laid.collect()), key=lambda e: ((e[0] is not None, e[0] if e[0] is not None else 0), e[1]))[1:]


def with_next(docs: DataFrame, columns: Sequence[str], derived: dict[str, Column], *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` (doc_id and ``columns``) with the ``derived`` columns, and all of these of the next row by ascending
    doc_id as ``next_<column>``; after the last row the first comes again.  Ids may be of any type that can be ordered.
    Rows are cut into ranges of the order; the first row of each range visits the range before it as well, so that a window within a
    range sees every successor.  Null ids come first; equal ids are ordered by a hash of their columns, which parts the
    ranges as well, so that many rows with one id or none are many ranges."""
    n = docs.count()
    ranges = min(MOST_RANGES, max(1, -(-n // range_rows)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = f"struct<doc_id:{id_type},hash:bigint>"
    keyed = docs.withColumn("key", F.struct("doc_id", F.xxhash64(*columns).alias("hash")))
    laid = keyed.withColumn("range", _range_of(F.col("key"), _edges(keyed.select("key"), ranges) if ranges > 1 else [], kind))
    # one row per range that has rows: where its first key visits (the last range's rows come before the first's)
    ring = laid.groupBy("range").agg(F.min("key").alias("first_key"))
    up, down = Window.orderBy("range"), Window.orderBy(F.col("range").desc())
    ring = ring.select("range", "first_key", F.coalesce(F.lag("range").over(up), F.first("range").over(down)).alias("to"))
    # MOST_RANGES rows of a key and two numbers at most
    visits = laid.join(F.broadcast(ring), "range").where(F.col("key") == F.col("first_key"))
    both = laid.withColumn("guest", F.lit(0)).unionByName(visits.select("doc_id", *columns, "key", F.col("to").alias("range"), F.lit(1).alias("guest")))
    both = both.select("doc_id", "range", "guest", "key", *columns, *[c.alias(name) for name, c in derived.items()])
    window = Window.partitionBy("range").orderBy("guest", "key")
    every = [*columns, *derived]
    return both.select("guest", "doc_id", *every, *[F.lead(c).over(window).alias(f"next_{c}") for c in every]) \
        .where("guest = 0").drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of a text's code points replaced by as many, or all, of the following text's first."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_shingles (estimate) and contained_edited (the share of its shingles that the edited text keeps)."""
    own = docs.select(F.col(q(doc_id)).alias("doc_id"), F.coalesce(F.col(q(text)), F.lit("")).alias("text"))
    paired = with_next(own, ["text"], {"sketch": sketch(F.col("text"), k, shingle)})
    made = paired.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "sketch", "next_sketch",
                         edited(F.col("text"), F.col("next_text")).alias("edited"))
    made = made.withColumn("edited_sketch", sketch(F.col("edited"), k, shingle))
    a, b = F.col("sketch"), F.col("edited_sketch")
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(a).alias("fingerprint"),
                       fingerprint(b).alias("edited_fingerprint"), resemblance(a, b, k).alias("near_edited"),
                       resemblance(a, F.col("next_sketch"), k).alias("near_next"), distinct_count(a, k).alias("n_shingles"),
                       containment(a, b, k).alias("contained_edited"))
