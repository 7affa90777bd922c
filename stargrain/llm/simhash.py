"""SimHash near-duplicates with vantage-point trees over Hamming distance.

Fingerprints are made in Arrow batches (words, shingles, XXH64, majority bits).  Equal fingerprints
become one point.  The top of a vantage-point tree, fitted on a bounded sample of points, cuts the
points into shards: each point has one home shard, and is sent besides to every shard of a lower
number that the triangle bound cannot exclude (its distance to a vantage point is within
``max_distance`` of the cut).  So every pair within ``max_distance`` meets in exactly one shard.  A
shard grows its own tree down to small leaves, prunes by the same bound and compares what is left
exactly; it returns a spanning forest of the links found, not the pairs, so a dense group costs as
many edges as it has points.  Components are joined across shards by grouped minima.

Defined results: null, empty and blank texts have fingerprint 0, which is linked like any other;
fewer words than a shingle: the whole sequence is one shingle; repeated rows each get a row; a null
doc_id never names a component unless all ids in it are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.llm import textbuf
from stargrain.llm.common import cut, free_name, in_arrow, q
from stargrain.llm.components import connected_components

SHINGLE, MAX_DISTANCE, SEED = 3, 3, 42
# points the shards' tree is fitted on (all points are then indexed)
SAMPLE_POINTS = 16_384
# points a shard should have; the depth of the shards' tree follows the number of points
SHARD_POINTS = 131_072
LEAST_DEPTH = 4
LEAF = 48


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text whose A-Z are lower-cased already."""
    words = text.split()  # bytes.split() parts at space and U+0009..U+000D exactly
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    joined = b" ".join(words)
    last = ends[min(shingle, len(words)) - 1:].tolist()
    first = [0, *(ends[:len(last) - 1] + 1).tolist()]
    counts, n = np.zeros(64, np.int64), len(last)
    for at in range(0, n, 65_536):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(first[at:at + 65_536], last[at:at + 65_536])],
                                 repeat(SEED)), np.uint64, min(65_536, n - at))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], text: str, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textbuf.buffer_of(batch.column(batch.schema.get_field_index(text)))
        lowered = textbuf.LOWER[data]
        found = np.fromiter((fingerprint(lowered[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:])),
                            np.uint64, len(batch)).view(np.int64)
        keep = [i for i, c in enumerate(batch.schema.names) if c != text]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(found)],
                                         names=[*(batch.schema.names[i] for i in keep), "fp"])


def fingerprints(docs: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``docs`` with ``fp``: the fingerprint's 64 bits as a bigint."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != text] + [T.StructField("fp", T.LongType())])
    return in_arrow(docs, lambda batches: _fingerprints(batches, text, shingle), schema)


# ---------------------------------------------------------------- vantage-point trees

class TopTree:
    """A full vantage-point tree of ``depth`` levels: node k has children 2k + 1 (within the cut) and 2k + 2."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.depth = depth
        self.vantage = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.zeros((1 << depth) - 1, np.int64)
        parts = {0: sample}
        for node in range(len(self.vantage)):
            part = parts.pop(node)
            own = part if len(part) else sample if len(sample) else np.zeros(1, np.uint64)
            self.vantage[node] = own[rng.integers(len(own))]
            distance = np.bitwise_count(own ^ self.vantage[node]).astype(np.int64)
            self.radius[node] = int(np.median(distance))
            distance = np.bitwise_count(part ^ self.vantage[node])
            parts[2 * node + 1] = part[distance <= self.radius[node]]
            parts[2 * node + 2] = part[distance > self.radius[node]]

    def route(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point number, shard, is home) of every shard that may hold a point within ``reach``."""
        row, node, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
        for _ in range(self.depth):
            distance = np.bitwise_count(points[row] ^ self.vantage[node]).astype(np.int64)
            radius = self.radius[node]
            inner, outer = distance <= radius + reach, distance + reach > radius
            near = distance <= radius
            row = np.concatenate([row[inner], row[outer]])
            node, home = (np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2]),
                          np.concatenate([home[inner] & near[inner], home[outer] & ~near[outer]]))
        return row, node, home


class Forest:
    """Least-label union of points."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def shard_links(points: np.ndarray, homes: int, reach: int, leaf: int = LEAF, seed: int = 7) -> np.ndarray:
    """Least label of each point (the first ``homes`` live here, the others visit) after linking all
    home-home and home-visitor pairs within ``reach``."""
    forest, rng = Forest(len(points)), np.random.default_rng(seed)
    first, second, held = [], [], 0

    def flush():
        nonlocal held
        if first:
            forest.link(np.concatenate(first), np.concatenate(second))
        first.clear(), second.clear()
        held = 0

    # (targets: homes of this node; queries: points that may be near one of them; cuts that failed so far)
    stack = [(np.arange(homes), np.arange(len(points)), 0)]
    while stack:
        targets, queries, failed = stack.pop()
        if not len(targets) or len(queries) < 2:
            continue
        if len(targets) <= leaf or failed >= 4:
            step = max(1, (1 << 20) // len(queries))
            for at in range(0, len(targets), step):
                part = targets[at:at + step]
                x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[queries][None, :]) <= reach)
                x, y = part[x], queries[y]
                apart = x != y
                first.append(x[apart]), second.append(y[apart])
                held += int(apart.sum())
                if held > 1 << 20:
                    flush()
            continue
        vantage = points[targets[rng.integers(len(targets))]]
        of_targets = np.bitwise_count(points[targets] ^ vantage).astype(np.int64)
        of_queries = np.bitwise_count(points[queries] ^ vantage).astype(np.int64)
        farthest = int(of_targets.max())
        ball = of_queries + farthest <= reach  # the triangle bound includes the whole node
        if ball.any():
            first.append(np.full(int(ball.sum()), targets[0])), second.append(queries[ball])
            first.append(np.full(len(targets), targets[0])), second.append(targets)
            if ball.all():
                continue
        radius = int(np.median(of_targets))
        inside = of_targets <= radius
        failed = failed + 1 if inside.all() else 0
        stack.append((targets[inside], queries[of_queries <= radius + reach], failed))
        stack.append((targets[~inside], queries[of_queries + reach > radius], 0))
    flush()
    return forest.label


def _shard_edges(pdf: pd.DataFrame, reach: int) -> pd.DataFrame:
    # the order of arrival must not matter to a retried task
    pdf = pdf.sort_values(["home", "fp"], ascending=[False, True], kind="stable")
    fp = pdf["fp"].to_numpy(np.int64)
    label = shard_links(fp.view(np.uint64), int(pdf["home"].sum()), reach)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"u": fp[moved], "v": fp[label[moved]]})


def links(points: DataFrame, max_distance: int = MAX_DISTANCE, *, sample_points: int = SAMPLE_POINTS,
          shard_points: int = SHARD_POINTS, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """Edges ``(u, v)`` that span every group of distinct ``points(fp)`` linked at ``max_distance`` bits or fewer."""
    n = points.count()
    depth = max(least_depth, int(np.ceil(np.log2(max(1, n) / shard_points))) if n else 0)
    # the points whose hash is smallest: a bounded sample, the same at every run
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(sample_points).collect()
    tree = TopTree(np.sort(np.array([r["fp"] for r in sample], np.int64)).view(np.uint64), depth, np.random.default_rng(7))
    sent = points.sparkSession.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 8192):
                part = fp[at:at + 8192]
                row, shard, home = sent.value.route(part.view(np.uint64), max_distance)
                own = np.empty(len(part), np.int64)
                own[row[home]] = shard[home]
                keep = home | (shard < own[row])  # each pair meets in the lower of its two home shards
                yield pa.RecordBatch.from_arrays([pa.array(shard[keep]), pa.array(part[row[keep]]), pa.array(home[keep])],
                                                 names=["shard", "fp", "home"])

    routed = in_arrow(points.select("fp"), route, "shard bigint, fp bigint, home boolean")
    return routed.groupBy("shard").applyInPandas(lambda pdf: _shard_edges(pdf, max_distance), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_distance: int = MAX_DISTANCE, row_key: bool = False, **options) -> DataFrame:
    """Per document: doc_id, fp (bigint) and component_id (the least doc_id reachable over links);
    with ``row_key`` also a digest of id and text, and the component's root fingerprint."""
    columns = [F.col(q(doc_id)).alias("doc_id"), F.col(q(text)).alias("text")]
    if row_key:
        columns.append(_row_key(doc_id, text).alias("row_key"))
    prints = cut(fingerprints(docs.select(*columns), "text", shingle))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(links(points.select("fp"), max_distance, **options))
    by_point = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = by_point.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = cut(by_point.join(least, "root").select("fp", "component_id", *(["root"] if row_key else [])))
    return prints.join(named, "fp")


def _row_key(doc_id: str, text: str):
    # the id's length parts id and text, whatever they hold
    id_ = F.col(q(doc_id)).cast("string")
    return F.sha2(F.concat_ws(":", F.coalesce(F.length(id_).cast("string"), F.lit("null")), id_, F.coalesce(F.col(q(text)), F.lit(""))), 256)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return near_duplicates(docs, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the document of least id of each component (one without an id only if none has one); of
    rows that share that id, the one whose text has the least digest stays, once."""
    # components are told apart by their root: ids may be null or repeated
    found = near_duplicates(docs, doc_id=doc_id, text=text, row_key=True, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key"))
    kept = found.groupBy("root").agg(first.alias("first")).select(F.col("first.row_key").alias("k"))
    key = free_name(docs.columns, "row_key")
    rows = docs.withColumn(key, _row_key(doc_id, text)).join(kept.withColumnRenamed("k", key), key, "left_semi")
    return rows.dropDuplicates([key]).select(*[F.col(q(c)) for c in docs.columns])
