"""Merkle manifest of a table: a tree of digests per group (language), a tree over the groups' roots, and a proof per row.

A row's leaf is the SHA-256 of its fields, each with its length.  Within a group the leaves ascend by id; every
``FANOUT`` consecutive nodes (the last run may be shorter, even one) hash to their parent until one is left,
the group's subroot.  Subroots, ordered by group, give the root the same way.

Rows are numbered within their group by the range layout (a group may hold any share of the rows) and cut into
chunks of ``FANOUT ** LEVELS`` consecutive positions, one window partition each.  In a chunk, positions have no
gaps, so the node a run's j-th neighbour on level l stands ``j * FANOUT ** l`` rows away: lag and lead
columns with those fixed offsets, masked by the row's slot in its run and by the run's length, are the
siblings, and the run's first row hashes them to the parent.  All levels share one window order.  A chunk
leaves one node; those are the rows of the next round.  Rounds go up until each group has one node, then
siblings come down, a chunk's to its rows by (group, chunk).  Texts are read once, for the leaves.

Whether a level exists is known in the chunk: a first chunk that is not full is its group's only one, and
every other chunk stands below a node on each level.

Defined results: a null field is hashed as ``-``; a null id sorts first, a null group is a group of its own that sorts
before the others; rows with equal ids ascend by their leaf, and fully equal rows are neighbours with the same leaf;
very long texts only cost their digest; an empty table gives an empty manifest; columns that are not named
as fields are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import LOWER, UPPER, q, stored
from stargrain.operators.ordered import RANGE, sequence

FANOUT = 8
LEVELS = 3  # levels climbed in a round
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(column: Column) -> Column:
    """A field's part of a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, give."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _round(nodes: DataFrame, carried: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """``nodes`` (grp, pos, h and the ``carried`` columns) with chunk, place in the chunk, path (the levels inside the
    chunk) and, on a chunk's first row, top: the chunk's node."""
    width = fanout ** levels
    order = "PARTITION BY grp, chunk ORDER BY place"
    keep = ["grp", "pos", "h", "chunk", "place", *[q(c) for c in carried]]
    rows = nodes.selectExpr("grp", "pos", "h", *[q(c) for c in carried], f"pos div {width} AS chunk", f"int(pos % {width}) AS place")
    rows = rows.selectExpr(*keep, "h AS h0", f"count(1) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS size")
    steps: list[str] = []
    for level in range(levels):
        apart = fanout ** level  # rows between neighbouring nodes
        slot, first = f"(place div {apart} % {fanout})", f"place % {apart} = 0"
        exists = f"(chunk > 0 OR size > {apart})"
        # on a node's first row; a neighbour beyond the chunk's last node is not there (null)
        left = ", ".join(f"if({slot} >= {j}, coalesce(lag(h{level}, {j * apart}) OVER ({order}), ''), '')" for j in range(fanout - 1, 0, -1))
        right = ", ".join(f"if({slot} + {j} < {fanout}, coalesce(lead(h{level}, {j * apart}) OVER ({order}), ''), '')" for j in range(1, fanout))
        rows = rows.selectExpr(*keep, "size", f"h{level}", *steps, f"concat({left}) AS left", f"concat({right}) AS right")
        rows = rows.selectExpr(
            *keep, "size", *steps, f"if({first} AND {exists}, struct(left, right), NULL) AS step{level}",
            f"CASE WHEN place % {apart * fanout} = 0 THEN if({exists}, sha2(concat(h{level}, right), 256), h{level}) END AS h{level + 1}")
        steps.append(f"step{level}")
    # a row's siblings on a level stand on the first row below the same node: the last such row up to it
    upto = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    filled = rows.selectExpr(*keep, "size", f"h{levels} AS top", *[f"last({s}, true) OVER {upto} AS {s}" for s in steps])
    there = ", ".join(f"if(chunk > 0 OR size > {fanout ** i}, {s}, NULL)" for i, s in enumerate(steps))
    return filled.selectExpr(*keep, "top", f"filter(array({there}), s -> s IS NOT NULL) AS path")


def climb(nodes: DataFrame, carried: Sequence[str] = (), *, fanout: int = FANOUT, levels: int = LEVELS,
          beyond: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``nodes`` (grp, pos from 0 within grp, h and the ``carried`` columns) with path (siblings up to the group's
    root, from the bottom) and subroot.  ``beyond`` takes one row per group (grp, h: its subroot) and gives grp, over
    and root: over is added to the paths.  It is joined where a group has a single chunk, so no group's rows meet for it."""
    last = nodes.agg(F.max("pos")).first()[0]
    inside = _round(nodes, carried, fanout, levels)
    rows = ["grp", "pos", "h", *[q(c) for c in carried]]
    if last is None or last < fanout ** levels:
        # every group is one chunk: its top is the root
        upto = Window.partitionBy("grp", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = inside.select(*rows, "path", F.first("top").over(upto).alias("subroot"))
        if beyond is None:
            return whole
        over = beyond(stored(whole.where("pos = 0").select("grp", F.col("subroot").alias("h")), "merkle"))
        return whole.join(over, "grp").select(*rows, F.concat("path", "over").alias("path"), "subroot", "root")
    tops = stored(inside.where("place = 0").select("grp", F.col("chunk").alias("pos"), F.col("top").alias("h")), "merkle")
    above = climb(tops, fanout=fanout, levels=levels, beyond=beyond).drop("h").withColumnRenamed("pos", "chunk").withColumnRenamed("path", "above")
    return inside.join(above, ["grp", "chunk"]).select(*rows, F.concat("path", "above").alias("path"), "subroot", *(["root"] if beyond else []))


def manifest(docs: DataFrame, *, doc_id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
             also: Mapping[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, the group, leaf, subroot, root and path (``array<struct<left, right>>``, the siblings of the
    nodes above the leaf: the group's levels, then those above the subroots), and the columns named in ``also``,
    computed from ``docs`` with the leaves."""
    also = also or {}
    # stored, so that the texts are read and hashed once
    made = stored(docs.select(
        F.col(q(doc_id)).alias("doc_id"), F.col(q(group)).alias("group"),
        # a null group before all others, these in the order of their bytes
        F.when(F.col(q(group)).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(q(group)).cast("string"))).alias("grp"),
        leaf([F.col(q(f)) for f in fields]).alias("h"), *[c.alias(f"also_{n}") for n, c in also.items()]), "merkle")
    carried = ["doc_id", "group", *[f"also_{n}" for n in also]]
    placed = sequence(made, ["grp"], ["doc_id", "h"], out="n", layout=RANGE).withColumn("pos", F.col("n") - 1).drop("n")

    def over(subroots: DataFrame) -> DataFrame:
        ranked = sequence(subroots.select(F.lit("").alias("all"), "grp", "h"), ["all"], ["grp"], out="n", layout=RANGE)
        top = climb(ranked.select(F.col("all").alias("grp"), (F.col("n") - 1).alias("pos"), "h", F.col("grp").alias("of")), ["of"],
                    fanout=fanout, levels=levels)
        return top.select(F.col("of").alias("grp"), F.col("path").alias("over"), F.col("subroot").alias("root"))

    return climb(placed, carried, fanout=fanout, levels=levels, beyond=over).select(
        "doc_id", F.col("group").alias(group if group != doc_id else "group"), F.col("h").alias("leaf"), "subroot", "root", "path",
        *[F.col(q(f"also_{n}")).alias(n) for n in also])


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", fields: Sequence[str] = FIELDS, **options) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, after tampering with the rows whose id's
    crc32 is divisible by 3 (A-Z of their text lower-cased); a null id is left alone."""
    key = F.col(q(doc_id))
    picked = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = leaf([F.translate(F.col(q(f)), UPPER, LOWER) if f == text else F.col(q(f)) for f in fields])
    made = manifest(docs, doc_id=doc_id, fields=fields, also={"tampered": F.when(picked, changed)}, **options)
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(name: str, source: str, levels: int, fanout: int) -> str:
    """CTEs ``{name}0`` to ``{name}{levels}`` (grp, pos, n, h): the nodes of each level, from ``source`` (grp, pos, n, h)."""
    out = [f"{name}0 AS (SELECT grp, pos, n, h FROM {source})"]
    for i in range(levels):
        out.append(f"""{name}{i + 1} AS (SELECT grp, pos // {fanout} AS pos, any_value((n + {fanout - 1}) // {fanout}) AS n,
             sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}{i} WHERE n > 1 GROUP BY grp, pos // {fanout})""")
    return ",\n".join(out)


def _step_sql(name: str, level: int, fanout: int) -> str:
    """Siblings of a row's node on a level, as left and right."""
    return f"""SELECT a.id, {level} AS level, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.at), '') AS l,
       coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.at), '') AS r
  FROM (SELECT id, grp, pos // {fanout ** level} AS at FROM {name}_rows) a
  JOIN {name}{level} b ON a.grp = b.grp AND b.pos // {fanout} = a.at // {fanout} AND b.n > 1 GROUP BY a.id, a.at"""


def report_sql(depth: int = 7, top: int = 2, fanout: int = FANOUT) -> str:
    """The same in SQL, for groups of up to ``fanout ** depth`` rows and ``fanout ** top`` groups."""
    part = lambda c: f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')"
    leaf_of = lambda body: "sha256(" + " || ".join(part(body if f == "text" else f) for f in FIELDS) + ")"
    folds = "".join(f", f{i + 1} AS (SELECT f{i}.id, CASE WHEN l IS NULL THEN f ELSE sha256(l || f || r) END AS f FROM f{i} "
                    f"LEFT JOIN (SELECT * FROM steps WHERE level = {i}) s USING (id))" for i in range(depth + top))
    steps = "\nUNION ALL\n".join([_step_sql("t", i, fanout) for i in range(depth)])
    over = "\nUNION ALL\n".join([_step_sql("u", i, fanout) for i in range(top)])
    return f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
       lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS grp, {leaf_of("text")} AS h,
             CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 3 = 0
                  THEN {leaf_of(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents CROSS JOIN crc_table),
t_rows AS (SELECT id, grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n, h FROM d),
{_tree_sql("t", "t_rows", depth, fanout)},
subroots AS (SELECT grp, h FROM ({" UNION ALL ".join(f"SELECT grp, n, h FROM t{i}" for i in range(depth + 1))}) WHERE n = 1),
u_groups AS (SELECT '' AS grp, grp AS of, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, h FROM subroots),
{_tree_sql("u", "u_groups", top, fanout)},
u_rows AS (SELECT of AS id, grp, pos FROM u_groups),
root AS (SELECT h FROM ({" UNION ALL ".join(f"SELECT n, h FROM u{i}" for i in range(top + 1))}) WHERE n = 1),
over_steps AS ({over}),
steps AS ({steps}
UNION ALL
SELECT t_rows.id, {depth} + level AS level, l, r FROM t_rows JOIN over_steps ON t_rows.grp = over_steps.id),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY level)) AS p FROM steps GROUP BY id),
f0 AS (SELECT id, coalesce(tampered, h) AS f FROM d){folds}
SELECT d.doc_id, d.h AS leaf, subroots.h AS subroot, root.h AS root, coalesce(p, sha256('')) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM d JOIN f{depth + top} USING (id) JOIN subroots USING (grp) CROSS JOIN root LEFT JOIN proofs ON proofs.id = d.id"""


REPORT_SQL = report_sql()
