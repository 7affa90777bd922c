"""Connected components of an edge list, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and a join back on the grouped node; a hub's
edges can be split by the skew-join rule because the other side has one row per node.  Steps are
written to the shared checkpoint folder; no edge, node or component comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
        .unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one orderable type to ``(node, root)`` for every node of an edge; the root is the
    least node of the component.  Loops and repeated edges do no harm."""
    now = cut(edges.select("u", "v").where("u <> v").distinct())
    state = _state(now)
    while state[0]:
        now = cut(_small_star(_large_star(now)))
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
