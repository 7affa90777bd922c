"""Multi-party perspective rotation of conversations, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant
and all others as users named by their role; masks mark what the assistant says (and its end mark).
System turns stay system turns and take no perspective.  A conversation is cut into blocks of turn
numbers, so that a conversation of any length is rendered by many tasks: block after block, the
renderings join to the whole, and masks count from a block's start.

Defined results: turns are ordered by turn number, then role and text (repeated rows stay, side by
side); a null turn comes first; a null role is ``unknown``; a null text is empty; ``<|`` in a text or
role is written ``<\\|`` so that it can't forge a mark; a conversation with system turns only has no
perspective and no rows; a null conv_id is one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import let, prefix_sums, q

SYSTEM, UNKNOWN = "system", "unknown"
BLOCK_TURNS = 64
START, END = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def segment(turn: Column, perspective: Column) -> Column:
    """One turn as ``struct<head, body, own>``: its opening, what may be masked in, and whether it is."""
    role = turn["role"]
    own = role == perspective
    name = F.when(own, F.lit("assistant")).when(role == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), _escaped(role)))
    return F.struct(F.concat(F.lit(START), name, F.lit("\n")).alias("head"), F.concat(_escaped(turn["text"]), F.lit(END)).alias("body"), own.alias("own"))


def rotate(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Rows conv_id, perspective, block, n_turns, rendered, mask (``start:end`` of code points, comma-joined) and
    n_masked (code points)."""
    rows = turns.select(F.col(q(conv_id)).alias("conv_id"), F.col(q(turn)).alias("turn"),
                        F.coalesce(F.col(q(role)), F.lit(UNKNOWN)).alias("role"), F.coalesce(F.col(q(text)), F.lit("")).alias("text"))
    # a block holds a bounded range of turn numbers; a null turn stands in the first
    block = F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(0)).cast("bigint")
    blocks = rows.groupBy("conv_id", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("placed"), "turn", "role", "text"))).alias("turns"))
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    # a null conv_id is a value like any other
    pairs = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    segments = pairs.select("conv_id", "perspective", "block", F.transform("turns", lambda t: segment(t, F.col("perspective"))).alias("segments"))

    def masks(s: Column) -> Column:
        # a segment is its head, its body and a line feed
        lengths = F.transform(s, lambda x: F.length(x["head"]) + F.length(x["body"]) + 1)
        starts = let(prefix_sums(lengths), lambda at: F.transform(s, lambda x, i: F.struct(
            x["own"].alias("own"), (F.get(at, i) + F.length(x["head"])).alias("start"), F.length(x["body"]).cast("bigint").alias("n"))))
        return F.filter(starts, lambda x: x["own"])

    shown = segments.select("conv_id", "perspective", "block", F.size("segments").cast("bigint").alias("n_turns"),
                            F.array_join(F.transform("segments", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("rendered"),
                            let(F.col("segments"), masks).alias("masks"))
    return shown.select("conv_id", "perspective", "block", "n_turns", "rendered",
                        F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), (m["start"] + m["n"]).cast("string"))), ",").alias("mask"),
                        F.aggregate("masks", F.lit(0).cast("bigint"), lambda a, m: a + m["n"]).alias("n_masked"))


ROTATE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '<\\|') AS body,
         coalesce(floor(turn / 64.0)::BIGINT, 0) AS block, coalesce(text, '') AS raw
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM rows WHERE role <> 'system'),
segments AS (
  SELECT r.conv_id, s.perspective, r.block, r.turn, r.role, r.raw, r.role = s.perspective AS own,
         '<|im_start|>' || CASE WHEN r.role = s.perspective THEN 'assistant' WHEN r.role = 'system' THEN 'system'
                                ELSE 'user name=' || replace(r.role, '<|', '<\\|') END || chr(10) AS head,
         r.body || '<|im_end|>' AS body
  FROM rows r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER w, 0) + length(head) AS pos,
         row_number() OVER (PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, role, raw) AS k
  FROM segments
  WINDOW w AS (PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, role, raw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, perspective, block, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY k) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN (pos::BIGINT)::VARCHAR || ':' || (pos::BIGINT + length(body))::VARCHAR END, ',' ORDER BY k), '') AS mask,
       coalesce(sum(CASE WHEN own THEN length(body) END), 0)::BIGINT AS n_masked
FROM placed GROUP BY conv_id, perspective, block
"""
