"""Chat formatting: cumulative-snapshot collapse, then rendering. DataFrame functions only.

Logs often hold a conversation once more after every turn. A rolling hash over turns
names every prefix of every conversation; one whose whole hash names a proper prefix of
a longer one is dropped by an anti-join, and of equal ones the least conv_id stays. What
is left is rendered.

The rolling hash is the XOR of two 64-bit hashes of (position, role, text) of the turns so
far. It and the positions are summed in two steps, within blocks of BLOCK turn numbers
and over blocks, so that a very long conversation is spread over tasks; its rendering
comes in segments of BLOCK turns whose texts, in order, are the whole.

Defined results: a null role is ``unknown``, a null text is empty, turns with a null number
come first, rows without a conv_id belong to no conversation. Turns with equal numbers
are ordered by role, then text; rows that repeat count once. ``<|`` in a role or text
becomes ``< |``, so that no text can close its turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text, pos, n): distinct turns with their 1-based place among the conversation's n."""
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id is not null")
    rows = rows.distinct().withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))))
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("size"))
    by_block = Window.partitionBy("conv_id").orderBy("block")
    blocks = sizes.select("conv_id", "block", (F.sum("size").over(by_block) - F.col("size")).alias("before"), F.sum("size").over(Window.partitionBy("conv_id")).alias("n"))
    place = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    return rows.withColumn("place", place).join(blocks, ["conv_id", "block"]).select("conv_id", "role", "text", (F.col("before") + F.col("place")).alias("pos"), "n")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n, h1, h2): the rolling hash after each turn."""
    own = turns.select("conv_id", "pos", "n", F.floor((F.col("pos") - 1) / BLOCK).alias("block"), F.xxhash64("pos", "role", "text").alias("a"), F.xxhash64("text", F.lit("|"), "role", "pos").alias("b"))
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "ab"])
    rolled = own.select("conv_id", "pos", "n", "block", F.bit_xor("a").over(within).alias("a1"), F.bit_xor("b").over(within).alias("b1"))
    joined = rolled.join(blocks, ["conv_id", "block"])
    return joined.select("conv_id", "pos", "n", F.col("a0").bitwiseXOR(F.col("a1")).alias("h1"), F.col("b0").bitwiseXOR(F.col("b1")).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no proper prefix of another, one of each group of equal ones."""
    hashes = prefix_hashes(turns)
    whole = hashes.where("pos = n").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    prefixes = hashes.where("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    return whole.join(prefixes, ["n", "h1", "h2"], "left_anti").select("conv_id")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, text): the turns in the im_start/im_end markup."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    piece = F.concat(F.lit("<|im_start|>"), safe(F.col("role")), F.lit("\n"), safe(F.col("text")), F.lit("<|im_end|>\n"))
    rows = turns.select("conv_id", F.floor((F.col("pos") - 1) / BLOCK).alias("segment"), F.struct("pos", piece.alias("piece")).alias("turn"))
    grouped = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", "segment", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.piece", "").alias("text"))


def formatted(conversations: DataFrame) -> DataFrame:
    turns = positions(conversations)
    return render(turns.join(maximal(turns), "conv_id", "left_semi"))


SQL = """
WITH b AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, role, text,
    row_number() OVER w AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
  FROM b
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id FROM p WHERE pos = n GROUP BY prefix
), kept AS (
  SELECT conv_id FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE pos < n)
)
SELECT conv_id, (pos - 1) // 1024 AS segment, count(*) AS n_turns,
  string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM p WHERE conv_id IN (SELECT conv_id FROM kept)
GROUP BY conv_id, segment
"""
