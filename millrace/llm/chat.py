"""Chat formatting: keep only conversations that no longer one begins with, then render them.

Logs often hold a conversation again and again as it grows. A rolling hash of the turns names every prefix; a
conversation whose whole hash is a proper prefix of another goes, and of equal ones the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import TILE, running_totals

#: Turn numbers of a tile: a longer conversation is numbered and hashed by several tasks.
TURNS = 4096


def _tiled(turns: DataFrame) -> DataFrame:
    return turns.withColumn(TILE, F.coalesce(F.floor(F.col("turn").cast("double") / TURNS), F.lit(-(2**62)).cast("long")))


def prefixes(turns: DataFrame) -> DataFrame:
    """Distinct turns with position (from 1), n_turns, prefix (two sums that name the turns so far) and whole.

    Turns stand in order of turn, role and text. The sums run over hashes of position, role and text, so they
    are totalled by tiles and combine before they move. Equal rows count once; rows without conv_id are left out.
    """
    order = ["turn", "role", "text"]
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", *order).distinct()
    placed = running_totals(_tiled(rows), ["conv_id"], order, {"position": F.lit(1)})

    def mark(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), F.col("position"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")).cast("decimal(38,0)")

    summed = running_totals(placed, ["conv_id"], order, {"one": mark(1), "two": mark(2)})
    return summed.select(
        "conv_id", *order, "position", F.col("position_total").alias("n_turns"),
        F.struct("position", "one", "two").alias("prefix"),
        F.struct(F.col("position_total").alias("position"), F.col("one_total").alias("one"), F.col("two_total").alias("two")).alias("whole"),
    )


def maximal(marked: DataFrame) -> DataFrame:
    """conv_id of the conversations that stay, from ``prefixes``.

    Equal conversations and equal prefixes combine before they move, so a first turn that all share is one row a task.
    """
    last = marked.filter("position = n_turns")
    alone = last.groupBy("whole").agg(F.min("conv_id").alias("conv_id"))
    begun = marked.filter("position < n_turns").select(F.col("prefix").alias("whole")).distinct()
    return alone.join(begun, "whole", "left_anti").select("conv_id")


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, piece, start) for every turn of the conversations that stay.

    The pieces of a conversation in order of position are its text; ``start`` is where each begins in it. A missing
    role or text is empty. A conversation is never gathered in one row, as one may be of any length.
    """
    marked = prefixes(turns)
    kept = marked.join(maximal(marked), "conv_id", "left_semi")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    piece = F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))
    rows = _tiled(kept.select("conv_id", "turn", "text", "position", "role", piece.alias("piece")))
    summed = running_totals(rows, ["conv_id"], ["turn", "position"], {"stop": F.length("piece").cast("long")})
    return summed.select("conv_id", F.col("position").cast("long").alias("position"), "role", "piece", (F.col("stop") - F.length("piece")).alias("start"))


#: The query over ``conversations`` in another engine.
SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position
  FROM t),
c AS (
  SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY position) AS turns FROM p GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, n, turns FROM c GROUP BY n, turns),
m AS (
  SELECT conv_id FROM u a
  WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.n > a.n AND b.turns[1] = a.turns[1] AND b.turns[1:a.n] = a.turns)),
r AS (
  SELECT conv_id, position, role, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS piece
  FROM p WHERE conv_id IN (SELECT conv_id FROM m))
SELECT conv_id, position, role, piece,
       coalesce(sum(length(piece)) OVER (
         PARTITION BY conv_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
FROM r"""
