"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    """Size and order-free sum of an edge set: equal marks, equal sets but for 64-bit chance."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) of longs; root is the smallest node of its component.

    A large star hangs each node's larger neighbours on the smallest node nearby, a small star does the same for
    the smaller ones; rounds grow with the logarithm of the longest path. Minima combine before they move, and the
    joins that follow can be split where one node has very many neighbours. Edges with a null end are left out;
    no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.filter("a > b").distinct(), "edges")
    before, mark = None, _mark(edges)
    while mark[0] and mark != before:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), "edges")
        before, mark = mark, _mark(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
