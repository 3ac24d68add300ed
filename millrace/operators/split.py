"""Splits and samples that depend on row keys only, not on partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import DRAW_BITS, drawn
from millrace.operators.running import hash_rank


def time_split(df: DataFrame, ts: str, t0: str, name: str = "split") -> DataFrame:
    """``train`` before t0, ``test`` from t0 on."""
    return df.withColumn(name, F.when(F.col(ts) < F.lit(t0).cast("timestamp_ntz"), "train").otherwise("test"))


def hash_split(df: DataFrame, key: Sequence[str], weights: Mapping[str, float], seed: int, name: str = "split"):
    """Assign each row to a named part with the given weights, by a number drawn from its key."""
    total, names, upto = sum(weights.values()), list(weights), 0.0
    number = drawn(seed, *key)
    part: Column = F.lit(names[-1])
    edges = []
    for n in names[:-1]:
        upto += weights[n] / total
        edges.append((n, round(upto * 2**DRAW_BITS)))
    for n, edge in reversed(edges):
        part = F.when(number < F.lit(edge), n).otherwise(part)
    return df.withColumn(name, part)


def stratified_split(df: DataFrame, label: str, key: str, held_out: float, seed: int, name: str = "split"):
    """Hold out ceil(f * n) rows of every label value, those with the smallest drawn numbers."""
    ranked = hash_rank(df, [label], drawn(seed, key), F.col(key), "_rank", DRAW_BITS)
    out = F.when(F.col("_rank") <= F.ceil(F.col("_rank_total") * F.lit(held_out)), "test").otherwise("train")
    return ranked.withColumn(name, out).drop("_rank", "_rank_total")


def sample_fixed(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The n rows with the smallest drawn numbers: the same rows on every run and layout."""
    return df.orderBy(drawn(seed, key), F.col(key)).limit(n)


def sample_fraction(df: DataFrame, key: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """About this share of the rows, by a number drawn from the key: the same rows on every layout."""
    return df.filter(drawn(seed, *key) < F.lit(round(fraction * 2**DRAW_BITS)))
