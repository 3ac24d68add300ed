"""Gaussian anomaly scores over feature vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Sums that meet in one task, at most, on the way to the driver.
WIDTH = 32


@dataclass(frozen=True)
class Gaussian:
    """Mean and inverse covariance of normal vectors."""

    mean: np.ndarray
    precision: np.ndarray
    count: int


def fit_gaussian(df: DataFrame, vec: str, shrinkage: float = 0.01) -> Gaussian:
    """One pass: every task adds up x and x'x of its rows and sends one row; rows are added up in a tree.

    The driver gets at most ``WIDTH`` sums of 1 + d + d x d numbers, whatever the rows. ``shrinkage`` is added to the
    diagonal, which keeps few vectors in many dimensions invertible.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss = 0, None, None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(np.float64)
            if s is None:
                s, ss = np.zeros(x.shape[1]), np.zeros((x.shape[1], x.shape[1]))
            n, s, ss = n + len(x), s + x.sum(axis=0), ss + x.T @ x
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "sums": [np.concatenate([[float(n)], s, ss.ravel()]).tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].head(1), "sums": [sum(np.frombuffer(b) for b in pdf["sums"]).tobytes()]})

    schema = "part long, sums binary"
    rows = df.select(vec).filter(F.col(vec).isNotNull()).mapInPandas(partial, schema)
    for width in (WIDTH * WIDTH, WIDTH):
        rows = rows.withColumn("part", F.pmod("part", F.lit(width))).groupBy("part").applyInPandas(added, schema)
    found = [np.frombuffer(r["sums"]) for r in rows.collect()]
    if not found:
        raise ValueError("no vectors to fit")
    flat = sum(found)
    n = int(flat[0])
    d = int((-1 + (1 + 4 * (len(flat) - 1)) ** 0.5) / 2 + 0.5)
    mean = flat[1 : 1 + d] / n
    covariance = flat[1 + d :].reshape(d, d) / n - np.outer(mean, mean)
    return Gaussian(mean, np.linalg.inv(covariance + shrinkage * np.eye(d)), n)


def mahalanobis(model: Gaussian, vec: Column) -> Column:
    """Distance of each vector from the fitted mean in units of the fitted covariance."""
    mean, precision = model.mean, model.precision

    @F.pandas_udf("double")
    def distance(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype="float64")
        x = np.stack(vectors.to_numpy()).astype(np.float64) - mean
        return pd.Series(np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", x, precision, x, optimize=True), 0.0)))

    return distance(vec)


def fit_diagonal(df: DataFrame, vec: str) -> tuple[list[float], list[float]]:
    """Mean and population variance per dimension; two numbers per dimension reach the driver."""
    cells = df.select(F.posexplode(F.col(vec)).alias("i", "x"))
    rows = (
        cells.groupBy("i")
        .agg(F.avg(F.col("x").cast("double")).alias("m"), F.var_pop(F.col("x").cast("double")).alias("v"))
        .orderBy("i")
        .collect()
    )
    return [r["m"] for r in rows], [r["v"] for r in rows]


def diagonal_distance(vec: Column, mean: list[float], variance: list[float], shrinkage: float = 0.01) -> Column:
    """Distance with the dimensions taken as independent; a plain column expression."""
    means = F.array(*[F.lit(m) for m in mean])
    scales = F.array(*[F.lit(v + shrinkage) for v in variance])
    diff = F.zip_with(vec, means, lambda x, m: x.cast("double") - m)
    parts = F.zip_with(diff, scales, lambda d, s: d * d / s)
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p))
