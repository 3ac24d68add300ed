"""Projection, cleaning, encoding and scaling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def snake_name(name: str, fixes: Mapping[str, str] | None = None) -> str:
    """camelCase to snake_case; parentheses, blanks and dashes to underscores; then the fix-ups."""
    name = re.sub(r"[()]", " ", name)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    name = re.sub(r"[ -]", "_", name).lower()
    return (fixes or {}).get(name, name)


def normalise_columns(df: DataFrame, fixes: Mapping[str, str] | None = None) -> DataFrame:
    names = [snake_name(c, fixes) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after renaming: {twice}")
    return df.toDF(*names)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def stamp(df: DataFrame, ts: str, column: str) -> DataFrame:
    """Give all rows one load time."""
    return df.withColumn(column, F.lit(ts).cast("timestamp_ntz"))


def categories(df: DataFrame, columns: Sequence[str], limit: int = 1000) -> dict[str, list]:
    """Distinct non-null values of each column in order, all columns in one pass.

    The driver receives at most ``limit`` values per column; a wider column is an error, since it
    would become one output column per value.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    )
    distinct = df.select(pairs.alias("p")).select("p.*").filter("v is not null").distinct()
    rows = distinct.limit(limit * len(columns) + 1).collect()
    found: dict[str, list] = {c: sorted(r["v"] for r in rows if r["i"] == i) for i, c in enumerate(columns)}
    wide = [c for c, v in found.items() if len(v) > limit]
    if wide or len(rows) > limit * len(columns):
        raise ValueError(f"too many distinct values to encode (limit {limit}): {wide or list(columns)}")
    return found


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    values: Mapping[str, Sequence] | None = None,
    drop_first: bool = False,
    limit: int = 1000,
) -> DataFrame:
    """One 0/1 column per value, in place of each column. Null and unseen values give all zeros.

    Values not named by the caller are looked up; more than ``limit`` of one column are an error.
    """
    values = values or categories(df, columns, limit)
    kept = [F.col(c) for c in df.columns if c not in columns]
    coded = []
    for c in columns:
        for v in list(values[c])[1 if drop_first else 0 :]:
            hit = F.coalesce(F.col(c).cast("string") == F.lit(str(v)), F.lit(False))
            coded.append(hit.cast("long").alias(f"{c}_{v}"))
    return df.select(*kept, *coded)


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column, fitted on one frame and applied to any."""

    stats: Mapping[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Coerce to numbers, fill gaps with the mean, centre and scale."""
        out = {}
        for c, (mean, sd) in self.stats.items():
            value = F.coalesce(_number(df, c), F.lit(mean))
            out[c] = (value - F.lit(mean)) / F.lit(sd if sd else 1.0)
        return df.withColumns(out)


def _number(df: DataFrame, c: str) -> Column:
    return F.col(c).try_cast("double") if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).cast("double")


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregate over all columns; two numbers per column reach the driver."""
    aggs = []
    for c in columns:
        aggs += [F.avg(_number(df, c)).alias(f"m_{c}"), F.stddev_pop(_number(df, c)).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return Scaler({c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in columns})


@dataclass(frozen=True)
class Preprocess:
    """Fitted scaling and one-hot coding; columns named in neither pass through."""

    scaler: Scaler
    values: Mapping[str, Sequence]
    drop_first: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        return one_hot(self.scaler.transform(df), list(self.values), self.values, self.drop_first)


def fit_preprocess(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], drop_first: bool = False, limit: int = 1000
) -> Preprocess:
    values = categories(df, categorical, limit) if categorical else {}
    return Preprocess(fit_scaler(df, numeric), values, drop_first)


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected column: is it there, does its type fit, and how many values would not cast?"""
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [F.count("*").alias("_rows")], []
    for i, f in enumerate(expected.fields):
        have = actual.get(f.name)
        bad = F.lit(None).cast("long")
        if have is not None:
            lost = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            aggs.append(F.count(F.when(lost, 1)).alias(f"_bad{i}"))
            bad = F.col(f"_bad{i}")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(have.simpleString() if have else None).cast("string").alias("actual_type"),
                F.lit(have is not None).alias("present"),
                F.lit(have == f.dataType).alias("type_ok"),
                F.col("_rows").alias("n_rows"),
                bad.alias("n_bad"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def select_signature(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Just the columns a model asks for, in its order; missing ones are an error."""
    missing = [f.name for f in expected.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"model inputs missing: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in expected.fields])
