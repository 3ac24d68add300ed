"""Table changes as DataFrame functions: insert, delete, merge, key checks, newest row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; other source rows are added.

    Two source rows for one key stop the job. Null keys match nothing, so such source rows are
    added as they are. The check rides on the shuffle that the match needs anyway.
    """
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    rest = [c for c in target.columns if c not in keys]
    single = source.filter(known).groupBy(*keys).agg(
        F.count("*").alias("_n"), F.first(F.struct(*[F.col(c) for c in rest])).alias("_row")
    )
    message = F.concat(F.lit("merge source has several rows for key "), F.to_json(F.struct(*keys)))
    checked = single.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    fresh = checked.select(*keys, "_row.*").select(*target.columns)
    kept = target.join(single.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(fresh).unionByName(source.filter(~known).select(*target.columns))


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; two of one key stop the job that reads them."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*[F.col(c) for c in rest])) if rest else F.count("*")
    single = df.groupBy(*keys).agg(F.count("*").alias("_n"), row.alias("_row"))
    message = F.concat(F.lit("several rows for key "), F.to_json(F.struct(*keys)))
    checked = single.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*[F.col("_row").getField(c).alias(c) if c in rest else F.col(c) for c in df.columns])


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole newest row of each key; combines on the map side, so a busy key costs one row per task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*df.columns)
