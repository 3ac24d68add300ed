"""Counts, cross-tabs, parameterised SQL and the gold table of user activity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import days_since


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls included, rarest first."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy("count", column)


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Rows per pair of values: one row per pair, however many there are.

    With ``values`` of ``col`` named by the caller, one row per ``row`` value and a column for each of them.
    """
    if values is None:
        return df.groupBy(row, col).agg(F.count("*").alias("count"))
    counts = [F.count(F.when(F.col(col).cast("string") == F.lit(str(v)), 1)).alias(str(v)) for v in values]
    return df.groupBy(row).agg(*counts)


def sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame], args: Mapping[str, object]) -> DataFrame:
    """Run SQL that names frames as ``{name}`` and values as ``:name``."""
    return spark.sql(text, args=dict(args), **frames)


def order_stats(orders: DataFrame, user: str, amount: Column, items: Column, at: str) -> DataFrame:
    return orders.groupBy(F.col(user).alias("user_id")).agg(
        F.count("*").alias("order_count"),
        F.sum(amount).alias("total_amount"),
        F.sum(items).alias("total_item"),
        F.max(at).alias("last_transaction"),
    )


def event_stats(events: DataFrame, user: str, platform: str, session: Column, at: str, key: str) -> DataFrame:
    """Activity per user; the platform is that of the earliest event."""
    return events.groupBy(F.col(user).alias("user_id")).agg(
        F.min_by(platform, F.struct(at, key)).alias("platform"),
        F.count("*").alias("event_count"),
        F.countDistinct(session).alias("session_count"),
        F.max(at).alias("last_event"),
    )


def churn_gold(users: DataFrame, orders: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """Users with their order and event statistics and the days since each kind of activity."""
    joined = users.join(orders, "user_id").join(events, "user_id")
    return joined.withColumns(
        {
            "days_since_creation": days_since(F.col("creation_date"), as_of),
            "days_since_last_activity": days_since(F.col("last_transaction"), as_of),
            "days_last_event": days_since(F.col("last_event"), as_of),
        }
    )
