"""Drift between profiles and between value distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.profile import SLICE, Metric
from millrace.operators.running import TILE, running_totals, split_points, with_tile

TINY = 1e-6


def _metric_columns(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    for m in metrics:
        if m.metric_type == "drift":
            sql = m.metric_definition.replace("{{current_df}}", "cur").replace("{{base_df}}", "base")
            value = F.expr(sql).cast(m.output_type)
            df = df.withColumn(m.metric_name, F.when(F.col("column_name").isin(*m.input_columns), value))
    return df


def _drift(df: DataFrame, kind: str, by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    out = df.withColumns(
        {
            "drift_type": F.lit(kind),
            "count_delta": F.col("cur.count") - F.col("base.count"),
            "avg_delta": F.col("cur.avg") - F.col("base.avg"),
            "median_delta": F.col("cur.median") - F.col("base.median"),
            "percent_distinct_delta": F.col("cur.percent_distinct") - F.col("base.percent_distinct"),
        }
    )
    out = _metric_columns(out, metrics)
    names = [m.metric_name for m in metrics if m.metric_type == "drift"]
    return out.select(
        *by,
        "drift_type",
        "count_delta",
        "avg_delta",
        "median_delta",
        "percent_distinct_delta",
        *names,
    )


def consecutive(profiled: DataFrame, metrics: Sequence[Metric] = ()) -> DataFrame:
    """Each window against the one before it in the same series; the first window has no row.

    Runs on profile rows: a series is as long as it has windows.
    """
    series = ["granularity", *SLICE, "column_name"]
    before = Window.partitionBy(*series).orderBy("window_start")
    packed = profiled.withColumn("cur", F.struct(*[F.col(c) for c in profiled.columns]))
    paired = packed.select(
        *series, "window_start", "cur", F.lag("cur").over(before).alias("base")
    ).filter("base is not null")
    paired = paired.withColumn("window_cmp", F.col("base.window_start"))
    return _drift(paired, "CONSECUTIVE", [*series, "window_start", "window_cmp"], metrics)


def against_baseline(profiled: DataFrame, baseline: DataFrame, metrics: Sequence[Metric] = ()) -> DataFrame:
    """Each window against the baseline profile of the same slice and column."""
    keys = [*SLICE, "column_name"]
    left = profiled.withColumn("cur", F.struct(*[F.col(c) for c in profiled.columns]))
    right = baseline.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*[F.col(c) for c in baseline.columns]).alias("base")
    )
    on = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    paired = left.select("granularity", *keys, "window_start", "cur").join(right, on)
    paired = paired.withColumn("window_cmp", F.lit(None).cast("timestamp_ntz"))
    return _drift(
        paired, "BASELINE", ["granularity", *keys, "window_start", "window_cmp"], metrics
    )


def numeric_drift(current: DataFrame, base: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Mean shift, Kolmogorov-Smirnov distance and stability index over baseline quantile bins.

    All three are null where one side has no values. A value belongs to the bin given by the share
    of baseline rows below it, so ties never part.
    """
    both = current.select(*columns, F.lit(1).alias("_cur")).unionByName(base.select(*columns, F.lit(0).alias("_cur")))
    cuts = split_points(both, columns)
    wide = both
    for c in columns:
        wide = with_tile(wide.withColumn(f"_num_{c}", F.col(c).cast("double")), f"_num_{c}", cuts[c], f"_tile_{c}")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_num_{c}").alias("num"), F.col(f"_tile_{c}").alias(TILE))
            for c in columns
        ]
    )
    counts = (
        wide.select("_cur", F.inline(cells))
        .filter("num is not null")
        .groupBy("column_name", "num", TILE)
        .agg(F.sum("_cur").alias("_a"), F.sum(1 - F.col("_cur")).alias("_b"))
    )
    ranked = running_totals(counts, ["column_name"], ["num"], {"_ra": "_a", "_rb": "_b"})
    gap = F.abs(F.try_divide("_ra", "_ra_total") - F.try_divide("_rb", "_rb_total"))
    below = F.coalesce(F.try_divide(F.col("_rb") - F.col("_b"), F.col("_rb_total")), F.lit(0.0))
    bin_of = F.least(F.floor(below * bins), F.lit(bins - 1))
    per_bin = ranked.withColumn("_bin", bin_of).groupBy("column_name", "_bin").agg(
        F.max(gap).alias("_ks"),
        F.sum("_a").alias("_a"),
        F.sum("_b").alias("_b"),
        F.sum(F.col("num") * F.col("_a")).alias("_sa"),
        F.sum(F.col("num") * F.col("_b")).alias("_sb"),
        F.max("_ra_total").alias("_na"),
        F.max("_rb_total").alias("_nb"),
    )
    p = F.greatest(F.try_divide("_a", "_na"), F.lit(TINY))
    q = F.greatest(F.try_divide("_b", "_nb"), F.lit(TINY))
    both_known = (F.col("_na") > 0) & (F.col("_nb") > 0)
    return per_bin.groupBy("column_name").agg(
        (F.try_divide(F.sum("_sa"), F.sum("_a")) - F.try_divide(F.sum("_sb"), F.sum("_b"))).alias("mean_shift"),
        F.max("_ks").alias("ks_distance"),
        F.sum(F.when(both_known, (p - q) * F.log(p / q))).alias("psi"),
    )


def categorical_drift(current: DataFrame, base: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total variation, Jensen-Shannon divergence (nats) and chi-square against the baseline shares.

    Chi-square takes values the baseline knows; ``new_share`` tells how much of the rest there is.
    """
    both = current.select(*columns, F.lit(1).alias("_cur")).unionByName(base.select(*columns, F.lit(0).alias("_cur")))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("txt")) for c in columns]
    )
    counts = (
        both.select("_cur", F.inline(cells))
        .groupBy("column_name", "txt")
        .agg(F.sum("_cur").alias("_a"), F.sum(1 - F.col("_cur")).alias("_b"))
    )
    totals = counts.groupBy("column_name").agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    rows = counts.join(F.broadcast(totals), "column_name").withColumns(  # one row per column
        {"_p": F.try_divide("_a", "_na"), "_q": F.try_divide("_b", "_nb")}
    )
    p, q = F.col("_p"), F.col("_q")
    mid = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.log(F.when(x > 0, x / mid))).otherwise(0.0)

    expected = F.col("_na") * q
    chi = F.when(q > 0, F.pow(F.col("_a") - expected, 2) / F.when(q > 0, expected)).otherwise(0.0)
    return rows.groupBy("column_name").agg(
        (F.sum(F.abs(p - q)) / 2).alias("total_variation"),
        (F.sum(part(p) + part(q)) / 2).alias("jensen_shannon"),
        F.sum(chi).alias("chi_square"),
        F.sum(F.when(q == 0, p).otherwise(0.0)).alias("new_share"),
    )
