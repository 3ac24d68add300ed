"""Feature lookups on keys and on keys plus time, training sets and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

ROWS_PER_TASK = 5_000_000


@dataclass(frozen=True)
class FeatureLookup:
    """Columns to fetch from a feature table by key and, if given, by time.

    ``lookup_key`` and ``timestamp_lookup_key`` name columns of the label rows; ``table_keys`` and
    ``table_timestamp`` name those of the table where they differ.
    """

    table_name: str
    lookup_key: Sequence[str] | str
    feature_names: Sequence[str] | None = None
    timestamp_lookup_key: str | None = None
    table_keys: Sequence[str] | None = None
    table_timestamp: str | None = None

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)


def _micros(df: DataFrame, name: str) -> Column:
    """Time as an orderable long; integer columns are taken as they are."""
    kind = dict(df.dtypes)[name]
    if kind in ("bigint", "int"):
        return F.col(name).cast("long")
    return F.unix_micros(F.col(name).cast("timestamp"))


def _all_known(names: Sequence[str]) -> Column:
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull()
    return known


def key_lookup(labels: DataFrame, features: DataFrame, keys: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """Fetch ``names`` by key; label rows without a match stay, with nulls.

    ``keys`` maps label column to table column. A key that the table holds twice stops the job; the check rides on the
    shuffle that the join needs. A key that fills much of the label side is split by Spark's own skew-join
    handling, the table side having one row per key.
    """
    _no_clash(labels, names)
    key_names = [f"_k_{i}" for i in range(len(keys))]
    right = features.select(*[F.col(t).alias(a) for a, t in zip(key_names, keys.values())], F.struct(*[F.col(n) for n in names]).alias("_row"))
    right = right.filter(_all_known(key_names)).groupBy(*key_names).agg(F.count("*").alias("_n"), F.first("_row").alias("_row"))
    message = F.concat(F.lit("lookup table has several rows for key "), F.to_json(F.struct(*key_names)))
    right = right.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    right = right.select(*key_names, *[F.col("_row").getField(n).alias(n) for n in names])
    on = [F.col(k) == F.col(f"_k_{i}") for i, k in enumerate(keys)]
    return labels.join(right, on, "left").select(*labels.columns, *names)


def tile_width(*sides: tuple[DataFrame, Sequence[str], str], rows_per_task: int = ROWS_PER_TASK) -> int | None:
    """Time span that keeps one key's rows inside one task, or None if every key already fits.

    ``sides`` are (frame, keys, time column). Small inputs are settled by their row counts alone;
    otherwise rows per key are counted with map-side combine. One row reaches the driver.
    """
    if sum(df.count() for df, _, _ in sides) <= rows_per_task:
        return None
    parts = [
        df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], _micros(df, ts).alias("t"))
        for df, keys, ts in sides
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    names = [c for c in rows.columns if c != "t"]
    per_key = rows.filter(_all_known(rows.columns)).groupBy(*names).agg(
        F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")
    )
    top = per_key.agg(F.max_by(F.struct("n", "lo", "hi"), "n").alias("top")).first()["top"]
    if top is None or top["n"] <= rows_per_task:
        return None
    return max(1, (top["hi"] - top["lo"] + 1) * rows_per_task // top["n"])


def tile_edges(*sides: tuple[DataFrame, Sequence[str], str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """(keys..., edges) for every key with more rows than a task should have, or None if there is none.

    ``sides`` are (frame, keys, time column). The edges are quantiles of the key's own times, so bursts are cut as finely as
    their rows ask for, up to single times. Small inputs are settled by their row counts alone. The table is written, as
    it has few rows and both sides of a lookup read it; one number reaches the driver.
    """
    if sum(df.count() for df, _, _ in sides) <= rows_per_task:
        return None
    names = [f"k{i}" for i in range(len(sides[0][1]))]
    rows = None
    for df, keys, ts in sides:
        part = df.select(*[F.col(k).alias(n) for n, k in zip(names, keys)], _micros(df, ts).alias("t")).filter(_all_known([*names, "t"]))
        rows = part if rows is None else rows.unionByName(part)
    large = rows.groupBy(*names).agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_task)
    most = large.agg(F.max("n").alias("n")).first()["n"]
    if most is None:
        return None
    parts = -(-most // rows_per_task)
    probs = [i / parts for i in range(1, parts)]
    found = rows.join(large.select(*names), names, "left_semi").groupBy(*names).agg(F.percentile_approx("t", probs, 50 * parts).alias("edges"))
    path = scratch_path(rows.sparkSession, "edges")
    found.select(*names, F.array_distinct("edges").alias("edges")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def point_in_time(
    labels: DataFrame,
    features: DataFrame,
    keys: Mapping[str, str],
    label_ts: str,
    feature_ts: str,
    names: Sequence[str],
    width: int | None = None,
    edges: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Give each label row the newest feature row of its key that is not later than the label.

    Both sides go through one shuffle and one sort. The whole feature row travels as a struct, so
    a null feature stays null instead of showing an older value. Label rows without key, time or
    earlier feature keep nulls. ``edges`` (see ``tile_edges``), or one ``width`` for all, cut the history of a key
    into time tiles; each tile that holds labels then starts with the newest feature row before it. Two feature rows
    of one key and time stop the job. ``buckets`` says that ``features`` lie in so many buckets by their keys, of the label
    keys' types: only label rows move then. It goes with neither ``edges`` nor ``width``.
    """
    _no_clash(labels, names)
    if buckets and (width or edges is not None):
        raise ValueError("tiles of time do not follow buckets")
    key_names = [f"_k{i}" for i in range(len(keys))]
    payload = F.struct(*[F.col(n).alias(n) for n in names])
    left = labels.select(
        *[F.col(k).alias(a) for a, k in zip(key_names, keys, strict=True)],
        _micros(labels, label_ts).alias("_t"),
        F.struct(*[F.col(c) for c in labels.columns]).alias("_row"),
    )
    right = features.select(
        *[F.col(k).alias(a) for a, k in zip(key_names, keys.values(), strict=True)],
        _micros(features, feature_ts).alias("_t"),
        payload.alias("_found"),
    ).filter(_all_known([*key_names, "_t"]))
    known = _all_known([*key_names, "_t"])
    tile = F.floor(F.col("_t") / F.lit(width)) if width else F.lit(0).cast("long")
    if edges is not None:
        # few keys have edges: as many as tasks' worth of rows at most
        cuts = edges.select(*[F.col(c).alias(f"_e{i}") for i, c in enumerate(edges.columns[:-1])], F.col(edges.columns[-1]).alias("_cuts"))
        on = [F.col(a) == F.col(f"_e{i}") for i, a in enumerate(key_names)]
        left, right = (side.join(cuts, on, "left").drop(*cuts.columns[:-1]) for side in (left, right))
        tile = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_t"))), F.lit(0)).cast("long")
        tile = F.when(F.col("_cuts").isNull(), F.lit(0).cast("long")).otherwise(tile)
    # Rows that can match nothing need no company: spread them instead of piling up on null.
    tile_or_spread = F.when(known, tile).otherwise(F.pmod(F.xxhash64("_row"), F.lit(4096)))
    left = left.withColumn("_tile", tile_or_spread)
    right = right.withColumn("_tile", tile)
    alone = None
    if buckets:
        alone = left.filter(~known)  # these stay where they are
        left = left.filter(known).repartition(buckets, *key_names)
    seen = right
    if width or edges is not None:
        seen = right.select(*key_names, "_tile", "_t", "_found").unionByName(_carried(left.filter(known), right, key_names))
    none = F.lit(None)
    both = left.select(*key_names, "_tile", "_t", F.lit(1).alias("_side"), "_row").unionByName(
        seen.select(*key_names, "_tile", "_t", F.lit(0).alias("_side"), "_found"), allowMissingColumns=True
    )
    history = (
        Window.partitionBy(*key_names, "_tile")
        .orderBy("_t", "_side", "_found")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    above = Window.partitionBy(*key_names, "_tile").orderBy("_t", "_side", "_found")
    twice = (F.col("_side") == 0) & (F.lag("_side").over(above) == 0) & (F.lag("_t").over(above) == F.col("_t"))
    message = F.concat(F.lit("feature table has several rows for one time of key "), F.to_json(F.struct(*key_names)))
    matched = both.select(
        "_side",
        "_row",
        F.when(known, F.last("_found", ignorenulls=True).over(history)).alias("_found"),
        F.when(twice, message).alias("_error"),
    ).filter(F.when(F.col("_error").isNotNull(), F.raise_error(F.col("_error")).cast("boolean")).otherwise(F.col("_side") == 1))
    if alone is not None:
        matched = matched.select("_row", "_found").unionByName(alone.select("_row"), allowMissingColumns=True)
    return matched.select("_row.*", *[F.col("_found").getField(n).alias(n) for n in names])


def _carried(left: DataFrame, right: DataFrame, key_names: list[str]) -> DataFrame:
    """For every key and tile with labels, the newest feature row of the tiles before it.

    Works on one row per key and tile, not on the rows themselves.
    """
    newest = right.groupBy(*key_names, "_tile").agg(
        F.max(F.struct("_t", "_found")).alias("_best")
    )
    wanted = left.select(*key_names, "_tile").distinct().withColumn("_wanted", F.lit(True))
    tiles = newest.unionByName(wanted, allowMissingColumns=True).groupBy(*key_names, "_tile").agg(
        F.first("_best", ignorenulls=True).alias("_best"),
        F.max("_wanted").alias("_wanted"),
    )
    before = Window.partitionBy(*key_names).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tiles.withColumn("_old", F.last("_best", ignorenulls=True).over(before))
        .filter(F.col("_wanted") & F.col("_old").isNotNull())
        .select(*key_names, "_tile", F.col("_old._t").alias("_t"), F.col("_old._found").alias("_found"))
    )


def _no_clash(labels: DataFrame, names: Sequence[str]) -> None:
    twice = sorted(set(labels.columns) & set(names))
    if twice:
        raise ValueError(f"feature names already present among the label columns: {twice}")


@dataclass(frozen=True)
class TrainingSet:
    """Label rows plus the lookups that widen them; nothing runs before ``load_df``."""

    labels: DataFrame
    lookups: tuple[FeatureLookup, ...]
    label: str | None
    exclude_columns: tuple[str, ...]
    read: Callable[[FeatureLookup], tuple[DataFrame, list[str], str | None]]
    widths: Mapping[str, int | None] | None = None

    def load_df(self) -> DataFrame:
        df = self.labels
        for spec in self.lookups:
            table, table_keys, table_ts = self.read(spec)
            keys = dict(zip(spec.keys, spec.table_keys or table_keys, strict=True))
            names = spec.feature_names
            if names is None:
                names = [c for c in table.columns if c not in set(table_keys) and c != table_ts]
            if spec.timestamp_lookup_key is None:
                df = key_lookup(df, table, keys, list(names))
                continue
            ts = spec.table_timestamp or table_ts
            width, edges = None, None
            if self.widths is not None and spec.table_name in self.widths:
                width = self.widths[spec.table_name]
            else:
                # Lookups add columns only, so the label rows themselves tell the sizes.
                edges = tile_edges(
                    (self.labels, list(keys), spec.timestamp_lookup_key), (table, list(keys.values()), ts)
                )
            df = point_in_time(df, table, keys, spec.timestamp_lookup_key, ts, list(names), width, edges)
        if self.label is not None and self.label not in df.columns:
            raise ValueError(f"label column {self.label!r} not found")
        return df.drop(*[c for c in self.exclude_columns if c != self.label])


def create_training_set(
    labels: DataFrame,
    lookups: Sequence[FeatureLookup],
    tables: Mapping[str, tuple[DataFrame, Sequence[str], str | None]],
    label: str | None = None,
    exclude_columns: Sequence[str] = (),
    widths: Mapping[str, int | None] | None = None,
) -> TrainingSet:
    """Training set over feature frames given by name as (frame, keys, time column)."""

    def read(spec: FeatureLookup):
        table, keys, ts = tables[spec.table_name]
        return table, list(keys), ts

    return TrainingSet(labels, tuple(lookups), label, tuple(exclude_columns), read, widths)


def score_batch(
    training_set: TrainingSet, model: Callable[[DataFrame], Column], result_type: str = "double"
) -> DataFrame:
    """Repeat the lookups for the given keys and add the model's prediction; features stay in the output."""
    rows = training_set.load_df()
    return rows.withColumn("prediction", model(rows).cast(result_type))
