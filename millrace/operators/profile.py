"""Column profiles by time window and slice, custom metrics, and profiles over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.running import TILE, pick_quantiles, running_totals, split_points, with_tile
from millrace.session import parallelism

TABLE = ":table"
SLICE = ["slice_key", "slice_value"]
WINDOW = ["granularity", "window_start"]

# Seconds per unit; weeks start on Monday, four days after the epoch's Thursday.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
MONDAY = 4 * 86_400

COLUMNS_PER_PASS = 50


@dataclass(frozen=True)
class Metric:
    """A user-defined metric: ``aggregate`` over rows, ``derived`` from metrics, or ``drift`` between profiles.

    ``{{column_name}}`` stands for the input column in aggregates, ``{{current_df}}`` and
    ``{{base_df}}`` for the two profiles in drift definitions.
    """

    metric_type: str
    metric_name: str
    input_columns: tuple[str, ...]
    metric_definition: str
    output_type: T.DataType = T.DoubleType()


@dataclass(frozen=True)
class Monitor:
    """What to profile, how to cut it, and what to compare it with.

    Exact medians and distinct counts move every value once per window and slice. Without ``exact`` both come from
    sketches, and no value moves.
    """

    table_name: str
    columns: tuple[str, ...] | None = None
    timestamp_col: str | None = None
    granularities: tuple[str, ...] = ()
    slicing_exprs: tuple[str, ...] = ()
    custom_metrics: tuple[Metric, ...] = ()
    baseline_table: str | None = None
    skip_analysis: bool = False
    exact: bool = True

    def update(self, **changes) -> Monitor:
        """The same monitor with the named settings changed."""
        return replace(self, **changes)


def slice_tags(exprs: Sequence[str]) -> Column:
    """All slices a row belongs to: the whole table, and one value per expression.

    A null slice value is a slice of its own; the whole table has a null slice key.
    """
    tag = lambda k, v: F.struct(k.cast("string").alias("slice_key"), v.cast("string").alias("slice_value"))
    none = F.lit(None)
    return F.array(tag(none, none), *[tag(F.lit(e), F.expr(e)) for e in exprs])


def window_start(ts: Column, granularity: str) -> Column:
    """Start of the window that holds ``ts``: ``n unit`` with units from second to year."""
    number, unit = granularity.split()
    n, unit = int(number), unit.rstrip("s")
    if unit in ("month", "year"):
        months = n * (12 if unit == "year" else 1)
        at = (F.year(ts) * 12 + F.month(ts) - 1).cast("int")
        first = at - F.pmod(at, F.lit(months))
        return F.make_date((first / 12).cast("int"), (F.pmod(first, F.lit(12)) + 1).cast("int"), F.lit(1)).cast(
            "timestamp_ntz"
        )
    width = n * UNIT_SECONDS[unit]
    origin = MONDAY if unit == "week" else 0
    seconds = F.unix_seconds(ts.cast("timestamp"))
    start = F.floor((seconds - origin) / width) * width + origin
    return F.timestamp_seconds(start).cast("timestamp_ntz")


def window_tags(ts: str, granularities: Sequence[str]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(g).alias("granularity"), window_start(F.col(ts), g).alias("window_start"))
            for g in granularities
        ]
    )


def _tagged(df: DataFrame, monitor: Monitor) -> tuple[DataFrame, list[str]]:
    """Rows repeated per window and slice they belong to, in one scan."""
    by = list(SLICE)
    if monitor.timestamp_col:
        tags = window_tags(monitor.timestamp_col, monitor.granularities)
        df = df.select("*", F.inline(tags))
        by = WINDOW + SLICE
    return df.select("*", F.inline(slice_tags(monitor.slicing_exprs))), by


def _is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


#: Wide enough for longs and for decimals of 28 digits and 10 places.
FINE = T.DecimalType(38, 10)


def _is_fine(dtype: T.DataType) -> bool:
    """Whether doubles may not tell two values apart."""
    if isinstance(dtype, T.DecimalType):
        return dtype.scale <= FINE.scale and dtype.precision - dtype.scale <= FINE.precision - FINE.scale
    return isinstance(dtype, T.LongType)


def _digits(value: Column) -> Column:
    """A decimal as text without trailing zeros."""
    return F.regexp_replace(value.cast("string"), r"\.0*$|(\.\d*[1-9])0+$", "$1")


def profile(df: DataFrame, monitor: Monitor) -> DataFrame:
    """One row per window, slice and column, plus the row count under ``:table``.

    Equal values are counted first, with map-side combine; counts, distinct counts, extremes, mean
    and exact median then all come from the counted values, so no slice has to fit in one task.

    Values are told apart as they are; ``min``, ``max``, ``avg`` and ``median`` are doubles. For long and decimal columns
    ``min_digits`` and ``max_digits`` hold the extremes in full.
    """
    if not monitor.exact:
        return profile_approx(df, monitor)
    skip = {monitor.timestamp_col}
    columns = list(monitor.columns or [c for c in df.columns if c not in skip])
    if len(columns) > COLUMNS_PER_PASS:
        return _profile_in_passes(df, monitor, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if _is_numeric(types[c])]
    wide = df
    cuts = split_points(df, numeric) if numeric else {}
    for c in numeric:
        wide = with_tile(wide.withColumn(f"_num_{c}", F.col(c).cast("double")), f"_num_{c}", cuts[c], f"_tile_{c}")
    tagged, by = _tagged(wide, monitor)
    entry = T.StructType().add("column_name", "string").add("num", "double").add("fine", FINE).add("txt", "string").add(TILE, "double")

    def cell(name, num, fine, txt, tile):
        return F.struct(
            F.lit(name).alias("column_name"), num.cast("double").alias("num"), fine.cast(FINE).alias("fine"),
            txt.cast("string").alias("txt"), tile.cast("double").alias(TILE),
        ).cast(entry)

    none = F.lit(None)
    cells = [cell(TABLE, none, none, none, F.lit(-1.0))]
    for c in columns:
        if c in numeric:
            cells.append(cell(c, F.col(f"_num_{c}"), F.col(c) if _is_fine(types[c]) else none, none, F.col(f"_tile_{c}")))
        else:
            text = F.col(c).cast("string")
            spread = -1.0 - F.pmod(F.xxhash64(text), F.lit(16 * parallelism(df.sparkSession)))
            cells.append(cell(c, none, none, text, spread))
    keys = [*by, "column_name"]
    counts = (
        tagged.select(*by, F.inline(F.array(*cells)))
        .groupBy(*keys, "num", "fine", "txt", TILE)
        .agg(F.count("*").alias("_n"))
        .withColumn("_w", F.when(F.col("num").isNotNull(), F.col("_n")).otherwise(F.lit(0).cast("long")))
    )
    ranked = running_totals(counts, keys, ["num", "fine", "txt"], {"_upto": "_w"})
    present = F.col("num").isNotNull() | F.col("txt").isNotNull()
    at = (F.col("_upto_total") - 1) * F.lit(0.5)

    def at_rank(rank):
        here = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_w") <= rank)
        return F.max(F.when(here, F.col("num")))

    stats = ranked.groupBy(*keys).agg(
        F.sum("_n").alias("count"),
        F.coalesce(F.sum(F.when(~present, F.col("_n"))), F.lit(0).cast("long")).alias("num_nulls"),
        F.count(F.when(present, 1)).alias("distinct_count"),
        F.min("num").alias("min"),
        F.max("num").alias("max"),
        (F.sum(F.col("num") * F.col("_n")) / F.nullif(F.sum("_w"), F.lit(0))).alias("avg"),
        ((at_rank(F.floor(at)) + at_rank(F.ceil(at))) / 2).alias("median"),
        F.min("txt").alias("min_text"),
        F.max("txt").alias("max_text"),
        _digits(F.min("fine")).alias("min_digits"),
        _digits(F.max("fine")).alias("max_digits"),
    )
    names = F.create_map(
        *[x for c in columns for x in (F.lit(c), F.lit(types[c].simpleString()))], F.lit(TABLE), F.lit("table")
    )
    out = stats.withColumns(
        {
            "data_type": F.element_at(names, F.col("column_name")),
            "percent_distinct": F.when(F.col("column_name") != TABLE, F.col("distinct_count") * 100.0 / F.col("count")),
            "num_nulls": F.when(F.col("column_name") != TABLE, F.col("num_nulls")),
            "distinct_count": F.when(F.col("column_name") != TABLE, F.col("distinct_count")),
        }
    )
    return add_metrics(out, tagged, monitor, by)


def _profile_in_passes(df: DataFrame, monitor: Monitor, columns: list[str]) -> DataFrame:
    """Wide tables a few dozen columns at a time: each pass reads its own columns and compiles to small code."""
    out = None
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[at : at + COLUMNS_PER_PASS]
        metrics = tuple(
            replace(m, input_columns=tuple(c for c in m.input_columns if c in part)) for m in monitor.custom_metrics
        )
        rows = profile(df, monitor.update(columns=tuple(part), custom_metrics=metrics))
        if out is None:
            out = rows
        else:
            out = out.unionByName(rows.filter(F.col("column_name") != TABLE), allowMissingColumns=True)
    return out


def add_metrics(profiled: DataFrame, tagged: DataFrame, monitor: Monitor, by: Sequence[str]) -> DataFrame:
    """Custom aggregates by one wide aggregate per 50 expressions, then the derived metrics in order."""
    wanted = [(m, c) for m in monitor.custom_metrics if m.metric_type == "aggregate" for c in m.input_columns]
    out = profiled
    for batch in range(0, len(wanted), 50):
        out = _join_metrics(out, tagged, wanted[batch : batch + 50], by)
    for m in monitor.custom_metrics:
        if m.metric_type == "derived" and m.input_columns:
            value = F.expr(m.metric_definition).cast(m.output_type)
            out = out.withColumn(m.metric_name, F.when(F.col("column_name").isin(*m.input_columns), value))
    return out


def _join_metrics(profiled, tagged, wanted, by):
    names = list(dict.fromkeys(m.metric_name for m, _ in wanted))
    kinds = {m.metric_name: m.output_type for m, _ in wanted}
    aggs = {
        (m.metric_name, c): F.expr(m.metric_definition.replace("{{column_name}}", c)).cast(m.output_type)
        for m, c in wanted
    }
    alias = {k: f"_m{i}" for i, k in enumerate(aggs)}
    totals = tagged.groupBy(*by).agg(*[e.alias(alias[k]) for k, e in aggs.items()])
    columns = list(dict.fromkeys(c for _, c in wanted))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                *[
                    (F.col(alias[n, c]) if (n, c) in alias else F.lit(None).cast(kinds[n])).alias(n)
                    for n in names
                ],
            )
            for c in columns
        ]
    )
    side = totals.select(*[F.col(k).alias(f"_k_{k}") for k in by], F.inline(rows)).withColumnRenamed(
        "column_name", "_k_column_name"
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*by, "column_name"]]
    new = [n for n in names if n not in profiled.columns]
    joined = profiled.join(side, on, "left")
    return joined.select(*profiled.columns, *new)


def profile_approx(df: DataFrame, monitor: Monitor) -> DataFrame:
    """The columns of ``profile`` in one aggregate that moves no values: distinct counts and medians are sketched."""
    columns = list(monitor.columns or [c for c in df.columns if c != monitor.timestamp_col])
    types = {f.name: f.dataType for f in df.schema.fields}
    tagged, by = _tagged(df, monitor)
    aggs, none = [F.count("*").alias("_rows")], F.lit(None)

    def row(name, kind, nulls, distinct, lo, hi, mean, median, first, last, least, most):
        rows = F.col("_rows")
        return F.struct(
            F.lit(name).alias("column_name"), rows.alias("count"), nulls.cast("long").alias("num_nulls"), distinct.cast("long").alias("distinct_count"),
            lo.cast("double").alias("min"), hi.cast("double").alias("max"), mean.cast("double").alias("avg"), median.cast("double").alias("median"),
            first.cast("string").alias("min_text"), last.cast("string").alias("max_text"),
            least.cast("string").alias("min_digits"), most.cast("string").alias("max_digits"), F.lit(kind).alias("data_type"),
            (distinct * 100.0 / rows).cast("double").alias("percent_distinct"),
        )

    rows = [row(TABLE, "table", *[none] * 10)]
    for i, c in enumerate(columns):
        numeric, fine = _is_numeric(types[c]), _is_fine(types[c])
        number = F.col(c).cast("double") if numeric else none.cast("double")
        text = F.col(c).cast(FINE) if fine else none.cast("string") if numeric else F.col(c).cast("string")
        aggs += [
            F.count(c).alias(f"_c{i}"),
            F.approx_count_distinct(c).alias(f"_d{i}"),
            F.min(number).alias(f"_lo{i}"),
            F.max(number).alias(f"_hi{i}"),
            F.avg(number).alias(f"_av{i}"),
            F.percentile_approx(number, 0.5).alias(f"_md{i}"),
            F.min(text).alias(f"_mi{i}"),
            F.max(text).alias(f"_ma{i}"),
        ]
        found = [F.col(f"_{n}{i}") for n in ("mi", "ma")]
        ends = [none, none, *map(_digits, found)] if fine else [*found, none, none]
        got = [F.col(f"_{n}{i}") for n in ("d", "lo", "hi", "av", "md")]
        rows.append(row(c, types[c].simpleString(), F.col("_rows") - F.col(f"_c{i}"), *got, *ends))
    out = tagged.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))
    return add_metrics(out, tagged, monitor, by)


def snapshot(df: DataFrame, monitor: Monitor, refresh_ts: str, log_type: str = "INPUT") -> DataFrame:
    """Profile of a table without time, stamped with the moment of the refresh."""
    at = F.lit(refresh_ts).cast("timestamp_ntz")
    out = profile(df, monitor.update(timestamp_col=None, granularities=()))
    return out.select(F.lit("snapshot").alias("granularity"), at.alias("window_start"), F.lit(log_type).alias("log_type"), "*")


def append_snapshot(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """Add a refresh; columns or metrics new since the last one are null in older windows."""
    return history.unionByName(fresh, allowMissingColumns=True)


def touched_windows(rows: DataFrame, monitor: Monitor) -> DataFrame:
    """Windows that new rows fall into: at most granularities times the time span, not the rows."""
    return rows.select(F.inline(window_tags(monitor.timestamp_col, monitor.granularities))).distinct()


#: Stretches of time that a refresh filters files by, at most; closer ones are read as one.
STRETCHES = 200


def _stretches(starts: Sequence, until: Sequence, most: int = STRETCHES) -> list[tuple]:
    """Windows, in order, joined where they touch, and then across the smallest gaps until few are left."""
    out: list[list] = []
    for lo, hi in sorted(zip(starts, until)):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    while len(out) > most:
        i = min(range(1, len(out)), key=lambda j: out[j][0] - out[j - 1][1])
        out[i - 1 : i + 1] = [[out[i - 1][0], out[i][1]]]
    return [tuple(x) for x in out]


def refresh(old: DataFrame, table: DataFrame, new_rows: DataFrame, monitor: Monitor) -> DataFrame:
    """Recompute only the windows that new rows touched; keep the other profile rows as they are.

    ``table`` already holds the new rows. Each granularity reads the rows of its touched windows: their stretches of
    time are a plain filter on the time column, which reaches the files. The driver receives the touched windows, of
    which there are as many as the time span holds, whatever the rows.
    """
    touched = touched_windows(new_rows, monitor)
    ts, kind = F.col(monitor.timestamp_col), table.schema[monitor.timestamp_col].dataType
    found: dict[str, list] = {}
    for r in touched.filter(F.col("window_start").isNotNull()).collect():
        found.setdefault(r["granularity"], []).append(r["window_start"])
    if not found:
        return old
    fresh = None
    for g in monitor.granularities:
        mine = touched.filter(F.col("granularity") == g).select(F.col("window_start").alias("_w"))
        starts = found.get(g, [])
        near = F.lit(False)
        for lo, hi in _stretches(starts, [_window_end(s, g) for s in starts]):
            near = near | ((ts >= F.lit(lo).cast(kind)) & (ts < F.lit(hi).cast(kind)))
        rows = table.filter(near).withColumn("_w", window_start(ts, g)).join(mine, "_w", "left_semi")
        part = profile(rows.drop("_w"), monitor.update(granularities=(g,)))
        fresh = part if fresh is None else fresh.unionByName(part)
    kept = old.join(touched, WINDOW, "left_anti").select(*old.columns)
    return kept.unionByName(fresh, allowMissingColumns=True)


def _window_end(start, granularity: str):
    """The first moment after the window that begins at ``start``."""
    number, unit = granularity.split()
    n, unit = int(number), unit.rstrip("s")
    if unit in ("month", "year"):
        months = start.year * 12 + start.month - 1 + n * (12 if unit == "year" else 1)
        return start.replace(year=months // 12, month=months % 12 + 1)
    return start + timedelta(seconds=n * UNIT_SECONDS[unit])


def run(monitor: Monitor, tables: Mapping[str, DataFrame], refresh_ts: str | None = None) -> DataFrame | None:
    """Profile the monitored table and, if set, its baseline, told apart by ``log_type``."""
    if monitor.skip_analysis:
        return None
    df = tables[monitor.table_name]
    if monitor.timestamp_col:
        out = profile(df, monitor).withColumn("log_type", F.lit("INPUT"))
    else:
        out = snapshot(df, monitor, refresh_ts)
    if monitor.baseline_table:
        base = baseline_profile(tables[monitor.baseline_table], monitor)
        out = out.unionByName(base, allowMissingColumns=True)
    return out


def baseline_profile(df: DataFrame, monitor: Monitor) -> DataFrame:
    keep = tuple(c for c in monitor.columns if c in df.columns) if monitor.columns else None
    plain = monitor.update(timestamp_col=None, granularities=(), columns=keep)
    return profile(df, plain).withColumn("log_type", F.lit("BASELINE"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    cuts = split_points(df, columns)
    wide = df
    for c in columns:
        wide = with_tile(wide.withColumn(f"_num_{c}", F.col(c).cast("double")), f"_num_{c}", cuts[c], f"_tile_{c}")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_num_{c}").alias("num"), F.col(f"_tile_{c}").alias(TILE))
            for c in columns
        ]
    )
    values = wide.select(F.inline(cells)).filter("num is not null")
    counts = values.groupBy("column_name", "num", TILE).agg(F.count("*").alias("_n"))
    ranked = running_totals(counts, ["column_name"], ["num"], {"_upto": "_n"})
    quartiles = pick_quantiles(
        ranked, ["column_name"], "num", "_n", "_upto", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    moments = values.groupBy("column_name").agg(
        F.count("*").alias("count"),
        F.avg("num").alias("mean"),
        F.stddev_samp("num").alias("std"),
        F.min("num").alias("min"),
        F.max("num").alias("max"),
    )
    return moments.join(quartiles, "column_name")
