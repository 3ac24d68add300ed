"""Queries on grouping, profiles, custom metrics and drift."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import aggregates
from millrace.operators.drift import against_baseline, categorical_drift, consecutive, numeric_drift
from millrace.operators.lattice import estimated, refreshed, states
from millrace.operators.profile import (
    Metric,
    Monitor,
    append_snapshot,
    baseline_profile,
    describe,
    profile,
    refresh,
    run,
    snapshot,
)
from millrace.operators.running import quantiles
from millrace.plans.bindings import load, rounded
from millrace.plans.registry import query
from millrace.session import scratch_path


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "value_counts",
    'SELECT c_nationkey, count(*) AS "count" FROM customer GROUP BY c_nationkey ORDER BY 2, 1',
)
def value_counts(spark, sf):
    return aggregates.value_counts(load(spark, sf, "customer"), "c_nationkey")


@query(
    "crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
              count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY o_orderpriority""",
)
def crosstab(spark, sf):
    return aggregates.crosstab(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "crosstab_long",
    """SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, o_custkey, count(*) AS "count" FROM orders GROUP BY ALL""",
)
def crosstab_long(spark, sf):
    """Pairs of two columns with far more than a thousand values each."""
    days = load(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    return aggregates.crosstab(days, "day", "o_custkey")


@query(
    "parameterised_sql",
    """SELECT c_nationkey, count(*) AS customers FROM customer WHERE c_nationkey > 2 GROUP BY ALL ORDER BY 1""",
)
def parameterised_sql(spark, sf):
    text = "SELECT c_nationkey, count(*) AS customers FROM {users} WHERE c_nationkey > :least GROUP BY ALL ORDER BY 1"
    return aggregates.sql(spark, text, {"users": load(spark, sf, "customer")}, {"least": 2})


ORDER_STATS = """
order_stats AS (SELECT o_custkey AS user_id, count(*) AS order_count, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT)
                  AS total_amount, CAST(sum(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS BIGINT) AS total_item,
                  max(o_orderdate) AS last_transaction FROM orders GROUP BY o_custkey)"""
EVENT_STATS = """
event_stats AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS platform, count(*) AS event_count,
                  count(DISTINCT props) AS session_count, max(ts) AS last_event FROM events GROUP BY user_id)"""


def _order_stats(spark, sf):
    amount, items = F.col("o_totalprice").cast("long"), F.substring("o_orderpriority", 1, 1).cast("int")
    return aggregates.order_stats(load(spark, sf, "orders"), "o_custkey", amount, items, "o_orderdate")


def _event_stats(spark, sf):
    return aggregates.event_stats(load(spark, sf, "events"), "user_id", "event_type", F.col("props"), "ts", "event_id")


@query(
    "order_stats",
    f"""WITH {ORDER_STATS} SELECT user_id, order_count, total_amount, total_item,
        CAST(CAST(last_transaction AS DATE) AS VARCHAR) AS last_transaction FROM order_stats""",
)
def order_stats(spark, sf):
    return _order_stats(spark, sf).withColumn("last_transaction", F.date_format("last_transaction", "yyyy-MM-dd"))


@query(
    "event_stats",
    f"""WITH {EVENT_STATS} SELECT user_id, platform, event_count, session_count,
        strftime(last_event, '%Y-%m-%d %H:%M:%S') AS last_event FROM event_stats""",
)
def event_stats(spark, sf):
    return _event_stats(spark, sf).withColumn("last_event", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss"))


@query(
    "churn_gold",
    f"""WITH {ORDER_STATS}, {EVENT_STATS}
    SELECT user_id, c_mktsegment, order_count, total_amount, total_item, platform, event_count, session_count,
           CAST(date_diff('day', DATE '2024-01-01' + CAST(user_id % 28 AS INTEGER), DATE '2024-03-01') AS INTEGER) AS days_since_creation,
           CAST(date_diff('day', CAST(last_transaction AS DATE), DATE '2024-03-01') AS INTEGER) AS days_since_last_activity,
           CAST(date_diff('day', CAST(last_event AS DATE), DATE '2024-03-01') AS INTEGER) AS days_last_event
    FROM customer JOIN order_stats ON c_custkey = user_id JOIN event_stats USING (user_id)""",
)
def churn_gold(spark, sf):
    users = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        "c_mktsegment",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("c_custkey", F.lit(28)).cast("int")).alias("creation_date"),
    )
    out = aggregates.churn_gold(users, _order_stats(spark, sf), _event_stats(spark, sf), "2024-03-01")
    return out.drop("creation_date", "last_transaction", "last_event")


def long_sql(source: str, numeric: dict[str, str], text: dict[str, str], prefix: str = "") -> str:
    """SQL for one row per source row and column, numbers and text apart; ``prefix`` names leading columns."""
    parts = [f"SELECT {prefix} ':table' AS column_name, NULL::DOUBLE AS num, NULL::VARCHAR AS txt FROM {source}"]
    parts += [f"SELECT {prefix} '{c}', CAST({e} AS DOUBLE), NULL FROM {source}" for c, e in numeric.items()]
    parts += [f"SELECT {prefix} '{c}', NULL, {e} FROM {source}" for c, e in text.items()]
    return " UNION ALL ".join(parts)


def stats_sql(long: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}column_name, count(*) AS count,
       CASE WHEN column_name <> ':table' THEN count(*) - count(num) - count(txt) END AS num_nulls,
       CASE WHEN column_name <> ':table' THEN count(DISTINCT num) + count(DISTINCT txt) END AS distinct_count,
       CASE WHEN column_name <> ':table' THEN round((count(DISTINCT num) + count(DISTINCT txt)) * 100.0 / count(*), 6)
         END AS percent_distinct,
       min(num) AS min, max(num) AS max, round(avg(num) + 1e-10, 8) AS avg, round(quantile_cont(num, 0.5), 6) AS median,
       min(txt) AS min_text, max(txt) AS max_text
FROM ({long}) GROUP BY {lead}column_name"""


STATS = ["count", "num_nulls", "distinct_count", "percent_distinct", "min", "max", "avg", "median", "min_text", "max_text"]


def _stats(df, *lead, extra=()):
    out = df.withColumns({c: F.round(c, 6) for c in ("percent_distinct", "median")}).withColumn(
        "avg", F.round(F.col("avg") + 1e-10, 8)  # an exact half must round alike in both engines
    )
    return out.select(*lead, "column_name", *STATS, *extra)


EVENT_COLUMNS = ("value", "user_id", "event_type")
EVENTS_LONG = long_sql("events", {"value": "value", "user_id": "user_id"}, {"event_type": "event_type"})
LINES = Monitor("lineitem", ("l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"))
LINES_LONG = long_sql(
    "lineitem",
    {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice"},
    {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus"},
)


@query("profile_table", stats_sql(LINES_LONG))
def profile_table(spark, sf):
    return _stats(profile(load(spark, sf, "lineitem"), LINES))


@query(
    "profile_types",
    """SELECT * FROM (VALUES (':table', 'table'), ('l_quantity', 'double'), ('l_extendedprice', 'double'),
       ('l_returnflag', 'string'), ('l_linestatus', 'string')) t(column_name, data_type)
       WHERE (SELECT count(*) FROM lineitem) > 0""",
)
def profile_types(spark, sf):
    return profile(load(spark, sf, "lineitem"), LINES).select("column_name", "data_type")


@query("profile_rowcount", "SELECT ':table' AS column_name, count(*) AS count FROM lineitem")
def profile_rowcount(spark, sf):
    out = profile(load(spark, sf, "lineitem"), LINES)
    return out.filter("column_name = ':table' AND slice_key IS NULL").select("column_name", "count")


def slices_sql(source: str, exprs: list[tuple[str, str]], columns: str) -> str:
    """Every slice of a source next to the unsliced rows."""
    parts = [f"SELECT NULL::VARCHAR AS slice_key, NULL::VARCHAR AS slice_value, {columns} FROM {source}"]
    parts += [f"SELECT '{k}', CAST({e} AS VARCHAR), {columns} FROM {source}" for k, e in exprs]
    return " UNION ALL ".join(parts)


EVENT_SLICES = [("event_type", "event_type"), ("value > 50", "value > 50")]
SLICED = f"WITH s AS ({slices_sql('events', EVENT_SLICES, 'value, user_id, event_type')})"
SLICED_LONG = long_sql(
    "s", {"value": "value", "user_id": "user_id"}, {"event_type": "event_type"}, "slice_key, slice_value,"
)
SLICED_MONITOR = Monitor("events", EVENT_COLUMNS, slicing_exprs=("event_type", "value > 50"))


@query("profile_by_slice", SLICED + stats_sql(SLICED_LONG, "slice_key, slice_value"))
def profile_by_slice(spark, sf):
    return _stats(profile(load(spark, sf, "events"), SLICED_MONITOR), "slice_key", "slice_value")


GRANULARITIES = {
    "5 minutes": "TIMESTAMP 'epoch' + INTERVAL (floor(epoch(ts) / 300) * 300) SECOND",
    "1 hour": "date_trunc('hour', ts)",
    "1 day": "date_trunc('day', ts)",
    "2 weeks": """TIMESTAMP '1970-01-05' + INTERVAL (floor((epoch(ts) - 345600) / 1209600) * 1209600) SECOND""",
    "1 month": "date_trunc('month', ts)",
    "1 year": "date_trunc('year', ts)",
}


def windows_sql(names: list[str], columns: str, source: str = "events") -> str:
    return " UNION ALL ".join(
        f"SELECT '{g}' AS granularity, strftime({GRANULARITIES[g]}, '%Y-%m-%d %H:%M:%S') AS window_start, {columns} "
        f"FROM {source}"
        for g in names
    )


def _window_text(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


WINDOW_COLUMNS = "value, user_id, event_type"
ALL_WINDOWS = f"WITH s AS ({windows_sql(list(GRANULARITIES), WINDOW_COLUMNS)})"
WINDOW_LONG = long_sql(
    "s", {"value": "value", "user_id": "user_id"}, {"event_type": "event_type"}, "granularity, window_start,"
)
WINDOW_MONITOR = Monitor("events", EVENT_COLUMNS, "ts", tuple(GRANULARITIES))


@query("profile_by_window", ALL_WINDOWS + stats_sql(WINDOW_LONG, "granularity, window_start"))
def profile_by_window(spark, sf):
    out = profile(load(spark, sf, "events"), WINDOW_MONITOR)
    return _stats(_window_text(out), "granularity", "window_start")


@query(
    "profile_approx",
    f"""{SLICED}, v AS (
      SELECT slice_key, slice_value, 'value' AS column_name, count(*) AS "count", count(*) - count(value) AS num_nulls,
             min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg FROM s GROUP BY ALL
      UNION ALL SELECT slice_key, slice_value, ':table', count(*), NULL, NULL, NULL, NULL FROM s GROUP BY ALL)
    SELECT *, true AS near FROM v""",
)
def profile_approx_query(spark, sf):
    """The exact parts of a sketched profile, and whether the sketched ones are within a tenth of the exact profile's."""
    monitor = SLICED_MONITOR.update(columns=("value",), exact=False)
    rows = load(spark, sf, "events")
    keys = ["slice_key", "slice_value", "column_name"]
    exact = profile(rows, monitor.update(exact=True)).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("median").alias("m"), F.col("distinct_count").alias("d"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]

    def near(sketched, true):
        return F.coalesce(F.abs(F.col(sketched) - F.col(true)) <= 0.1 * F.col(true) + 1, F.col(true).isNull())

    out = profile(rows, monitor).join(exact, same).withColumn("near", near("median", "m") & near("distinct_count", "d"))
    return out.select(*keys, "count", "num_nulls", "min", "max", *rounded("avg", digits=6), "near")


LONG_KEY = "1152921504606846976 + l_orderkey * 8 + l_linenumber"


@query(
    "profile_long_keys",
    f"""SELECT count(*) AS "count", count(DISTINCT {LONG_KEY}) AS distinct_count, min({LONG_KEY})::VARCHAR AS min_digits,
               max({LONG_KEY})::VARCHAR AS max_digits FROM lineitem""",
)
def profile_long_keys(spark, sf):
    """Keys that doubles cannot tell apart."""
    rows = load(spark, sf, "lineitem").select(F.expr(LONG_KEY).alias("key"))
    out = profile(rows, Monitor("lineitem", ("key",))).filter("column_name = 'key'")
    return out.select("count", "distinct_count", "min_digits", "max_digits")


ORDERS_PLAIN = Monitor("orders", ("o_totalprice", "o_orderstatus"))


@query(
    "profile_snapshots",
    " UNION ALL ".join(
        f"SELECT '{at}' AS window_start, * FROM ("
        + stats_sql(long_sql(f"(SELECT * FROM orders WHERE {cond})", {"o_totalprice": "o_totalprice"}, {"o_orderstatus": "o_orderstatus"}))
        + ")"
        for at, cond in (("2024-01-01", "o_orderstatus <> 'P'"), ("2024-01-02", "true"))
    ),
)
def profile_snapshots(spark, sf):
    """Two refreshes of a growing table without time: one window each."""
    rows = load(spark, sf, "orders")
    first = snapshot(rows.filter("o_orderstatus <> 'P'"), ORDERS_PLAIN, "2024-01-01")
    both = append_snapshot(first, snapshot(rows, ORDERS_PLAIN, "2024-01-02"))
    return _stats(both.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")), "window_start")


@query(
    "profile_baseline",
    "SELECT 'INPUT' AS log_type, * FROM ("
    + stats_sql(long_sql("orders", {"o_totalprice": "o_totalprice"}, {"o_orderstatus": "o_orderstatus"}))
    + ") UNION ALL SELECT 'BASELINE', * FROM ("
    + stats_sql(
        long_sql(
            "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')",
            {"o_totalprice": "o_totalprice"},
            {"o_orderstatus": "o_orderstatus"},
        )
    )
    + ")",
)
def profile_baseline(spark, sf):
    rows = load(spark, sf, "orders")
    early = rows.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    monitor = ORDERS_PLAIN.update(baseline_table="early")
    return _stats(run(monitor, {"orders": rows, "early": early}, "2024-01-01"), "log_type")


@query(
    "profile_schema_change",
    "SELECT '2024-01-01' AS window_start, * FROM ("
    + stats_sql(long_sql("orders", {"o_totalprice": "o_totalprice"}, {"o_orderstatus": "o_orderstatus"}))
    + ") UNION ALL SELECT '2024-01-02', * FROM ("
    + stats_sql(
        long_sql(
            "orders", {"o_totalprice": "o_totalprice", "half_price": "o_totalprice / 2"}, {"o_orderstatus": "o_orderstatus"}
        )
    )
    + ")",
)
def profile_schema_change(spark, sf):
    """A column added between two refreshes has rows in the second window only."""
    rows = load(spark, sf, "orders").select("o_totalprice", "o_orderstatus")
    every = ORDERS_PLAIN.update(columns=None)
    first = snapshot(rows, every, "2024-01-01")
    both = append_snapshot(first, snapshot(rows.withColumn("half_price", F.col("o_totalprice") / 2), every, "2024-01-02"))
    return _stats(both.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")), "window_start")


REFRESH_MONITOR = Monitor("events", ("value", "event_type"), "ts", ("1 day", "1 month"))


@query(
    "profile_refresh",
    f"WITH s AS ({windows_sql(['1 day', '1 month'], 'value, event_type')})"
    + stats_sql(
        long_sql("s", {"value": "value"}, {"event_type": "event_type"}, "granularity, window_start,"),
        "granularity, window_start",
    ),
)
def profile_refresh(spark, sf):
    """Profile the days before the 25th, add the rest, refresh: only touched windows are recomputed."""
    rows = load(spark, sf, "events")
    late = F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")
    old = profile(rows.filter(~late), REFRESH_MONITOR)
    out = refresh(old, rows, rows.filter(late), REFRESH_MONITOR)
    return _stats(_window_text(out), "granularity", "window_start")


LATTICE_MONITOR = Monitor("events", EVENT_COLUMNS, "ts", tuple(GRANULARITIES), ("event_type", "value > 50"))
LATTICE_SQL = f"""WITH w AS ({windows_sql(list(GRANULARITIES), WINDOW_COLUMNS)}),
  s AS ({slices_sql("w", EVENT_SLICES, "granularity, window_start, " + WINDOW_COLUMNS)})
  SELECT granularity, window_start, slice_key, slice_value, column_name, "count", num_nulls, min, max, avg, min_text, max_text,
         CASE WHEN column_name = 'event_type' THEN distinct_count END AS kinds
  FROM ({stats_sql(long_sql("s", {"value": "value", "user_id": "user_id"}, {"event_type": "event_type"}, "granularity, window_start, slice_key, slice_value,"), "granularity, window_start, slice_key, slice_value")})"""


def _lattice(held):
    types = {"value": "double", "user_id": "bigint", "event_type": "string"}
    out = _window_text(estimated(held, LATTICE_MONITOR, types)).withColumn("avg", F.round(F.col("avg") + 1e-10, 8))
    kinds = F.when(F.col("column_name") == "event_type", F.col("distinct_count")).alias("kinds")
    return out.select("granularity", "window_start", "slice_key", "slice_value", "column_name", "count", "num_nulls", "min", "max", "avg", "min_text", "max_text", kinds)


@query("profile_lattice", LATTICE_SQL)
def profile_lattice(spark, sf):
    """Six granularities and two slicings from one pass that repeats no row."""
    return _lattice(states(load(spark, sf, "events"), LATTICE_MONITOR))


@query("profile_merged_refresh", LATTICE_SQL)
def profile_merged_refresh(spark, sf):
    """States stored for the days before the 25th, refreshed with the other rows alone."""
    rows = load(spark, sf, "events")
    late = F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")
    path = scratch_path(spark, "states")
    states(rows.filter(~late), LATTICE_MONITOR).write.parquet(path)
    return _lattice(refreshed(spark.read.parquet(path), rows.filter(late), LATTICE_MONITOR))


RMS = Metric("aggregate", "rms", ("value",), "sqrt(avg(`{{column_name}}` * `{{column_name}}`))")
LEVEL = Metric("derived", "level", ("value",), "20 * log10(rms)")
LEVEL_RISE = Metric("drift", "level_rise", ("value",), "{{current_df}}.level - {{base_df}}.level")
SLICED_METRICS = SLICED_MONITOR.update(custom_metrics=(RMS, LEVEL))


@query(
    "metric_aggregate",
    f"{SLICED} SELECT slice_key, slice_value, round(sqrt(avg(value * value)), 6) AS rms FROM s GROUP BY ALL",
)
def metric_aggregate(spark, sf):
    out = profile(load(spark, sf, "events"), SLICED_METRICS)
    return out.filter("column_name = 'value'").select("slice_key", "slice_value", *rounded("rms", digits=6))


@query(
    "metric_derived",
    f"{SLICED} SELECT slice_key, slice_value, round(20 * log10(sqrt(avg(value * value))), 6) AS level FROM s GROUP BY ALL",
)
def metric_derived(spark, sf):
    out = profile(load(spark, sf, "events"), SLICED_METRICS)
    return out.filter("column_name = 'value'").select("slice_key", "slice_value", *rounded("level", digits=6))


DAILY = Monitor("events", ("value",), "ts", ("1 day",), ("event_type",), (RMS, LEVEL, LEVEL_RISE))
DAILY_SQL = f"""
WITH s AS ({slices_sql("events", EVENT_SLICES[:1], "ts, value")}),
p AS (SELECT slice_key, slice_value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, avg(value) AS mean,
             quantile_cont(value, 0.5) AS med, 20 * log10(sqrt(avg(value * value))) AS level
      FROM s GROUP BY ALL),
b AS (SELECT slice_key, slice_value, count(*) AS n, avg(value) AS mean,
             quantile_cont(value, 0.5) AS med, 20 * log10(sqrt(avg(value * value))) AS level
      FROM s WHERE ts < TIMESTAMP '2024-01-08' GROUP BY ALL)"""


def _drift_out(df, *more):
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return df.filter("column_name = 'value'").select(
        "slice_key", "slice_value", day, *more, "count_delta", *rounded("avg_delta", "median_delta", "level_rise", digits=8)
    )


@query(
    "drift_consecutive",
    f"""{DAILY_SQL}
    SELECT * FROM (SELECT slice_key, slice_value, day, lag(day) OVER w AS day_cmp, n - lag(n) OVER w AS count_delta,
           round(mean - lag(mean) OVER w, 8) AS avg_delta, round(med - lag(med) OVER w, 8) AS median_delta,
           round(level - lag(level) OVER w, 8) AS level_rise
    FROM p WINDOW w AS (PARTITION BY slice_key, slice_value ORDER BY day)) WHERE day_cmp IS NOT NULL""",
)
def drift_consecutive(spark, sf):
    out = consecutive(profile(load(spark, sf, "events"), DAILY), DAILY.custom_metrics)
    return _drift_out(out, F.date_format("window_cmp", "yyyy-MM-dd").alias("day_cmp"))


BASELINE_SQL = f"""{DAILY_SQL}
    SELECT p.slice_key, p.slice_value, day, p.n - b.n AS count_delta, round(p.mean - b.mean, 8) AS avg_delta,
           round(p.med - b.med, 8) AS median_delta, round(p.level - b.level, 8) AS level_rise
    FROM p JOIN b ON p.slice_key IS NOT DISTINCT FROM b.slice_key
      AND p.slice_value IS NOT DISTINCT FROM b.slice_value"""


def _baseline_drift(spark, sf):
    rows = load(spark, sf, "events")
    base = baseline_profile(rows.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")), DAILY)
    return against_baseline(profile(rows, DAILY), base, DAILY.custom_metrics)


@query("drift_baseline", BASELINE_SQL)
def drift_baseline(spark, sf):
    """Every day against the profile of the first week."""
    return _drift_out(_baseline_drift(spark, sf))


@query(
    "metric_drift",
    f"SELECT slice_key, slice_value, day, level_rise FROM ({BASELINE_SQL}) WHERE slice_key IS NOT NULL",
)
def metric_drift(spark, sf):
    out = _drift_out(_baseline_drift(spark, sf)).filter("slice_key IS NOT NULL")
    return out.select("slice_key", "slice_value", "day", "level_rise")


@query(
    "metric_percentile",
    """SELECT event_type, round(quantile_cont(value, 0.9), 6) AS percentile_90,
              round(quantile_cont(value, 0.1), 6) AS percentile_10 FROM events GROUP BY event_type""",
)
def metric_percentile(spark, sf):
    out = quantiles(load(spark, sf, "events"), ["event_type"], "value", {"percentile_90": 0.9, "percentile_10": 0.1})
    return out.select("event_type", *rounded("percentile_90", "percentile_10", digits=6))


@query(
    "metric_percentile_approx",
    f"{SLICED} SELECT slice_key, slice_value, count(*) AS n, true AS near FROM s GROUP BY ALL",
)
def metric_percentile_approx(spark, sf):
    """Whether sketched quartiles lie within a hundredth of the rows of the exact ones."""
    approx = Metric(
        "aggregate",
        "quartiles",
        ("value",),
        "percentile_approx(`{{column_name}}`, array(0.25, 0.5, 0.75))",
        T.ArrayType(T.DoubleType()),
    )
    ranks = Metric(
        "aggregate",
        "bounds",
        ("value",),
        "percentile(`{{column_name}}`, array(0.24, 0.26, 0.49, 0.51, 0.74, 0.76))",
        T.ArrayType(T.DoubleType()),
    )
    out = profile(load(spark, sf, "events"), SLICED_MONITOR.update(custom_metrics=(approx, ranks)))
    inside = F.lit(True)
    for i in range(3):
        inside = inside & F.col("quartiles")[i].between(F.col("bounds")[2 * i], F.col("bounds")[2 * i + 1])
    return out.filter("column_name = 'value'").select("slice_key", "slice_value", F.col("count").alias("n"), inside.alias("near"))


DESCRIBED = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount"}


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
            round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM lineitem"""
        for c in DESCRIBED
    ),
)
def describe_numeric(spark, sf):
    out = describe(load(spark, sf, "lineitem"), list(DESCRIBED))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


SHIFT = "TIMESTAMP '2024-01-16'"


def _halves(spark, sf):
    rows = load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return rows.filter(F.col("ts") >= cut), rows.filter(F.col("ts") < cut)


@query(
    "drift_numeric",
    f"""WITH e AS (SELECT ts >= {SHIFT} AS cur, value, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k FROM events),
    l AS (SELECT 'value' AS column_name, value AS num, cur FROM e UNION ALL SELECT 'k', k, cur FROM e),
    v AS (SELECT column_name, num, count(*) FILTER (cur) AS a, count(*) FILTER (NOT cur) AS b FROM l GROUP BY ALL),
    r AS (SELECT *, sum(a) OVER w AS ra, sum(b) OVER w AS rb, sum(a) OVER t AS na, sum(b) OVER t AS nb FROM v
          WINDOW w AS (PARTITION BY column_name ORDER BY num), t AS (PARTITION BY column_name)),
    d AS (SELECT column_name, least(floor((rb - b)::DOUBLE / nb * 10), 9) AS bin, sum(a) AS a, sum(b) AS b,
                 max(na) AS na, max(nb) AS nb, max(abs(ra::DOUBLE / na - rb::DOUBLE / nb)) AS ks,
                 sum(num * a) AS sa, sum(num * b) AS sb FROM r GROUP BY ALL)
    SELECT column_name, round(sum(sa) / sum(a) - sum(sb) / sum(b), 6) AS mean_shift, round(max(ks), 6) AS ks_distance,
           round(sum((greatest(a::DOUBLE / na, 1e-6) - greatest(b::DOUBLE / nb, 1e-6))
             * ln(greatest(a::DOUBLE / na, 1e-6) / greatest(b::DOUBLE / nb, 1e-6))), 6) AS psi
    FROM d GROUP BY column_name""",
)
def drift_numeric(spark, sf):
    current, base = _halves(spark, sf)
    out = numeric_drift(current, base, ["value", "k"])
    return out.select("column_name", *rounded("mean_shift", "ks_distance", "psi", digits=6))


@query(
    "drift_categorical",
    f"""WITH l AS (SELECT 'event_type' AS column_name, event_type AS txt, ts >= {SHIFT} AS cur FROM events
                  UNION ALL SELECT 'props', props, ts >= {SHIFT} FROM events),
    v AS (SELECT column_name, txt, count(*) FILTER (cur)::DOUBLE AS a, count(*) FILTER (NOT cur)::DOUBLE AS b
          FROM l GROUP BY ALL),
    r AS (SELECT *, a / sum(a) OVER t AS p, b / sum(b) OVER t AS q, sum(a) OVER t AS na FROM v
          WINDOW t AS (PARTITION BY column_name))
    SELECT column_name, round(sum(abs(p - q)) / 2, 6) AS total_variation,
           round((sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 6) AS jensen_shannon,
           round(sum(CASE WHEN q > 0 THEN (a - na * q) * (a - na * q) / (na * q) ELSE 0 END), 5) AS chi_square,
           round(sum(CASE WHEN q = 0 THEN p ELSE 0 END), 6) AS new_share
    FROM r GROUP BY column_name""",
)
def drift_categorical(spark, sf):
    out = categorical_drift(*_halves(spark, sf), ["event_type", "props"])
    return out.select(
        "column_name",
        *rounded("total_variation", "jensen_shannon", digits=6),
        *rounded("chi_square", digits=5),
        *rounded("new_share", digits=6),
    )
