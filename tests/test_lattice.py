import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import lattice as L
from millrace.operators.profile import Metric, Monitor, profile

MONITOR = Monitor("t", ("v", "n", "s"), "ts", ("5 minutes", "1 hour", "2 weeks", "1 month"), ("s", "v > 50"))
EXACT = ["granularity", "window_start", "slice_key", "slice_value", "column_name", "count", "num_nulls", "min", "max", "min_text", "max_text", "min_digits", "max_digits", "data_type"]


def table(spark, n=3000, seed=0):
    rnd, start = random.Random(seed), datetime(2024, 1, 27, 20)
    out = []
    for _ in range(n):
        ts = None if rnd.random() < 0.01 else start + timedelta(seconds=rnd.randrange(9 * 86_400))
        out.append((ts, rnd.choice([None, float("inf"), *[rnd.uniform(0, 100) for _ in range(20)]]), rnd.choice([None, 2**60 + rnd.randrange(40)]), rnd.choice(["a", "b", None])))
    return spark.createDataFrame(out, "ts timestamp_ntz, v double, n long, s string")


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def comparable(df):
    return rows(df.select(*EXACT, F.round("avg", 6).alias("avg")))


def test_equals_the_exact_profile_where_it_is_exact(spark):
    df = table(spark).repartition(5)
    made, true = L.estimated(L.states(df, MONITOR), MONITOR, types(df)), profile(df, MONITOR)
    assert comparable(made) == comparable(true)
    keys = EXACT[:5]
    both = made.join(true.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("distinct_count").alias("d"), F.col("median").alias("m")), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    got = both.collect()
    assert len(got) == true.count()
    for r in got:
        assert (r["distinct_count"] is None) == (r["d"] is None) and abs((r["distinct_count"] or 0) - (r["d"] or 0)) <= 0.07 * (r["d"] or 0) + 0.5
        assert (r["median"] is None) == (r["m"] is None)
    # the estimated median of all rows of a month has nearly half of the rows below it
    big = max((r for r in got if r["column_name"] == "v" and r["slice_key"] is None and r["granularity"] == "1 month"), key=lambda r: r["count"])
    month = df.filter(F.date_trunc("month", "ts") == F.lit(big["window_start"])).filter("v is not null")
    assert abs(month.filter(F.col("v") <= big["median"]).count() / month.count() - 0.5) < 0.03


def test_refresh_equals_all_rows_at_once(spark, scratch):
    df = table(spark, seed=3)
    late = F.coalesce(F.col("ts") >= F.lit("2024-02-02 10:02:00").cast("timestamp_ntz"), F.lit(True))
    path = scratch("states")
    L.states(df.filter(~late), MONITOR).write.parquet(path)
    out = L.refreshed(spark.read.parquet(path), df.filter(late), MONITOR)
    one, two = (L.estimated(s, MONITOR, types(df)) for s in (out, L.states(df, MONITOR)))
    assert comparable(one) == comparable(two)
    for a, b in zip(rows(one.select(*EXACT[:5], "distinct_count")), rows(two.select(*EXACT[:5], "distinct_count"))):
        assert a[:5] == b[:5] and abs((a[5] or 0) - (b[5] or 0)) <= 0.07 * (b[5] or 0)


def test_rows_are_not_repeated_before_they_meet(spark):
    plan = L.states(table(spark, 10), MONITOR)._jdf.queryExecution().sparkPlan().toString().split("\n")
    lowest = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert any("Generate" in line for line in plan[:lowest]) and not any("Generate" in line or "Expand" in line for line in plan[lowest:])


def test_without_time_and_without_rows(spark):
    monitor = Monitor("t", ("v", "s"), slicing_exprs=("s",))
    df = table(spark, 200)
    made = L.estimated(L.states(df, monitor), monitor, types(df))
    keys = ["slice_key", "slice_value", "column_name", "count", "num_nulls", "min", "max"]
    assert rows(made.select(*keys)) == rows(profile(df, monitor).select(*keys))
    assert L.states(df.limit(0), MONITOR).count() == 0
    assert L.refreshed(L.states(df.limit(0), MONITOR), df, MONITOR).count() == L.states(df, MONITOR).count()


def test_finest_window_and_refused_metrics(spark):
    assert L.finest(("30 minutes", "1 hour", "45 minutes")) == "900 seconds"
    assert L.finest(("1 month", "1 year")) == "86400 seconds" and L.finest(("2 weeks",)) == "172800 seconds"
    with pytest.raises(ValueError, match="aggregate"):
        L.states(table(spark, 5), MONITOR.update(custom_metrics=(Metric("aggregate", "x", ("v",), "sum(v)"),)))
    spread = Metric("derived", "spread", ("v",), "max - min")
    df = table(spark, 50).filter("v < 1000")
    out = L.estimated(L.states(df, MONITOR), MONITOR.update(custom_metrics=(spread,)), types(df))
    assert all((r["spread"] is None) == (r["column_name"] != "v") or r["min"] is None for r in out.collect())
