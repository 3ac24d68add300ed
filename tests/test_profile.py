from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace.operators.drift import against_baseline, categorical_drift, consecutive, numeric_drift
from millrace.operators.profile import Metric, Monitor, baseline_profile, describe, profile, profile_approx, refresh, run, window_start


def small(spark):
    data = [(1.0, "a", 1), (2.0, "a", 2), (4.0, None, 3), (None, "b", 4)]
    return spark.createDataFrame(data, "x double, c string, i long")


def test_profile_values(spark):
    got = {r["column_name"]: r for r in profile(small(spark), Monitor("t")).collect()}
    assert set(got) == {":table", "x", "c", "i"}
    assert got[":table"]["count"] == 4 and got[":table"]["distinct_count"] is None
    x = got["x"]
    assert (x["count"], x["num_nulls"], x["distinct_count"], x["min"], x["max"], x["median"]) == (4, 1, 3, 1.0, 4.0, 2.0)
    assert (got["c"]["min_text"], got["c"]["max_text"], got["c"]["distinct_count"], got["c"]["num_nulls"]) == ("a", "b", 2, 1)
    assert got["i"]["median"] == 2.5 and got["i"]["data_type"] == "bigint"


def test_null_slice_is_not_the_whole_table(spark):
    out = profile(small(spark), Monitor("t", ("x",), slicing_exprs=("c", "x > 1"))).filter("column_name = ':table'")
    got = {(r["slice_key"], r["slice_value"]): r["count"] for r in out.collect()}
    assert got == {(None, None): 4, ("c", "a"): 2, ("c", None): 1, ("c", "b"): 1, ("x > 1", "true"): 2, ("x > 1", "false"): 1, ("x > 1", None): 1}


def test_empty_and_all_null(spark):
    assert profile(small(spark).limit(0), Monitor("t")).count() == 0
    nulls = spark.createDataFrame([(None, None)], "x double, c string")
    got = {r["column_name"]: r for r in profile(nulls, Monitor("t")).collect()}
    assert got["x"]["num_nulls"] == 1 and got["x"]["median"] is None and got["x"]["distinct_count"] == 0


@pytest.mark.parametrize(
    ("granularity", "start"),
    [
        ("5 minutes", "2024-03-13 10:05:00"),
        ("30 minutes", "2024-03-13 10:00:00"),
        ("1 hour", "2024-03-13 10:00:00"),
        ("1 day", "2024-03-13 00:00:00"),
        ("1 week", "2024-03-11 00:00:00"),
        ("2 weeks", "2024-03-11 00:00:00"),
        ("1 month", "2024-03-01 00:00:00"),
        ("3 months", "2024-01-01 00:00:00"),
        ("1 year", "2024-01-01 00:00:00"),
    ],
)
def test_windows(spark, granularity, start):
    df = spark.createDataFrame([(datetime(2024, 3, 13, 10, 7, 9),)], "ts timestamp_ntz")
    got = str(df.select(window_start(F.col("ts"), granularity)).first()[0])
    if granularity == "2 weeks":
        assert got in ("2024-03-04 00:00:00", "2024-03-11 00:00:00")
    else:
        assert got == start


def series(spark, days=4):
    data = [(datetime(2024, 1, 1 + d, h), float(d * 10 + h), "k" if h % 2 else "j") for d in range(days) for h in range(5)]
    return spark.createDataFrame(data, "ts timestamp_ntz, v double, c string")


LOG = Metric("aggregate", "total", ("v",), "sum(`{{column_name}}`)")
TWICE = Metric("derived", "twice", ("v",), "total * 2")
DELTA = Metric("drift", "delta", ("v",), "{{current_df}}.twice - {{base_df}}.twice")
QUARTILES = Metric("aggregate", "q", ("v",), "percentile(`{{column_name}}`, array(0.5, 1.0))", T.ArrayType(T.DoubleType()))


def test_metrics_and_drift(spark):
    monitor = Monitor("t", ("v", "c"), "ts", ("1 day",), (), (LOG, TWICE, DELTA, QUARTILES))
    out = profile(series(spark), monitor)
    day = {str(r["window_start"])[:10]: r for r in out.filter("column_name = 'v'").collect()}
    assert day["2024-01-02"]["total"] == 60.0 and day["2024-01-02"]["twice"] == 120.0 and day["2024-01-02"]["q"] == [12.0, 14.0]
    assert out.filter("column_name = 'c'").first()["total"] is None
    drift = consecutive(out, monitor.custom_metrics).filter("column_name = 'v'").collect()
    assert len(drift) == 3 and {r["delta"] for r in drift} == {100.0} and {r["avg_delta"] for r in drift} == {10.0}
    base = baseline_profile(series(spark, 1), monitor)
    against = against_baseline(out, base, monitor.custom_metrics).filter("column_name = 'v'").collect()
    assert sorted(r["delta"] for r in against) == [0.0, 100.0, 200.0, 300.0]
    assert {r["drift_type"] for r in against} == {"BASELINE"}


def test_refresh_equals_full_profile(spark):
    df, monitor = series(spark), Monitor("t", ("v",), "ts", ("1 day", "1 month"))
    cut = F.lit("2024-01-03").cast("timestamp_ntz")
    old = profile(df.filter(F.col("ts") < cut), monitor)
    new = refresh(old, df, df.filter(F.col("ts") >= cut), monitor)
    assert rows(new, *sorted(new.columns)) == rows(profile(df, monitor), *sorted(new.columns))
    assert refresh(old, df, df.limit(0), monitor).count() == old.count()


def test_monitor_settings(spark):
    monitor = Monitor("t", ("v",), "ts", ("1 day",))
    assert monitor.update(slicing_exprs=("c",)).granularities == ("1 day",)
    assert run(monitor.update(skip_analysis=True), {}) is None
    out = run(monitor.update(baseline_table="b"), {"t": series(spark), "b": series(spark, 1)})
    assert {r["log_type"] for r in out.collect()} == {"INPUT", "BASELINE"}


def test_describe_and_approx(spark):
    got = {r["column_name"]: r for r in describe(small(spark), ["x", "i"]).collect()}
    assert got["x"]["count"] == 3 and got["x"]["q50"] == 2.0 and got["i"]["q25"] == 1.75
    approx = {r["column_name"]: r for r in profile_approx(small(spark), Monitor("t")).collect()}
    assert approx["x"]["num_nulls"] == 1 and approx["c"]["distinct_count"] == 2


def test_drift_of_same_data_is_zero(spark):
    df = series(spark)
    n = numeric_drift(df, df, ["v"]).first()
    assert (n["mean_shift"], n["ks_distance"], n["psi"]) == (0.0, 0.0, 0.0)
    c = categorical_drift(df, df, ["c"]).first()
    assert c["total_variation"] == 0.0 and c["jensen_shannon"] == pytest.approx(0.0) and c["chi_square"] == pytest.approx(0.0)
    apart = numeric_drift(df.filter("v >= 20"), df.filter("v < 20"), ["v"]).first()
    assert apart["ks_distance"] == 1.0
    new = categorical_drift(df.withColumn("c", F.lit("new")), df, ["c"]).first()
    assert new["new_share"] == 1.0 and new["total_variation"] == 1.0


def test_wide_tables_in_passes(spark, monkeypatch):
    monitor = Monitor("t", ("v", "c"), "ts", ("1 day",), ("c",), (LOG, TWICE))
    want = profile(series(spark), monitor)
    order = sorted(want.columns)
    whole = rows(want, *order)
    monkeypatch.setattr("millrace.operators.profile.COLUMNS_PER_PASS", 1)
    assert rows(profile(series(spark), monitor).select(want.columns), *order) == whole


def test_drift_without_baseline_rows(spark):
    df = series(spark)
    n = numeric_drift(df, df.limit(0), ["v"]).first()
    assert (n["mean_shift"], n["ks_distance"], n["psi"]) == (None, None, None)
    assert categorical_drift(df, df.limit(0), ["c"]).first()["total_variation"] is None
    assert numeric_drift(df.limit(0), df.limit(0), ["v"]).count() == 0


def test_longs_and_decimals_are_told_apart(spark):
    rows = spark.range(100).selectExpr("id + 1152921504606846976 AS k", "cast(id as decimal(28,10)) / 10000000 AS d")
    got = {r["column_name"]: r for r in profile(rows.withColumn("d", F.col("d").cast("decimal(28,10)")), Monitor("t")).collect()}
    assert got["k"]["distinct_count"] == 100 and got["k"]["percent_distinct"] == 100.0
    assert (got["k"]["min_digits"], got["k"]["max_digits"]) == ("1152921504606846976", "1152921504606847075")
    assert got["d"]["distinct_count"] == 100 and got["d"]["max_digits"] == "0.0000099"


def test_sketched_profile_has_the_same_columns(spark):
    monitor = Monitor("t", custom_metrics=(Metric("aggregate", "total", ("x",), "sum(`{{column_name}}`)"),))
    exact, sketched = (profile(small(spark), monitor.update(exact=e)) for e in (True, False))
    assert set(exact.columns) == set(sketched.columns)
    one, two = ({(r["column_name"]): (r["count"], r["num_nulls"], r["min"], r["max"], r["min_text"], r["total"]) for r in d.collect()} for d in (exact, sketched))
    assert one == two


def test_refresh_reads_touched_stretches_only(spark):
    from datetime import datetime

    from millrace.operators.profile import _stretches

    days = [datetime(2000, 1, 1), datetime(2024, 5, 1), datetime(2024, 5, 2)]
    ends = [datetime(2000, 1, 2), datetime(2024, 5, 2), datetime(2024, 5, 3)]
    assert _stretches(days, ends) == [(days[0], ends[0]), (days[1], ends[2])]
    assert _stretches(days, ends, 1) == [(days[0], ends[2])]
    rows = spark.range(3000).selectExpr("timestamp_ntz'2000-01-01' + make_interval(0, 0, 0, cast(id as int)) AS ts", "id AS x")
    monitor = Monitor("t", ("x",), "ts", ("1 day", "1 month"))
    late = rows.filter("id in (3, 2900)")
    before = profile(rows.filter("id not in (3, 2900)"), monitor)
    out = refresh(before, rows, late, monitor)
    again = profile(rows, monitor)
    key = ["granularity", "window_start", "column_name", "count", "distinct_count", "max"]
    assert sorted(map(str, out.select(key).collect())) == sorted(map(str, again.select(key).collect()))
    # nothing between the two late days is read for the daily windows
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "2000-01-05" in plan and "2007-12-10" in plan
