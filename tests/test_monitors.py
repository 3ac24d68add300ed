from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.profile import Metric, Monitor
from millrace.sources.monitors import MonitorStore

TOTAL = Metric("aggregate", "total", ("v",), "sum(`{{column_name}}`)")
SPREAD = Metric("aggregate", "spread", ("v",), "percentile(`{{column_name}}`, array(0.0, 1.0))", T.ArrayType(T.DoubleType()))
DELTA = Metric("drift", "delta", ("v",), "{{current_df}}.total - {{base_df}}.total")


def test_snapshot_monitor(spark, scratch):
    tables = {"t": spark.createDataFrame([(1.0,), (3.0,)], "v double")}
    store = MonitorStore(spark, scratch("monitors"), tables.__getitem__)
    store.create_or_update(Monitor("t", custom_metrics=(TOTAL, SPREAD, DELTA)), "2024-01-01")
    assert store.get("t").custom_metrics == (TOTAL, SPREAD, DELTA)
    assert store.drift("t").isEmpty()
    tables["t"] = tables["t"].unionByName(spark.createDataFrame([(6.0,)], "v double"))
    store.refresh("t", "2024-01-02")
    # A new column and a baseline: earlier windows have no row for the column.
    tables["t"], tables["b"] = tables["t"].withColumn("w", F.col("v") * 2), tables["t"].limit(0).unionByName(tables["t"])
    store.update("t", baseline_table="b")
    store.refresh("t", "2024-01-03")
    rows = store.analysis("t")
    assert rows.filter("column_name = 'w' AND log_type = 'INPUT'").count() == 1
    assert rows.filter("column_name = ':table' AND log_type = 'INPUT'").count() == 3
    drift = store.drift("t").filter("column_name = 'v'")
    got = {(r["drift_type"], str(r["window_start"])[:10]): r["delta"] for r in drift.collect()}
    assert got == {
        ("CONSECUTIVE", "2024-01-02"): 6.0,
        ("CONSECUTIVE", "2024-01-03"): 0.0,
        ("BASELINE", "2024-01-01"): -6.0,
        ("BASELINE", "2024-01-02"): 0.0,
        ("BASELINE", "2024-01-03"): 0.0,
    }
    with pytest.raises(ValueError, match="refresh_ts"):
        store.refresh("t")
    store.delete("t")
    with pytest.raises(KeyError):
        store.analysis("t")


def test_time_series_monitor(spark, scratch):
    def day(d):
        return spark.createDataFrame([(datetime(2024, 1, d, h), float(h)) for h in range(3)], "ts timestamp_ntz, v double")

    tables = {"s": day(1).unionByName(day(2))}
    store = MonitorStore(spark, scratch("monitors"), tables.__getitem__)
    store.create_or_update(Monitor("s", ("v",), "ts", ("1 day",), skip_analysis=True))
    with pytest.raises(ValueError, match="profiled"):
        store.analysis("s")
    store.refresh("s")
    added = day(3).unionByName(day(2))
    tables["s"] = tables["s"].unionByName(added)
    store.refresh("s", new_rows=added)
    got = {str(r["window_start"])[:10]: r["count"] for r in store.analysis("s").filter("column_name = 'v'").collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 6, "2024-01-03": 3}
    incremental = sorted(map(str, store.analysis("s").collect()))
    store.refresh("s", backfill=True)
    assert sorted(map(str, store.analysis("s").collect())) == incremental
