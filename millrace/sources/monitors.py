"""Monitors kept by name: settings, profile history and drift of tables under watch."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.drift import against_baseline, consecutive
from millrace.operators.profile import (
    Metric,
    Monitor,
    append_snapshot,
    baseline_profile,
    profile,
    refresh,
    snapshot,
)
from millrace.sources.register import Register


def _to_json(monitor: Monitor) -> str:
    spec = asdict(monitor)
    for m in spec["custom_metrics"]:
        m["output_type"] = m["output_type"].jsonValue()
    return json.dumps(spec)


def _from_json(text: str) -> Monitor:
    spec = json.loads(text)
    lists = {k: tuple(v) if isinstance(v, list) else v for k, v in spec.items()}
    lists["custom_metrics"] = tuple(_metric(m) for m in spec["custom_metrics"])
    return Monitor(**lists)


def _metric(m: dict) -> Metric:
    holder = {"type": "struct", "fields": [{"name": "x", "type": m["output_type"], "nullable": True, "metadata": {}}]}
    kind = T.StructType.fromJson(holder)["x"].dataType
    return Metric(m["metric_type"], m["metric_name"], tuple(m["input_columns"]), m["metric_definition"], kind)


class MonitorStore:
    """Creates, refreshes and reads monitors below one shared folder.

    ``read`` turns a table name into rows; by default the catalog does.
    """

    def __init__(self, spark: SparkSession, root: str, read: Callable[[str], DataFrame] | None = None):
        self.spark, self.read = spark, read or spark.table
        self.register = Register(spark, root)

    def create_or_update(self, monitor: Monitor, refresh_ts: str | None = None) -> None:
        """Store the settings and, unless told to skip it, profile the table. History is kept."""
        row = self.register.find(monitor.table_name)
        self.register.put(monitor.table_name, _to_json(monitor), row["folder"] if row else None)
        if not monitor.skip_analysis:
            self.refresh(monitor.table_name, refresh_ts, backfill=True)

    def update(self, table_name: str, **changes) -> Monitor:
        """Change the named settings only; nothing is computed."""
        row = self.register.require(table_name)
        monitor = _from_json(row["spec"]).update(**changes)
        self.register.put(table_name, _to_json(monitor), row["folder"])
        return monitor

    def get(self, table_name: str) -> Monitor:
        return _from_json(self.register.require(table_name)["spec"])

    def delete(self, table_name: str) -> None:
        self.register.drop(table_name)

    def refresh(
        self,
        table_name: str,
        refresh_ts: str | None = None,
        new_rows: DataFrame | None = None,
        backfill: bool = False,
    ) -> None:
        """Bring the profile up to date.

        Tables without time get one more window, stamped ``refresh_ts``. For the others ``new_rows``
        names what was added, and only windows it touches are computed; a backfill computes all.
        """
        monitor, rows = self.get(table_name), self.read(table_name)
        old = self._stored(table_name)
        if monitor.timestamp_col is None:
            if refresh_ts is None:
                raise ValueError("a table without time needs refresh_ts")
            out = snapshot(rows, monitor, refresh_ts)
            if old is not None:
                out = append_snapshot(old.filter("log_type = 'INPUT'"), out)
        elif old is not None and new_rows is not None and not backfill:
            kept = old.filter("log_type = 'INPUT'").drop("log_type")
            out = refresh(kept, rows, new_rows, monitor)
            out = out.withColumn("log_type", F.lit("INPUT"))
        else:
            out = profile(rows, monitor).withColumn("log_type", F.lit("INPUT"))
        if monitor.baseline_table:
            base = baseline_profile(self.read(monitor.baseline_table), monitor)
            out = out.unionByName(base, allowMissingColumns=True)
        folder = self.register.new_folder(table_name)
        out.write.parquet(folder)
        self.register.put(table_name, _to_json(monitor), folder)

    def analysis(self, table_name: str) -> DataFrame:
        """Profile rows of the table and, told apart by ``log_type``, of its baseline."""
        stored = self._stored(table_name)
        if stored is None:
            raise ValueError(f"{table_name!r} has not been profiled yet")
        return stored

    def drift(self, table_name: str) -> DataFrame:
        """Every window against the one before it and against the baseline, if there is one."""
        monitor, rows = self.get(table_name), self.analysis(table_name)
        current = rows.filter("log_type = 'INPUT'")
        out = consecutive(current, monitor.custom_metrics)
        if monitor.baseline_table:
            base = rows.filter("log_type = 'BASELINE'")
            out = out.unionByName(against_baseline(current, base, monitor.custom_metrics))
        return out

    def _stored(self, table_name: str) -> DataFrame | None:
        folder = self.register.require(table_name)["folder"]
        return self.spark.read.parquet(folder) if folder else None
