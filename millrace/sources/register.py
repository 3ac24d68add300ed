"""A small append-only register: which folder holds the newest version of a name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import latest_per_key

COLUMNS = "name string, version long, spec string, folder string"


class Register:
    """Versions become visible by one appended row, so readers never see half a write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def newest(self) -> DataFrame:
        """One row per name; a dropped name has no spec."""
        try:
            rows = self.spark.read.schema(COLUMNS).parquet(f"{self.root}/_register")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], COLUMNS)
        same = rows.groupBy("name", "version").agg(F.count("*").alias("n"), F.first("spec").alias("spec"), F.first("folder").alias("folder"))
        message = F.concat(F.lit("two writers registered one version of "), F.col("name"))
        checked = same.filter(F.when(F.col("n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        return latest_per_key(checked.drop("n"), ["name"], ["version"])

    def find(self, name: str) -> Row | None:
        row = self.newest().filter(F.col("name") == name).first()
        return row if row and row["spec"] is not None else None

    def require(self, name: str) -> Row:
        row = self.find(name)
        if row is None:
            raise KeyError(f"nothing registered as {name!r}")
        return row

    def names(self) -> list[str]:
        return sorted(r["name"] for r in self.newest().filter("spec is not null").select("name").collect())

    def new_folder(self, name: str) -> str:
        return f"{self.root}/{name}/{uuid.uuid4().hex}"

    def put(self, name: str, spec: str | None, folder: str | None) -> None:
        last = self.newest().filter(F.col("name") == name).first()
        row = (name, last["version"] + 1 if last else 0, spec, folder)
        out = self.spark.createDataFrame([row], COLUMNS).coalesce(1)
        out.write.mode("append").parquet(f"{self.root}/_register")

    def drop(self, name: str) -> None:
        """Forget the name; its folders stay for readers still at work."""
        self.require(name)
        self.put(name, None, None)
