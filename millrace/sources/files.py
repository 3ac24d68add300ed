"""Readers and writers. Schemas are explicit; timestamps without zone keep their meaning in UTC."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """One row per ``row_tag`` element; attributes are the columns that start with an underscore."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def date_range(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive calendar days."""
    return spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_files(df: DataFrame, path: str, fmt: str, partitions: int | None = None, mode: str = "overwrite") -> None:
    """Write JSON, CSV or Parquet files; ``partitions`` sets the number of files."""
    out = df.repartition(partitions) if partitions else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), replace_partitions: bool = False
) -> DataFrame:
    """Write a Parquet table by path and return it as read back with merged schemas.

    ``replace_partitions`` rewrites only the partitions present in ``df``.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return df.sparkSession.read.option("mergeSchema", mode == "append").parquet(path)


def replace_table(df: DataFrame, name: str, base: str) -> DataFrame:
    """Create or replace a Parquet catalog table: rows go to a new folder below ``base``, then the name moves there.

    A job that fails leaves the old table as it was; readers of the old folder can finish.
    """
    spark, folder = df.sparkSession, f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files of a table with a location stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{folder}'")
    return spark.table(name)


def create_table_as(spark: SparkSession, name: str, base: str, query: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT for a Parquet catalog table; the query may read the table it replaces."""
    return replace_table(spark.sql(query), name, base)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """Append rows by column name; columns new to the table are added to it, and null in older rows."""
    spark = df.sparkSession
    known = {f.name.lower() for f in spark.table(name).schema.fields}
    added = [f for f in df.schema.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    have = {c.lower(): c for c in df.columns}
    shape = spark.table(name).schema.fields
    cells = [(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape]
    df.select(*cells).write.insertInto(name)
    return spark.table(name)


def list_tables(spark: SparkSession, pattern: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def wait_for_rows(read: Callable[[], DataFrame], timeout: float, pause: float = 0.5) -> DataFrame:
    """Poll until the table exists and has a row; raise TimeoutError after ``timeout`` seconds."""
    deadline = time.monotonic() + timeout
    while True:
        try:
            df = read()
            if not df.isEmpty():
                return df
        except Exception as e:  # the table may not exist yet
            if "PATH_NOT_FOUND" not in str(e) and "TABLE_OR_VIEW_NOT_FOUND" not in str(e) and (
                "UNABLE_TO_INFER_SCHEMA" not in str(e)
            ):
                raise
        if time.monotonic() > deadline:
            raise TimeoutError("table missing or empty")
        time.sleep(pause)
