"""Feature tables stored for how they are used: merged part by part, or looked up without moving them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import merge_upsert, unique_rows
from millrace.operators.lookup import ROWS_PER_TASK, point_in_time, tile_edges
from millrace.session import parallelism, scratch_path

PART = "_part"


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The part of a row, from its whole row key: row keys are unique, so no busy key fills one part."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


class PartedTable:
    """A Parquet table in ``parts`` folders by the hash of its row key.

    A merge reads and rewrites the folders that hold keys of its source, and no others; the rest of the files stay as they
    are. ``parts`` belongs to the table: choose it so that a part is a few files, and give the same number ever after.
    Executors may be lost at any time: folders are swapped when all new files are there. The swap itself is a rename per
    folder by the driver; a driver lost in between leaves new files in the table's staging folder. One writer at a time.
    Frames read before a merge may name files that it has replaced: read again. To ``create`` a null key is a key like any
    other; merged rows with a null in the key match nothing and are added. The table may be empty.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], parts: int):
        if parts < 1:
            raise ValueError("parts must be positive")
        if PART in schema.fieldNames():
            raise ValueError(f"{PART} names the parts")
        absent = [k for k in keys if k not in schema.fieldNames()]
        if absent:
            raise ValueError(f"key columns missing: {absent}")
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path, schema, list(keys), parts

    def create(self, df: DataFrame) -> None:
        """Write the first rows; two of one row key stop the job, and so does a folder that exists."""
        self._laid(unique_rows(self._fit(df), self.keys)).write.partitionBy(PART).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def touched(self, source: DataFrame) -> list[int]:
        """Parts that hold keys of the source; at most ``parts`` numbers reach the driver."""
        found = source.select(part_of(self.keys, self.parts).alias(PART)).distinct().collect()
        return sorted(r[PART] for r in found)

    def merge(self, source: DataFrame) -> list[int]:
        """Replace rows of equal keys, add the rest, and return the parts that were rewritten.

        Key columns are cast to the table's types before they are hashed. The source is read twice: once for its parts.
        """
        rows = self._fit(source)
        parts = self.touched(rows)
        if parts:
            old = self._stored().filter(F.col(PART).isin(parts)).drop(PART)
            merged = self._laid(merge_upsert(old, rows, self.keys))
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)
        return parts

    def _fit(self, df: DataFrame) -> DataFrame:
        """The table's columns in its order and types; others are left out, missing ones are an error."""
        absent = [f for f in self.schema.fieldNames() if f not in df.columns]
        if absent:
            raise ValueError(f"columns missing: {absent}")
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def _stored(self) -> DataFrame:
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        return self.spark.read.schema(T.StructType([*fields, T.StructField(PART, T.IntegerType())])).parquet(self.path)

    def _laid(self, df: DataFrame) -> DataFrame:
        """Rows of a part side by side; adaptive execution cuts large parts into several tasks and files."""
        return df.withColumn(PART, part_of(self.keys, self.parts)).hint("rebalance", PART)


class BucketedFeatures:
    """A feature table in buckets by key, sorted by key and time, for point-in-time lookups that do not move it.

    Lookups send label rows to the buckets of the table; ``explain`` shows no exchange above the scan of the table. Keys
    with more rows than a task should hold, ``rows_per_task``, stay out of the buckets in a plain table of their own and are looked
    up in tiles of time (``tile_edges``), and so are keys that are busy among the label rows. Both lists hold fewer keys
    than there are tasks' worth of rows; they are tables, not collected.

    ``name`` is a name in the session's catalog, ``path`` a new folder that all executors share. Buckets are at least
    the shuffle partitions of the session, as fewer would be shuffled again.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, keys: Sequence[str], ts: str,
        buckets: int | None = None, rows_per_task: int = ROWS_PER_TASK,
    ):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.keys, self.ts, self.rows_per_task = list(keys), ts, rows_per_task
        self.buckets = max(buckets or 0, parallelism(spark))

    def create(self, df: DataFrame) -> None:
        """Write the table. Rows without a key or a time match nothing and are left out."""
        known = F.lit(True)
        for c in (*self.keys, self.ts):
            known = known & F.col(c).isNotNull()
        rows = df.filter(known)
        rows.groupBy(*self.keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > self.rows_per_task).drop("_n").write.parquet(self._busy)
        busy = self.spark.read.parquet(self._busy)
        rows.join(busy, self.keys, "left_semi").select(*df.columns).write.parquet(f"{self.path}/busy-rows")
        calm = rows.join(busy, self.keys, "left_anti").select(*df.columns).repartition(self.buckets, *self.keys)
        writer = calm.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys, self.ts).option("path", f"{self.path}/rows")
        writer.saveAsTable(self.name)

    @property
    def _busy(self) -> str:
        return f"{self.path}/busy-keys"

    def bucketed(self) -> DataFrame:
        """The rows in buckets: all but those of busy keys."""
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self.bucketed().unionByName(self.spark.read.parquet(f"{self.path}/busy-rows"))

    def lookup(self, labels: DataFrame, keys: Mapping[str, str], label_ts: str, names: Sequence[str]) -> DataFrame:
        """What ``point_in_time`` gives on the whole table; ``keys`` maps label column to table column."""
        if sorted(keys.values()) != sorted(self.keys):
            raise ValueError(f"the table is bucketed by {self.keys}")
        by = {t: k for k, t in keys.items()}
        keys = {by[t]: t for t in self.keys}
        apart = self._apart(labels, list(keys))
        if apart is None:
            return self._calm(labels, keys, label_ts, names)
        on = [labels[k] == apart[a] for k, a in zip(keys, apart.columns)]
        calm, busy = labels.join(apart, on, "left_anti"), labels.join(apart, on, "left_semi")
        table = self.read()
        rows = table.join(apart, [table[t] == apart[a] for t, a in zip(self.keys, apart.columns)], "left_semi")
        edges = tile_edges((busy, list(keys), label_ts), (rows, self.keys, self.ts), rows_per_task=self.rows_per_task)
        tiled = point_in_time(busy, rows, keys, label_ts, self.ts, names, None, edges)
        return self._calm(calm, keys, label_ts, names).unionByName(tiled)

    def _calm(self, labels: DataFrame, keys: Mapping[str, str], label_ts: str, names: Sequence[str]) -> DataFrame:
        """Labels go to the buckets; keys of another type than the table's hash differently, so both sides move then."""
        rows = self.bucketed()
        here, there = dict(labels.dtypes), dict(rows.dtypes)
        alike = all(here[k] == there[t] for k, t in keys.items())
        return point_in_time(labels, rows, keys, label_ts, self.ts, names, buckets=self.buckets if alike else None)

    def _apart(self, labels: DataFrame, keys: list[str]) -> DataFrame | None:
        """Keys to be looked up in tiles: busy in the table or among the labels. None where there are none."""
        names = [f"_a{i}" for i in range(len(keys))]
        shape = T.StructType([T.StructField(n, self.bucketed().schema[k].dataType) for n, k in zip(names, self.keys)])
        stored = self.spark.read.schema(T.StructType([T.StructField(k, f.dataType) for k, f in zip(self.keys, shape.fields)]))
        here = labels.select(*[F.col(k).alias(n) for n, k in zip(names, keys)]).dropna()
        here = here.groupBy(*names).agg(F.count("*").alias("_n")).filter(F.col("_n") > self.rows_per_task)
        here = here.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in shape.fields])
        path = scratch_path(self.spark, "busy")
        stored.parquet(self._busy).toDF(*names).unionByName(here).dropna().distinct().write.parquet(path)
        found = self.spark.read.schema(shape).parquet(path)
        return None if found.isEmpty() else found
