"""Named feature tables: Parquet versions plus a small register of specs.

A write lands in a new folder and becomes visible by one register row, so a failed job leaves the
old version in place.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.changes import latest_per_key, merge_upsert, pk_violations, unique_rows
from millrace.operators.lookup import FeatureLookup, TrainingSet
from millrace.sources.parted import PartedTable
from millrace.sources.register import Register
from millrace.streaming.upsert import batches, newest, upsert_stream

#: Models share the register of the tables under names of their own.
MODELS = "model:"


@dataclass(frozen=True)
class FeatureTable:
    """What is known about a feature table besides its rows."""

    name: str
    primary_keys: tuple[str, ...]
    timestamp_keys: tuple[str, ...] = ()
    description: str = ""
    tags: Mapping[str, str] = field(default_factory=dict)
    schema: str = ""
    stream: str = ""
    parts: int = 0

    @property
    def row_keys(self) -> list[str]:
        """Columns that together name one row: the keys plus the time, if any."""
        return [*self.primary_keys, *self.timestamp_keys]

    @property
    def shape(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _names(value: Sequence[str] | str | None) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


class FeatureStore:
    """Feature tables below one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.register = spark, Register(spark, root)

    def create_table(
        self,
        name: str,
        primary_keys: Sequence[str] | str,
        timestamp_keys: Sequence[str] | str | None = None,
        df: DataFrame | None = None,
        schema: T.StructType | None = None,
        description: str = "",
        tags: Mapping[str, str] | None = None,
        parts: int = 0,
    ) -> FeatureTable:
        """Register a table from rows or from a schema alone; rows are written at once.

        With ``parts`` rows lie in so many folders by row key, and a merge rewrites only the folders it touches, in place.
        """
        if df is None and schema is None:
            raise ValueError("give df or schema")
        if self.register.find(name) is not None:
            raise ValueError(f"feature table {name!r} exists")
        shape = schema or df.schema
        table = FeatureTable(
            name, _names(primary_keys), _names(timestamp_keys), description, dict(tags or {}), shape.json(), parts=parts
        )
        missing = [k for k in table.row_keys if k not in shape.fieldNames()]
        if missing:
            raise ValueError(f"key columns missing: {missing}")
        rows = df if df is not None else self.spark.createDataFrame([], shape)
        self._publish(table, rows if table.parts else unique_rows(rows, table.row_keys))
        return table

    def get_table(self, name: str) -> FeatureTable:
        row = self.register.require(name)
        spec = json.loads(row["spec"])
        spec["primary_keys"], spec["timestamp_keys"] = tuple(spec["primary_keys"]), tuple(spec["timestamp_keys"])
        return FeatureTable(**spec)

    def read_table(self, name: str) -> DataFrame:
        """All rows; where a stream feeds the table, its newest version of each row."""
        row, table = self.register.require(name), self.get_table(name)
        if table.parts:
            base = self._parted(table, row["folder"]).read()
        else:
            base = self.spark.read.schema(table.shape).parquet(row["folder"])
        if not table.stream:
            return base
        fed = batches(self.spark, table.stream, table.shape)
        every = fed.unionByName(base.withColumn("batch", F.lit(-1).cast("long")))
        return latest_per_key(every, table.row_keys, ["batch"]).drop("batch")

    def write_table(self, name: str, df: DataFrame, mode: str = "merge") -> None:
        """``overwrite`` replaces all rows, ``merge`` replaces rows of equal keys and adds the rest."""
        table = self.get_table(name)
        if table.stream:
            raise ValueError(f"{name!r} is fed by a stream")
        rows = self._fit(table, df)
        if mode == "merge" and table.parts:
            self._parted(table, self.register.require(name)["folder"]).merge(rows)
            return
        if mode == "merge":
            rows = merge_upsert(self.read_table(name), rows, table.row_keys)
        elif mode == "overwrite":
            rows = rows if table.parts else unique_rows(rows, table.row_keys)
        else:
            raise ValueError(f"unknown mode {mode!r}")
        self._publish(table, rows)

    def write_stream(
        self, name: str, df: DataFrame, checkpoint: str, trigger: dict | None = None, publish: str | None = None
    ) -> StreamingQuery:
        """Merge a stream into the table; a batch writes its own rows only. Lookups see all times kept.

        With ``publish`` each batch also sends its newest row of every primary key to a serving table there.
        """
        row, table = self.register.require(name), self.get_table(name)
        if not table.stream:
            table = replace(table, stream=self.register.new_folder(name))
            self.register.put(name, json.dumps(asdict(table)), row["folder"])
        serving = (publish, table.primary_keys, table.timestamp_keys) if publish else None
        return upsert_stream(self._fit(table, df), table.stream, table.row_keys, (), checkpoint, f"feed_{name}", trigger, publish=serving)

    def read_published(self, name: str, path: str) -> DataFrame:
        """The newest row of every primary key that a stream has published."""
        table = self.get_table(name)
        return newest(self.spark, path, table.shape, table.primary_keys, table.timestamp_keys)

    def violations(self, name: str) -> DataFrame:
        return pk_violations(self.read_table(name), self.get_table(name).row_keys)

    def drop_table(self, name: str) -> None:
        self.register.drop(name)

    def publish_table(self, name: str, path: str) -> DataFrame:
        """Write the serving snapshot, the newest row of every key, and return it."""
        snapshot = serving_snapshot(self.read_table(name), self.get_table(name))
        snapshot.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(snapshot.schema).parquet(path)

    def list_tables(self) -> list[str]:
        return [n for n in self.register.names() if not n.startswith(MODELS)]

    def create_training_set(
        self,
        labels: DataFrame,
        lookups: Sequence[FeatureLookup],
        label: str | None = None,
        exclude_columns: Sequence[str] = (),
    ) -> TrainingSet:
        """Training set on tables of the store by name; their registered keys and times are used."""
        return TrainingSet(labels, tuple(lookups), label, tuple(exclude_columns), self._lookup)

    def log_model(self, name: str, training_set: TrainingSet, expression: str, result_type: str = "double") -> None:
        """Keep a model with the lookups that feed it: ``expression`` is SQL over the columns of the training set."""
        lookups = [asdict(spec) for spec in training_set.lookups]
        kept = {"lookups": lookups, "exclude": list(training_set.exclude_columns), "expression": expression, "type": result_type}
        self.register.put(MODELS + name, json.dumps(kept), None)

    def score_batch(self, name: str, keys: DataFrame) -> DataFrame:
        """Repeat a model's lookups for rows of keys and add its prediction; features stay in the output."""
        kept = json.loads(self.register.require(MODELS + name)["spec"])
        lookups = [FeatureLookup(**spec) for spec in kept["lookups"]]
        rows = self.create_training_set(keys, lookups, None, kept["exclude"]).load_df()
        return rows.withColumn("prediction", F.expr(kept["expression"]).cast(kept["type"]))

    def _lookup(self, spec: FeatureLookup) -> tuple[DataFrame, list[str], str | None]:
        table = self.get_table(spec.table_name)
        return self.read_table(spec.table_name), list(table.primary_keys), next(iter(table.timestamp_keys), None)

    def _fit(self, table: FeatureTable, df: DataFrame) -> DataFrame:
        """The table's columns in its order and types; missing ones are an error."""
        absent = [f for f in table.shape.fieldNames() if f not in df.columns]
        if absent:
            raise ValueError(f"columns missing for {table.name!r}: {absent}")
        return df.select(*[F.col(f.name).cast(f.dataType) for f in table.shape.fields])

    def _parted(self, table: FeatureTable, folder: str) -> PartedTable:
        return PartedTable(self.spark, folder, table.shape, table.row_keys, table.parts)

    def _publish(self, table: FeatureTable, rows: DataFrame) -> None:
        folder = self.register.new_folder(table.name)
        if table.parts:
            self._parted(table, folder).create(rows)
        else:
            rows.write.parquet(folder)
        self.register.put(table.name, json.dumps(asdict(table)), folder)


def serving_snapshot(df: DataFrame, table: FeatureTable) -> DataFrame:
    """The newest row of every primary key."""
    if not table.timestamp_keys:
        return df
    return latest_per_key(df, table.primary_keys, table.timestamp_keys)
