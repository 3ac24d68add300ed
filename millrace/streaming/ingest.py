"""File streams into bronze and silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import parse_ts

RESCUED = "_rescued_data"


def hinted_schema(spark: SparkSession, folder: str, fmt: str, hints: str, sample: float = 1.0) -> T.StructType:
    """Columns as found in the files that are there, with the hinted types where given.

    Run again before a restart, it lets new columns in: the bronze table is read with merged schemas.
    """
    reader = spark.read.format(fmt).option("samplingRatio", sample)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    wanted = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    found = [f for f in reader.load(folder).schema.fields if f.name != "_corrupt_record"]
    fields = [wanted.pop(f.name, f) for f in found]
    return T.StructType([*fields, *wanted.values()])


def read_folder(
    spark: SparkSession, folder: str, fmt: str, schema: str | T.StructType, max_files: int | None = None
) -> DataFrame:
    """A folder of files as a stream; what does not fit the schema lands in ``_rescued_data``.

    That is the whole line if it cannot be read by the schema, and, for JSON lines, an object of the fields that the
    schema does not name. CSV lines with more or fewer cells than the schema are kept whole. ``max_files`` caps the
    files of one micro-batch.
    """
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        return _json_lines(reader.format("text").load(folder), shape)
    if fmt == "csv":
        shape = shape.add(RESCUED, "string")
        reader = reader.option("columnNameOfCorruptRecord", RESCUED).option("mode", "PERMISSIVE").option("header", True)
    return reader.format(fmt).schema(shape).load(folder)


def _json_lines(lines: DataFrame, shape: T.StructType) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}
    known = F.array(*[F.lit(n) for n in shape.fieldNames()]).cast("array<string>")
    row = F.from_json("value", T.StructType([*shape.fields, T.StructField(RESCUED, T.StringType())]), options)
    others = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~F.array_contains(known, k))
    read = lines.filter(F.trim("value") != "").select(row.alias("r"), others.alias("others"))
    rescued = F.coalesce(F.col(f"r.{RESCUED}"), F.when(F.size("others") > 0, F.to_json("others")))
    return read.select(*[F.col("r")[n].alias(n) for n in shape.fieldNames()], rescued.alias(RESCUED))


def append_stream(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once; by default it stops when it has caught up."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def ingest_folder(
    spark: SparkSession,
    folder: str,
    fmt: str,
    schema: str | T.StructType,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Landing files to a bronze table."""
    return append_stream(read_folder(spark, folder, fmt, schema, max_files), table, checkpoint, name)


def read_table_stream(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(table)


def refine_table(
    spark: SparkSession,
    bronze: str,
    schema: T.StructType,
    change: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    name: str | None = None,
) -> StreamingQuery:
    """Bronze to silver: the same row-wise function serves the stream and a batch table."""
    return append_stream(change(read_table_stream(spark, bronze, schema)), table, checkpoint, name)


@dataclass(frozen=True)
class Refinement:
    """What is done to the columns of a bronze table; names are those in it."""

    hashed: Sequence[str] = ()
    capitalised: Sequence[str] = ()
    times: Mapping[str, Sequence[str]] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    renamed: Mapping[str, str] = field(default_factory=dict)
    dropped: Sequence[str] = (RESCUED,)

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.select(*[self._column(c) for c in df.columns if c not in self.dropped])

    def _column(self, name: str) -> Column:
        out = F.col(name)
        if name in self.hashed:
            out = F.sha1(out)
        if name in self.capitalised:
            out = F.initcap(out)
        if name in self.times:
            out = parse_ts(out, self.times[name])
        if name in self.casts:
            out = out.cast(self.casts[name])
        return out.alias(self.renamed.get(name, name))
