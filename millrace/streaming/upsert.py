"""Streaming upserts into plain Parquet: a folder for each micro-batch, the newest row per key by one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.changes import latest_per_key


def write_batch(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], batch_id: int) -> None:
    """One batch's rows below ``path``, of rows equal in key and order the largest; a batch that runs again replaces itself."""
    named = [*keys, *order]
    rest = [c for c in df.columns if c not in named]
    rows = df.groupBy(*named).agg(F.max(F.struct(*rest)).alias("_rest")) if rest else df.select(*named).distinct()
    rows = rows.select(*[F.col(f"_rest.{c}").alias(c) if c in rest else c for c in df.columns])
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every row written so far, with the batch it came in; none before the first batch."""
    shape = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(shape).option("basePath", path).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], shape)


def newest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key; a late row never replaces a newer one."""
    return latest_per_key(batches(spark, path, schema), keys, [*order, "batch"]).drop("batch")


def upsert_stream(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    output_mode: str = "append",
    publish: tuple[str, Sequence[str], Sequence[str]] | None = None,
) -> StreamingQuery:
    """Write a stream's batches below ``path``, by default until it has caught up; read them by ``newest``.

    With ``publish``, a path with keys and order, each batch also writes its newest row of each key there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if publish is None:
            write_batch(batch, path, keys, order, batch_id)
            return
        batch.persist()  # it is written twice
        try:
            write_batch(batch, path, keys, order, batch_id)
            served, by, along = publish
            write_batch(latest_per_key(batch, by, along) if along else batch, served, by, along, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
