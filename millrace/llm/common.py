"""What the training-data operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import prepare, scratch_path

# Workers need no copy of the package: functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def text_session(spark: SparkSession) -> SparkSession:
    """The session with what these operators need: long texts go to workers in batches of a few MB."""
    return prepare(spark)


def whole(column: str | Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later steps read it, lost tasks are not repeated from the start."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none is a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Inside tasks


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column after one another, and where each text starts (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def kept_in_process(key: tuple, make: Callable):
    """What ``make`` gives, kept for later tasks of the same worker process. Only for things of bounded size."""
    kept = sys.modules.setdefault("_millrace_kept", ModuleType("_millrace_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] numbers), then the same of the next entry."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, counts)


def in_batches(batches: Iterable[pa.RecordBatch], mb: int, column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many MB of the text column, one row at least."""
    for batch in batches:
        _, at = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + mb * 1_000_000, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop
