"""Windowed profiles of a stream."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def windowed_profile(df: DataFrame, ts: str, width: str, delay: str, value: str, slices: Sequence[str]) -> DataFrame:
    """Count, sum, extremes and mean per window and slice; rows later than ``delay`` are dropped by the watermark.

    The same function profiles a batch table, where the watermark has no effect.
    """
    marked = df.withWatermark(ts, delay)
    out = marked.groupBy(F.window(ts, width), *slices).agg(
        F.count("*").alias("count"),
        F.sum(value).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("avg"),
    )
    return out.select(F.col("window.start").alias("window_start"), *slices, "count", "sum", "min", "max", "avg")


class LateRows(StreamingQueryListener):
    """Counts, from every progress report, the rows that watermarks turn away; add it before the streams start.

    A query itself keeps its newest reports only.
    """

    def __init__(self) -> None:
        self.dropped: Counter = Counter()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def of(self, query: StreamingQuery, timeout: float = 30) -> int:
        """Rows turned away so far; of a query that has ended all of them, its last report being waited for."""
        until = time.monotonic() + timeout
        while not query.isActive and str(query.id) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError("no report of the end of the stream")
            time.sleep(0.05)
        return self.dropped[str(query.id)]
