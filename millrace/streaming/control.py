"""Streams under a common name, handled together and always with a deadline."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class StreamGroup:
    """The running streams whose names begin with ``prefix``; all running streams if it is empty."""

    spark: SparkSession
    prefix: str = ""

    def running(self) -> dict[str, StreamingQuery]:
        """By name, or by id where a stream has none."""
        named = {q.name or str(q.id): q for q in self.spark.streams.active}
        return {name: q for name, q in named.items() if name.startswith(self.prefix)}

    def wait(self, timeout: float = 600) -> None:
        """Wait until every stream has ended; a failed stream raises, so does the deadline."""
        deadline = time.monotonic() + timeout
        for name, q in self.running().items():
            left = deadline - time.monotonic()
            if left <= 0 or not q.awaitTermination(max(1, int(left))):
                raise TimeoutError(f"stream {name} still active")

    def end(self, timeout: float = 600) -> int:
        """Stop the streams between two micro-batches and wait until they are gone; says how many there were."""
        ending = self.running()
        for q in ending.values():
            q.stop()
        self.wait(timeout)
        return len(ending)


def drain_and_stop(query: StreamingQuery) -> None:
    """Process what is there, then stop; for sources that come to rest, such as folders and tables."""
    query.processAllAvailable()
    query.stop()
