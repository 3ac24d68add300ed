"""Rolling sums and counts over the last N seconds per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lookup import ROWS_PER_TASK

DAY = 86_400
FRAME_ROWS = 500


@dataclass(frozen=True)
class Rolling:
    """One rolling column: the sum of ``column``, or the number of rows if it is None."""

    name: str
    column: str | None
    seconds: int


def frame_load(df: DataFrame, keys: Sequence[str], second: str, seconds: int) -> tuple[float, int]:
    """Mean rows in a frame, estimated on fixed tiles, and rows of the largest key; one row to the driver."""
    tiles = df.groupBy(*keys, F.floor(F.col(second) / seconds).alias("_t")).agg(F.count("*").alias("n"))
    per_key = tiles.groupBy(*keys).agg(
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"), F.sum("n").alias("n")
    )
    got = per_key.agg((F.sum("squares") / F.sum("n")).alias("mean"), F.max("n").alias("largest")).first()
    return (got["mean"] or 0.0, got["largest"] or 0)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    second: str,
    specs: Sequence[Rolling],
    strategy: str = "auto",
    exclude_current: bool = False,
) -> DataFrame:
    """Add each rolling column; frames hold [second - seconds, second] with all peers of a second.

    A range window re-adds its whole frame for every row, which is cheapest while frames are
    short. ``auto`` measures the frames and turns to running totals where they are long or where
    one key is too big for a task; the answer is the same but for the order in which doubles are added.
    ``exclude_current`` leaves the row's own second out. Rows without a time form a frame of their own.
    """
    if strategy == "auto":
        mean, largest = frame_load(df, keys, second, max(s.seconds for s in specs))
        strategy = "frames" if mean <= FRAME_ROWS and largest <= ROWS_PER_TASK else "totals"
    if strategy == "frames":
        return _by_frames(df, keys, second, specs, exclude_current)
    if strategy == "totals":
        return _by_totals(df, keys, second, specs, exclude_current)
    raise ValueError(f"unknown strategy {strategy!r}")


def _by_frames(df, keys, second, specs, exclude_current):
    ordered = Window.partitionBy(*keys).orderBy(second)
    end = -1 if exclude_current else 0
    columns = {}
    for s in specs:
        agg = F.count("*") if s.column is None else F.sum(s.column)
        columns[s.name] = agg.over(ordered.rangeBetween(-s.seconds, end))
    return df.withColumns(columns)


def _by_totals(df, keys, second, specs, exclude_current):
    """A frame is the end of one block of its own length and the beginning of the next.

    So its sum is a running total from the block's begin plus one from the last block's end: values are only ever added,
    never taken back, and whatever ``sum`` does with decimals, NaN, infinities and tiny amounts holds here
    too. Rows of a second are combined first, so a block has at most one row a second however many rows a key holds.
    """
    keys, columns = list(keys), sorted({s.column for s in specs if s.column is not None})
    kinds = dict(df.select(*[F.sum(c).alias(c) for c in columns]).dtypes) if columns else {}
    totals = {"n": "bigint"} | {f"v{i}": kinds[c] for i, c in enumerate(columns)}
    ends = F.col("_t") - 1 if exclude_current else F.col("_t")
    sums = [F.sum(c).alias(f"v{i}") for i, c in enumerate(columns)]
    seconds = df.groupBy(*keys, F.col(second).cast("long").alias("_t")).agg(F.count("*").alias("n"), *sums)

    def row(at, kind, owner, filled):
        cells = [(F.col(n) if filled else F.lit(None)).cast(t).alias(n) for n, t in totals.items()]
        return F.struct(at.cast("long").alias("at"), F.lit(kind).alias("kind"), owner.cast("long").alias("owner"), *cells)

    joined = df
    for span in sorted({s.seconds for s in specs}):
        width = span + (0 if exclude_current else 1)
        if width < 1:
            raise ValueError("a frame needs a second at least")
        starts = ends - (width - 1)
        block = F.floor(F.col("at") / F.lit(width))
        # the last block's end only counts where the frame begins in it
        crosses = F.floor(starts / F.lit(width)) < F.floor(ends / F.lit(width))
        none = F.lit(None)
        rows = F.array_compact(F.array(
            row(F.col("_t"), "row", none, True), row(ends, "upto", F.col("_t"), False), F.when(crosses, row(starts, "from", F.col("_t"), False))
        ))
        steps = seconds.select(*keys, F.inline(rows)).withColumn("_block", block)
        whole = Window.partitionBy(*keys, "_block")
        upto = whole.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        since = whole.orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        found = steps.withColumns({f"a_{n}": F.sum(n).over(upto) for n in totals}).withColumns({f"b_{n}": F.sum(n).over(since) for n in totals})
        found = found.filter("kind <> 'row'")
        part = [F.when(F.col("kind") == "upto", F.col(f"a_{n}")).otherwise(F.col(f"b_{n}")).alias(n) for n in totals]
        names = [F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)]
        frames = found.select(*names, "owner", *part).groupBy(*[f"_k{j}" for j in range(len(keys))], "owner")
        frames = frames.agg(*[F.sum(n).cast(t).alias(f"_{n}") for n, t in totals.items()])
        same = [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)]
        out = {}
        for s in specs:
            if s.seconds == span:
                out[s.name] = F.coalesce("_n", F.lit(0).cast("long")) if s.column is None else F.col(f"_v{columns.index(s.column)}")
        kept = [c for c in joined.columns if c not in out]
        joined = joined.join(frames, [*same, F.col(second).cast("long").eqNullSafe(F.col("owner"))], "left").withColumns(out)
        joined = joined.select(*kept, *out)
    return joined.select(*df.columns, *[s.name for s in specs])
