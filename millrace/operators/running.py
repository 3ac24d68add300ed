"""Running totals, ranks and exact quantiles over groups too large for one task.

A plain window puts a whole group into one task. Here the order column is cut into tiles;
each tile is totalled first (with map-side combine), the few tile totals are accumulated per
group, and every tile then starts from its own carried-in total. No group larger than a tile
is ever sorted by one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import parallelism

TILE = "_tile"


def split_points(
    df: DataFrame, columns: Sequence[str], tiles: int | None = None, sample: float = 0.01
) -> dict[str, list[float]]:
    """Cut points that share the rows of each numeric column out about evenly.

    Estimated on a sample, since the cuts only balance the work: every row is still counted and
    results do not depend on where the cuts fall. The driver receives fewer than ``tiles`` numbers
    per column.
    """
    tiles = tiles or max(2, parallelism(df.sparkSession))
    probs = [i / tiles for i in range(1, tiles)]
    rows = df.select(*columns) if sample >= 1 else df.select(*columns).sample(sample, seed=7)
    cuts = [F.percentile_approx(F.col(c).cast("double"), probs, 8 * tiles).alias(f"_{i}") for i, c in enumerate(columns)]
    found = rows.agg(*cuts).first()
    return {c: sorted({x for x in found[i] or [] if x == x}) for i, c in enumerate(columns)}


def with_tile(df: DataFrame, column: str, cuts: Sequence[float], tile: str = TILE) -> DataFrame:
    """Number the tile of each value; nulls and NaN go to a tile of their own after the rest."""
    inf = float("inf")
    splits = [-inf, *[c for c in cuts if abs(c) != inf], inf]
    if len(splits) < 3:
        return df.withColumn(tile, F.when(F.col(column).isNull(), 1.0).otherwise(0.0))
    return Bucketizer(splits=splits, inputCol=column, outputCol=tile, handleInvalid="keep").transform(df)


def hash_tile(hashed: Column, tiles: int, width: int = 64) -> Column:
    """Tile of a hash of ``width`` bits by its leading bits, at least so many tiles: even by construction."""
    return F.shiftright(hashed, width - min(30, max(12, (tiles - 1).bit_length())))


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    tile: str = TILE,
    tile_descending: bool = False,
) -> DataFrame:
    """Add, per entry of ``sums``, its inclusive running total and ``<name>_total`` of the group.

    Rows equal in ``order`` are peers and get the same total. ``tile`` must be a column that
    never decreases along ``order`` (never increases, with ``tile_descending``).
    """
    by = list(by)
    rows = df.select("*", *[(F.col(e) if isinstance(e, str) else e).alias(f"_in_{n}") for n, e in sums.items()])
    tiles = rows.groupBy(*by, tile).agg(*[F.sum(f"_in_{n}").alias(f"_in_{n}") for n in sums])
    along = F.desc(tile) if tile_descending else F.asc(tile)
    whole = Window.partitionBy(*by)
    before = whole.orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    carry = tiles.select(
        *by,
        tile,
        F.lit(True).alias("_carry"),
        *[F.sum(f"_in_{n}").over(before).alias(f"_in_{n}") for n in sums],
        *[F.sum(f"_in_{n}").over(whole).alias(f"{n}_total") for n in sums],
    )
    keys = [F.expr(o) if isinstance(o, str) else o for o in order]
    inside = Window.partitionBy(*by, tile).orderBy(F.desc("_carry"), *keys)
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    kept = [c for c in df.columns if c not in sums]
    return (
        both.select(
            *kept,
            "_carry",
            *[F.sum(f"_in_{n}").over(upto).alias(n) for n in sums],
            # The carried row comes first, so its group total has been seen by every row.
            *[F.max(f"{n}_total").over(upto).alias(f"{n}_total") for n in sums],
        )
        .filter(~F.col("_carry"))
        .drop("_carry")
    )


def hash_rank(df: DataFrame, by: Sequence[str], hashed: Column, key: Column, name: str = "rank", width: int = 64) -> DataFrame:
    """Exact 1-based position of each row inside its group in hash order, and ``<name>_total``.

    ``key`` must be unique inside a group; it settles equal hashes.
    """
    tiles = 16 * parallelism(df.sparkSession)
    rows = df.select("*", hashed.alias("_hash"), key.alias("_key")).withColumn(TILE, hash_tile(F.col("_hash"), tiles, width))
    ranked = running_totals(rows, by, ["_hash", "_key"], {name: F.lit(1)})
    return ranked.drop("_hash", "_key", TILE)


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    weight: str | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group, one output column per entry of ``probs``.

    Equal values are counted before they move, so repeated values cost one row per task.
    Nulls are ignored. ``weight`` says how often a row counts.
    """
    by = list(by)
    if cuts is None:
        cuts = split_points(df, [value])[value]
    n = F.sum(weight) if weight else F.count("*")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("_n"))
    ranked = running_totals(with_tile(counts, value, cuts), by, [value], {"_upto": "_n"})
    return pick_quantiles(ranked, by, value, "_n", "_upto", probs)


def pick_quantiles(
    ranked: DataFrame, by: Sequence[str], value: str, n: str, upto: str, probs: Mapping[str, float]
) -> DataFrame:
    """Read quantiles off counted values that already carry their running total."""
    picks = []
    for name, p in probs.items():
        at = (F.col(f"{upto}_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col(upto) > rank) & (F.col(upto) - F.col(n) <= rank)
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_part"))
    out = [
        (F.col(f"_{k}_lo") + (F.col(f"_{k}_hi") - F.col(f"_{k}_lo")) * F.col(f"_{k}_part")).alias(k) for k in probs
    ]
    return ranked.groupBy(*by).agg(*picks).select(*by, *out)
