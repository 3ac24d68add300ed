"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target divided by the source's size. Within a source, documents stand
in order of size; their expected copies are summed up from one random offset, and a copy goes out for every
integer that the sum crosses. Documents of one size thus differ by one copy at most, and totals stay near the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, n_words, whole
from millrace.session import parallelism

KEY_BITS = 60


def targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """(src, source_size, target) from (src, source_size); ``src`` sorts like the source's code points, null last.

    Sources take the weights in turn. ``share`` of all sizes is dealt by weight; a target stops at ``limit`` times
    its source's size and the excess goes to the others by weight. That is one level per unit of weight: sources are
    taken by room per weight, and the level is what is left over for those not yet full. One row per source passes
    one task here, never documents.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy("src")) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.select("src", "source_size", weight.alias("weight")).withColumn("room", F.col("source_size") * F.lit(float(limit)))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "src")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    since = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(since)
    rows = rows.withColumn("level", level)
    # the first source that is not filled sets the level; later ones would set lower levels
    found = F.max(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level"))).over(everything)
    target = F.least(F.col("room"), F.col("weight") * F.coalesce(found, F.lit(float("inf"))))
    return rows.select("src", "source_size", target.alias("target"))


def _number(*parts: Column) -> Column:
    """A number of KEY_BITS bits drawn from the parts, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, KEY_BITS // 4), 16, 10).cast("long")


def copies(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: int = 42, size: Column | None = None
) -> DataFrame:
    """Every row, as a struct ``row``, with size, source_size, target and copies (how often the mix takes it).

    ``size`` defaults to the number of words; a null text has none. Documents without size take part in the draw like
    others. Sources are plain strings, null being one too. Documents stand in order of size, then of a number drawn
    from ``seed`` and doc_id; rows equal in all that are interchangeable. No copies exceed ``limit`` rounded up.
    """
    size = n_words(whole("text")) if size is None else size
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col("source").cast("string")
    src = F.when(text.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), text)).alias("src")
    # parts of a (source, size) by leading bits of the drawn number: how many parts does not change the order
    bits = min(20, (8 * parallelism(docs.sparkSession)).bit_length())
    rows = docs.select(row, src, size.alias("size"), _number(F.lit(seed), F.col("doc_id").cast("string")).alias("key"))
    rows = rows.withColumn("tile", F.shiftright("key", KEY_BITS - bits))
    tiles = rows.groupBy("src", "size", "tile").agg(F.count("*").alias("n"))
    sizes = tiles.groupBy("src", "size").agg(F.sum("n").alias("n"))
    totals = sizes.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    goal = targets(totals, weights, share, limit)
    smaller = F.sum("n").over(Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    lower = F.sum("n").over(Window.partitionBy("src", "size").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1))
    by_size = sizes.select("src", "size", F.coalesce(smaller, F.lit(0)).alias("smaller")).join(goal, "src")
    starts = tiles.select("src", "size", "tile", F.coalesce(lower, F.lit(0)).alias("lower")).join(by_size, ["src", "size"])
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy("src", "size", "tile").orderBy("key", "row.doc_id")))
    found = numbered.join(starts, ["src", "size", "tile"])
    offset = _number(F.lit(seed), F.lit("offset"), F.col("src")) / F.lit(float(1 << KEY_BITS))
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    upto = F.col("smaller") + F.col("lower") + F.col("nth")
    crossed = F.floor(upto * rate + offset) - F.floor((upto - 1) * rate + offset)
    taken = F.least(crossed, F.lit(-int(-limit // 1)).cast("long")).cast("long")
    return found.select("row", "size", "source_size", "target", taken.alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as taken, with their own columns."""
    times = fresh(docs, "_nth")[0]
    rows = copies(docs, **options).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(times)).select("row.*")


#: The query over ``documents`` in another engine.
SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', '42', doc_id::VARCHAR)), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight,
         source_size * 2::DOUBLE AS room
  FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(room) OVER (
               ORDER BY room / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
           / sum(weight) OVER (ORDER BY room / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT src, source_size,
         least(room, weight * coalesce(max(CASE WHEN level * weight <= room THEN level END) OVER (), 'infinity'::DOUBLE)) AS target
  FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY size, key, doc_id) AS nth FROM d),
c AS (
  SELECT doc_id, size, source_size, target, nth,
         CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END::DOUBLE AS rate,
         ('0x' || substr(md5(concat_ws(':', '42', 'offset', src)), 1, 15))::BIGINT / 1152921504606846976::DOUBLE AS start
  FROM n JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       size * least(floor(nth * rate + start) - floor((nth - 1) * rate + start), 2)::BIGINT AS taken
FROM c"""
