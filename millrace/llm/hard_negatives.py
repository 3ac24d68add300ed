"""Hard negatives: rows of another label whose score lies in a window below an anchor's positives.

Anchors are tied to a spanning tree of least distances. A candidate's score at a parent anchor, plus and minus the length
of the edge times the candidate's norm, bounds its score at the child, so only candidates whose bounds reach into a window
are scored anew; bounds of the others go on to the child's own children.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.topk import from_bytes, scores, to_bytes
from millrace.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Anchors of a tree, bytes of a tile of candidates, and the anchors whose lists one task keeps.
TREE, TILE_BYTES, KEPT = 256, 2_000_000, 16_384
#: Sums of products below this are exact in doubles.
EXACT = 2**53


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(id, label, v) with components floor(scale * x); rows lacking an id, a label or a finite component go."""
    v = F.col("v").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(v, lambda c: c * float(scale) - F.pmod(c * float(scale), F.lit(1.0)))
    rows = vectors.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(finite)
    return rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


# Tiles


def _matrix(lists: list[np.ndarray]) -> tuple[bytes, int]:
    """Vectors under one another, shorter ones filled up with zeros, in the narrowest numbers that hold them."""
    dim = max(map(len, lists))
    out = np.zeros((len(lists), dim))
    for row, v in zip(out, lists):
        row[: len(v)] = v
    return to_bytes(out), dim


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which points join a least spanning tree, the parent of each (-1 for the first) and the length of its edge."""
    n = len(points)
    square = (points**2).sum(1)
    order, parent, length = np.zeros(n, np.int32), np.full(n, -1, np.int32), np.zeros(n)
    near, far = np.full(n, -1, np.int32), np.full(n, np.inf)
    left = np.ones(n, bool)
    at = 0
    for i in range(n):
        order[i], parent[at], left[at] = at, near[at], False
        if near[at] >= 0:
            length[at] = np.sqrt(((points[at] - points[near[at]]) ** 2).sum())
        distance = np.maximum(square + square[at] - 2 * (points @ points[at]), 0)
        closer = left & (distance < far)
        far[closer], near[closer] = distance[closer], at
        if i + 1 < n:
            at = int(np.where(left, far, np.inf).argmin()) if np.isfinite(far[left]).any() else int(left.argmax())
    return order, parent, length


CANDIDATES = "ids binary, labels binary, body binary, dim int, n int"
ANCHORS = "tile long, block long, a_ids binary, a_labels binary, a_body binary, a_dim int, a_n int, windows binary"


def candidate_tiles(rows: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            start = 0
            while start < len(ids):
                size = max(1, TILE_BYTES // (8 * max(1, len(at[start]))))
                part = [np.asarray(v, np.float64) for v in at[start : start + size]]
                body, dim = _matrix(part)
                n = len(part)
                yield pa.RecordBatch.from_pylist([{
                    "ids": ids[start : start + n].astype(np.int64).tobytes(), "labels": labels[start : start + n].astype(np.int64).tobytes(),
                    "body": body, "dim": dim, "n": n,
                }], pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("body", pa.binary()), ("dim", pa.int32()), ("n", pa.int32())]))
                start += n

    return rows.select("id", "label", "v").mapInArrow(run, CANDIDATES)


def anchor_tiles(rows: DataFrame) -> DataFrame:
    """(id, label, v, block, windows) in tiles of one block and mostly of one label, so that trees have short edges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        made = 0

        def tile() -> pa.RecordBatch:
            nonlocal made
            body, dim = _matrix([np.asarray(r["v"], np.float64) for r in held])
            windows = np.array([r["windows"] for r in held], np.int64)
            made += 1
            return pa.RecordBatch.from_pylist([{
                "tile": (TaskContext.get().partitionId() << 32) + made, "block": held[0]["block"],
                "a_ids": np.array([r["id"] for r in held], np.int64).tobytes(), "a_labels": np.array([r["label"] for r in held], np.int64).tobytes(),
                "a_body": body, "a_dim": dim, "a_n": len(held), "windows": windows.tobytes(),
            }], pa.schema([
                ("tile", pa.int64()), ("block", pa.int64()), ("a_ids", pa.binary()), ("a_labels", pa.binary()), ("a_body", pa.binary()),
                ("a_dim", pa.int32()), ("a_n", pa.int32()), ("windows", pa.binary()),
            ]))

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == TREE or row["block"] != held[0]["block"]):
                    yield tile()
                    held = []
                held.append(row)
        if held:
            yield tile()

    near = rows.repartition("block").sortWithinPartitions("block", "label", "id")
    return near.select("id", "label", "v", "block", "windows").mapInArrow(run, ANCHORS)


# Scores of a tile of anchors against a tile of candidates


def tree_scores(
    anchors: np.ndarray, tree: tuple, candidates: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor, parents first, the places and exact scores of the candidates that ``wanted(anchor, low, high)`` marks.

    ``low`` and ``high`` bound the candidates' scores at the anchor. Where sums leave the range in which doubles are
    exact, nothing is bounded and all candidates are scored in whole numbers, those beyond a long at its bounds.
    """
    dim = min(anchors.shape[1], candidates.shape[1])
    near, close = anchors[:, :dim], candidates[:, :dim]
    order, parent, length = tree
    big = max(np.abs(anchors).max(initial=0), 1) * max(np.abs(candidates).max(initial=0), 1) * max(anchors.shape[1], candidates.shape[1], 1)
    if 8 * big >= EXACT:
        everything = np.arange(len(candidates))
        for a in order:
            found = scores(near[a : a + 1], close)[0]
            mask = wanted(int(a), found.astype(float), found.astype(float))
            yield int(a), everything[mask], found[mask]
        return
    norm = np.sqrt((close**2).sum(1))
    bounds: dict[int, tuple] = {}
    children = np.bincount(parent[parent >= 0], minlength=len(order))
    for a in order:
        a = int(a)
        if parent[a] < 0:
            low = high = close @ near[a]
        else:
            old_low, old_high = bounds[int(parent[a])]
            reach = length[a] * norm * (1 + 1e-9) + 0.5  # more than rounding can take away
            low, high = old_low - reach, old_high + reach
            children[parent[a]] -= 1
            if not children[parent[a]]:
                del bounds[int(parent[a])]
        places = np.flatnonzero(wanted(a, low, high))
        # a product of all rows costs less than a copy of more than half of them
        found = (close @ near[a])[places] if 2 * len(places) > len(close) else close[places] @ near[a]
        if children[a]:
            low, high = low.copy(), high.copy()
            low[places] = high[places] = found
            bounds[a] = low, high
        yield a, places, found.astype(np.int64)


def first(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest, ties to the smaller id."""
    if len(score) > 4 * k:
        enough = np.partition(score, len(score) - k)[len(score) - k]
        score, ids = score[score >= enough], ids[score >= enough]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def _least(kept: tuple | None, k: int) -> float:
    """Scores below this cannot come into the list."""
    return float(kept[0][-1]) if kept is not None and len(kept[0]) == k else -np.inf


def _lists(pairs: DataFrame, k: int, positives: bool) -> DataFrame:
    """Per task the k best candidates of every anchor (and window): of its own label, or of others and inside the window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, dict] = {}
        trees: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                a_ids, a_labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                anchors = from_bytes(row["a_body"], row["a_n"], row["a_dim"])
                candidates = from_bytes(row["body"], row["n"], row["dim"])
                windows = np.frombuffer(row["windows"], np.int64).reshape(len(a_ids), -1, 3)
                kept = lists.setdefault(row["tile"], {})
                if row["tile"] not in trees:
                    trees[row["tile"]] = spanning_tree(anchors)

                def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    if positives:
                        mine = (labels == a_labels[a]) & (ids != a_ids[a])
                        floor = _least(kept.get((a, 0)), k)
                        if mine.sum() > k:
                            floor = max(floor, np.partition(low[mine], -k)[-k])
                        return mine & (high >= floor)
                    out = np.zeros(len(ids), bool)
                    for place, least, most in windows[a]:
                        if place >= 0:
                            out |= (high >= max(least, _least(kept.get((a, int(place))), k))) & (low <= most)
                    return out & (labels != a_labels[a])

                for a, places, found in tree_scores(anchors, trees[row["tile"]], candidates, wanted):
                    found_ids = ids[places]
                    for place, least, most in [(0, None, None)] if positives else windows[a]:
                        if place < 0:
                            continue
                        old = kept.get((a, int(place)))
                        if positives:
                            new, new_ids = found, found_ids
                        else:
                            if old is not None and len(old[0]) == k:
                                least = max(least, old[0][-1])
                            inside = np.flatnonzero((found >= least) & (found <= most))
                            new, new_ids = found[inside], found_ids[inside]
                        if len(new):
                            if old is not None:
                                new, new_ids = np.concatenate([old[0], new]), np.concatenate([old[1], new_ids])
                            kept[a, int(place)] = first(new, new_ids, k)
                kept["ids"] = a_ids
        for kept in lists.values():
            a_ids = kept.pop("ids")
            if kept:
                keys, found = zip(*kept.items())
                n = [len(s) for s, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([a_ids[a] for a, _ in keys], n)), pa.array(np.repeat([p for _, p in keys], n).astype(np.int64)),
                        pa.array(np.concatenate([i for _, i in found])), pa.array(np.concatenate([s for s, _ in found])),
                    ],
                    ["anchor_id", "place", "id", "score"],
                )

    return pairs.mapInArrow(run, "anchor_id long, place long, id long, score long")


def _met(tiles: DataFrame, anchors: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Every tile of anchors beside every tile of candidates, on a grid of blocks and shards.

    They meet by a shuffle: a broadcast is chosen by the size of the anchors' tiles, but sends a copy for every shard
    through the driver. Anchors stand on the right, where rows of a key are held; candidates stream by.
    """
    q = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    s = tiles.withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("long"))
    s = s.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return s.join(q.hint("merge"), ["block", "shard"]).drop("block", "shard")


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column | str, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank) among (id, label, v).

    An anchor's positives are its first other rows of the same label by integer inner product, ties to the smaller id. For
    each, the first rows of other labels with ``low * positive <= 100 * score <= high * positive`` are its negatives;
    a positive without any has no row. Rows without id, label or vector, or with a null or non-finite component,
    take no part. An id with several rows is one anchor, with the least of its labels and vectors; no row of that
    id is its candidate, other repeated rows count each. Shorter vectors are filled up with zeros, scores beyond a long end
    at its bounds, further columns are left out, an empty table gives no rows.

    Tasks keep lists for ``KEPT`` anchors at most, whatever the number of anchors; it sets the blocks of the grid.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select("id", "label", "v"), scale)
    tiles = written(candidate_tiles(rows), "negatives-tiles")
    chosen = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.*")
    chosen = written(chosen, "negatives-anchors")
    blocks = max(1, -(-chosen.count() // KEPT))
    shards = max(1, min(parallelism(spark), tiles.count()))  # anchors are copied for no shard that is surely empty
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long"))
    none = F.array([F.lit(0).cast("long")] * 3)
    asked = written(anchor_tiles(chosen.withColumn("windows", none)), "negatives-asked")
    found = _ranked(_lists(_met(tiles, asked, blocks, shards), positives, True), ["anchor_id"], positives)
    found = written(found.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # windows in whole numbers: the least score not under low percent of the positive's, the greatest not over high percent
    score = F.col("positive_score").cast("decimal(38,0)")
    least, most = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    window = F.struct(F.col("positive_rank").cast("long").alias("place"), least.alias("least"), most.alias("most"))
    windows = found.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(window)).alias("w"))  # ``positives`` at most
    flat = F.flatten(F.transform("w", lambda x: F.array(x.place, x.least, x.most)))
    filled = F.concat(flat, F.array_repeat(F.lit(-1).cast("long"), F.lit(3 * positives) - F.size(flat)))
    narrowed = written(anchor_tiles(chosen.join(windows, "id").withColumn("windows", filled)), "negatives-windows")
    near = _ranked(_lists(_met(tiles, narrowed, blocks, shards), negatives, False), ["anchor_id", "place"], negatives)
    near = near.withColumnRenamed("place", "positive_rank")
    return near.join(found, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), F.col("positive_rank").cast("int").alias("positive_rank"),
    )


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """``embeddings`` as (id, label, v), every seventh row with the next label."""
    label = F.col("label").cast("long")
    return vectors.select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("v")
    )


#: The query over ``embeddings`` in another engine.
SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor, c.id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON c.id <> a.id WHERE a.id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, p.place, s.id, s.score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INT AS rank, id AS negative_id, positive_score, score AS negative_score,
       place::INT AS positive_rank
FROM n WHERE rank <= 10"""
