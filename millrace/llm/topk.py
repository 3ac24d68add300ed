"""Exact top-k by integer inner product: tiled matrix products on a grid of query blocks and shards."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a tile. Tasks hold one query tile's scores against one shard tile at a time.
QUERY_TILE, SHARD_TILE = 1024, 4096
#: Queries whose lists one task keeps, about.
KEPT = 65_536
LONG = 2**63 - 1
#: Tiles travel as the first of these that holds their whole numbers.
KINDS = (np.int16, np.int32, np.float64)
TILE_SCHEMA = "ids binary, parts binary, dim int, n int"


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(id, v): components as whole numbers floor(scale * x) in doubles; vectors with null or non-finite ones go."""
    x = F.col("v")
    good = F.col("id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    # floor() of a double is a long in Spark; large ones must not overflow
    whole = F.transform(x.cast("array<double>"), lambda c: c * F.lit(float(scale)) - F.pmod(c * F.lit(float(scale)), F.lit(1.0)))
    return vectors.filter(good).select(F.col("id").cast("long").alias("id"), whole.alias("v"))


def to_bytes(matrix: np.ndarray) -> bytes:
    """Whole numbers in the first of ``KINDS`` that holds them all."""
    most = np.abs(matrix).max(initial=0)
    return matrix.astype(next(x for x in KINDS if x is np.float64 or most <= np.iinfo(x).max)).tobytes()


def from_bytes(body: bytes, n: int, dim: int) -> np.ndarray:
    kind = {np.dtype(x).itemsize: x for x in KINDS}.get(len(body) // max(1, n * dim), np.float64)
    return np.frombuffer(body, kind).reshape(n, dim).astype(np.float64)


def _tiles(vectors: DataFrame, size: int) -> DataFrame:
    """Vectors packed, so many a row: ids and a matrix of whole numbers, shorter vectors filled up with zeros."""

    def pack(ids: np.ndarray, lists: pa.ListArray) -> tuple:
        at = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        length = np.diff(at)
        dim = int(length.max(initial=0))
        out = np.zeros((len(ids), dim))
        fill = np.arange(dim)[None, :] < length[:, None]
        out[fill] = values[at[0] : at[-1]]
        return ids.tobytes(), to_bytes(out), dim, len(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in range(0, batch.num_rows, size):
                part = batch.slice(x, size)
                rows.append(pack(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), part.column(1)))
            if rows:
                a, b, c, d = zip(*rows)
                columns = [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(c, pa.int32()), pa.array(d, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "parts", "dim", "n"])

    return vectors.select("id", "v").mapInArrow(run, TILE_SCHEMA)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold all sums, else as longs, those beyond a long at its bounds."""
    dim = min(queries.shape[1], shard.shape[1])
    queries, shard = queries[:, :dim], shard[:, :dim]
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(dim, 1)
    if bound < 2**53:  # every partial sum is exact in doubles
        return queries @ shard.T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries).dot(whole(shard).T) if dim else np.zeros((len(queries), len(shard)), object)
    return np.clip(exact, -LONG, LONG).astype(np.int64)


def scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; those beyond a long end at its bounds."""
    return products(queries, shard).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row with their ids, ties to the smaller id. ``ids`` are those of the columns, or of each entry."""
    if ids.ndim == 1:
        n = len(ids)
        by_id = np.argsort(ids, kind="stable")
        score, ids = score[:, by_id], ids[by_id]
        if n > k and np.abs(score).max(initial=0) < LONG // (2 * n):
            # one number holds score and place
            key = score * n + (n - 1 - np.arange(n))
            place = np.argpartition(key, n - k, axis=1)[:, n - k :]
            score, ids = np.take_along_axis(score, place, 1), ids[place]
        else:
            ids = np.broadcast_to(ids, score.shape)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


LEAST = -LONG  # marks a place that is not taken


def leading(score: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``best`` among the scores of a row from its ``least`` up, k places wide. Scores of LEAST or minus infinity are none."""
    n, width = score.shape
    many = 8 * k * n
    cut = np.maximum(least, LEAST + 1).astype(score.dtype)
    near = score >= cut[:, None]
    if np.count_nonzero(near) > many:
        cut = np.maximum(cut, np.partition(score, width - k, axis=1)[:, width - k])
        near = score >= cut[:, None]
    if np.count_nonzero(near) > many:  # equal scores
        floor = int(score[near].min()) - 1
        found = best(np.where(near, score, floor).astype(np.int64), ids, k)
        found[0][found[0] == floor] = LEAST
        return found
    row, place = np.nonzero(near)
    value, found_ids = score[row, place].astype(np.int64), ids[place]
    order = np.lexsort((found_ids, -value, row))
    row, value, found_ids = row[order], value[order], found_ids[order]
    rank = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
    out, out_ids = np.full((n, k), LEAST), np.zeros((n, k), np.int64)
    first = rank < k
    out[row[first], rank[first]], out_ids[row[first], rank[first]] = value[first], found_ids[first]
    return out, out_ids


def _partial(pairs: DataFrame, k: int) -> DataFrame:
    """Per task and query the k best (query_id, tag, vec_id, score) over all tiles that the task sees."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple] = {}  # by a tile's first query, as a query is in one tile
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, s_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q, s = from_bytes(row["q_parts"], row["q_n"], row["q_dim"]), from_bytes(row["parts"], row["n"], row["dim"])
                score = products(q, s)
                if score.dtype == np.int64:
                    score = np.maximum(score, LEAST + 1)
                own = np.flatnonzero(np.isin(s_ids, q_ids))
                of, at = np.nonzero(q_ids[:, None] == s_ids[own])
                score[of, own[at]] = -np.inf if score.dtype == np.float64 else LEAST
                key = int(q_ids[0])
                old = lists[key][1] if key in lists else None
                found = leading(score, s_ids, k, np.full(len(q_ids), LEAST) if old is None else old[0][:, -1])
                if old is not None:
                    found = best(np.concatenate([old[0], found[0]], 1), np.concatenate([old[1], found[1]], 1), k)
                lists[key] = (q_ids, found)
        for q_ids, (score, ids) in lists.values():
            taken = score != LEAST
            query = np.broadcast_to(q_ids[:, None], score.shape)[taken]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids[taken]), pa.array(score[taken])], ["query_id", "vec_id", "score"])

    columns = ["q_ids", "q_parts", "q_dim", "q_n", "ids", "parts", "dim", "n"]
    return pairs.select(*columns).mapInArrow(run, "query_id long, vec_id long, score long")


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, share: float = 0.02) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query among (id, v).

    Candidates are all vectors but those with the query's id; ties go to the smaller id, then to either of rows equal
    in id. Vectors that are null or hold null or non-finite components take no part, nor rows without id. Of vectors
    of different lengths the shorter counts as filled up with zeros. Scores beyond a long end at its bounds. A query
    id with several rows is one query, with the first of its vectors in their order.

    Tiles of vectors meet tiles of queries on a grid of query blocks and shards, so that each side is copied along one
    edge of the grid only. The copies meet by a shuffle: before they are made a side may look small enough to be sent
    whole through the driver, with all its copies. ``share`` (queries to vectors, about) shapes the grid, not the result. Tasks keep k
    a query and at most about ``KEPT`` queries, as blocks are as many as the counted queries ask for; lists merge by groups of shards first, then as a whole.
    """
    cells = max(1, parallelism(vectors.sparkSession))
    blocks = max(1, round((cells * share) ** 0.5), -(-vectors.filter(is_query).count() // KEPT))
    shards = max(1, -(-cells // blocks))
    spread = max(2, round(shards**0.5))
    whole = integer_vectors(vectors, scale)
    asked = whole.filter(is_query).groupBy("id").agg(F.min("v").alias("v")).repartition(-(-blocks * 2 // 1), "id")
    q = _tiles(asked, QUERY_TILE).select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "parts", "dim", "n")])
    q = q.withColumn("block", F.pmod(F.xxhash64("q_ids"), F.lit(blocks)))
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.col("shard").cast("long"))
    s = _tiles(whole, SHARD_TILE).withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)))
    s = s.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    # the queries of a block stand on the right, where rows of a key are held; the shard's tiles stream by
    part = _partial(s.join(q.hint("merge"), ["block", "shard"]), k).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(spread)))

    def merged(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    few = merged(part, "query_id", "group").select("query_id", "vec_id", "score")
    return merged(few, "query_id").select("query_id", "rank", "vec_id", "score")


#: The query over ``embeddings`` in another engine.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
