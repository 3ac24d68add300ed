"""Nearest vectors by an inverted file: cells around coarse centres, sketches inside them, exact scores for a few.

``fit_cells`` takes a bounded sample to place the centres and to find out how many cells a query has to look into and how
far apart the sketches of neighbours are, for the recall that is asked for; only vectors with sketches as near are scored. ``file_vectors`` files every
vector in its cell. ``knn_cells`` looks queries up. Where vectors lie in clusters few cells suffice; where they point
anywhere, many cells are looked into, and the sketches alone spare the work.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that the index is fitted on at most, vectors of a packed row, vectors of a part of a cell, queries of a packed row.
SAMPLE, PACK, PART, ASKED = 20_000, 2048, 65_536, 512
#: Sketch bits for each dimension, components of the pairs that are scored at once.
BITS, AT_ONCE = 12, 2_000_000


@dataclass(frozen=True)
class Cells:
    """Centres, the planes of the sketches, cells to look into and differing sketch bits up to which vectors are scored."""

    centres: np.ndarray
    planes: np.ndarray
    probe: int
    limit: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Cell of each vector: the nearest centre."""
        return (x @ self.centres.T - 0.5 * (self.centres**2).sum(1)).argmax(1)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """Sides of the planes on which vectors lie, 64 a word."""
        return np.packbits((x @ self.planes) > 0, axis=1).view(np.uint64)

    def asked(self, q: np.ndarray, probe: int | None = None) -> np.ndarray:
        """Cells to look into for each query, those with the largest product of centre and query first."""
        return np.argsort(-(q @ self.centres.T), axis=1, kind="stable")[:, : probe or self.probe]


def _apart(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Differing bits of every query sketch and every vector sketch."""
    out = np.zeros((len(q), len(x)), np.int32)
    for word in range(q.shape[1]):
        out += np.bitwise_count(q[:, word, None] ^ x[None, :, word])
    return out


def fit_cells(corpus: DataFrame, k: int, cells: int | None = None, target: float = 0.95, sample: int = SAMPLE, seed: int = 42) -> Cells:
    """An index over (vec_id, vector) fitted on ``sample`` rows at most, those with the least hash of vec_id.

    The sample is its own test: for every twentieth of its rows the nearest ``k`` others are found by brute force, and the
    least numbers of cells and of exact scores that find ``target`` of them are kept. In the whole corpus neighbours
    are nearer than in the sample, so recall there is hardly lower. Null vectors and ids take no part.
    """
    rows = corpus.filter(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow().column("vector").to_pylist()
    if not few:
        return Cells(np.zeros((1, 1)), np.zeros((1, 64)), 1, 64)
    x = np.array(few, np.float64)
    rnd, n = np.random.default_rng(seed), len(x)
    cells = min(n, cells or max(1, int(n**0.5)))
    centres = x[rnd.choice(n, cells, replace=False)].copy()
    for _ in range(10):
        own = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        total, size = np.zeros_like(centres), np.bincount(own, minlength=cells)
        np.add.at(total, own, x)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    words = -(-BITS * x.shape[1] // 64)
    index = Cells(centres, rnd.standard_normal((x.shape[1], 64 * words)), cells, 64 * words)
    test = np.arange(0, n, 20)
    score = x[test] @ x.T
    score[np.arange(len(test)), test] = -np.inf
    k = min(k, n - 1)
    if not k:
        return index
    near = np.argsort(-score, axis=1)[:, :k]
    # cells: at which place of the query's order the neighbours' cells stand
    order = index.asked(x[test], cells)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(cells), order.shape), 1)
    needed = np.sort(np.take_along_axis(place, index.of(x)[near], 1).reshape(-1))
    share = target**0.5  # one half of what may be lost goes here, the other to the sketches
    probe = int(needed[min(len(needed) - 1, int(np.ceil(share * len(needed))))]) + 1
    apart = _apart(index.sketch(x[test]), index.sketch(x))
    bits = np.sort(np.take_along_axis(apart, near, 1).reshape(-1))
    return Cells(centres, index.planes, probe, int(bits[min(len(bits) - 1, int(np.ceil(share * len(bits))))]))


FILED = "cell int, part int, ids binary, body binary, sketch binary, n int"


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, null components as NaN."""
    length = np.diff(column.offsets.to_numpy())
    if len(length) and (length != length[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length[0] if len(length) else 0)


def _products(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Products of the paired vectors, of which a bounded number is copied at a time."""
    step = max(1, AT_ONCE // max(1, q.shape[1]))
    return np.concatenate([np.zeros(0), *(np.einsum("nd,nd->n", q[row[at : at + step]], x[col[at : at + step]]) for at in range(0, len(row), step))])


def file_vectors(corpus: DataFrame, index: Cells) -> DataFrame:
    """Every vector in its cell, packed: (cell, part, ids, body, sketch, n). Store it; searches read it.

    Cells are cut into parts of about ``PART`` vectors by their counted sizes, so that a crowded cell is no single task's.
    """
    rows = corpus.filter(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = index.of(_matrix(batch.column(1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], ["vec_id", "vector", "cell"])

    placed = rows.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<float>")).mapInArrow(place, "vec_id long, vector array<float>, cell int")
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(PART)).alias("parts"))
    dealt = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))  # a row a cell

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, part, ids = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]))) if len(cell) else np.zeros(0, int)
            ready = []
            for a, b in zip(cuts, np.append(cuts[1:], len(cell))):
                for at in range(a, b, PACK):
                    to = min(b, at + PACK)
                    x = _matrix(batch.column(3).slice(at, to - at))
                    ready.append((int(cell[a]), int(part[a]), ids[at:to].tobytes(), x.astype(np.float32).tobytes(), index.sketch(x).tobytes(), int(to - at)))
            if ready:
                types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], ["cell", "part", "ids", "body", "sketch", "n"])

    together = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part")
    return together.select("cell", "part", "vec_id", "vector").mapInArrow(pack, FILED)


def cell_hits(queries: DataFrame, filed: DataFrame, index: Cells, k: int, exclude_self: bool = False) -> DataFrame:
    """(query_id, vec_id, score, compared): the best of each packed row for each query that looks into its cell.

    ``compared`` counts exact scores, on one row of a query and packed row. No pair is written beyond the k best.
    """
    asking = queries.filter(F.col("vector").isNotNull() & F.col("query_id").isNotNull())

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, q = batch.column(0).to_numpy(), _matrix(batch.column(1))
            cells = index.asked(q)
            for cell in np.unique(cells):
                mine = np.flatnonzero((cells == cell).any(1))
                ready = [(int(cell), ids[m].tobytes(), q[m].tobytes()) for m in (mine[at : at + ASKED] for at in range(0, len(mine), ASKED))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), [pa.int32(), pa.binary(), pa.binary()])], ["cell", "q_ids", "q"])

    asked = asking.select(F.col("query_id").cast("long"), "vector").mapInArrow(ask, "cell int, q_ids binary, q binary")
    parts = filed.select("cell", "part").distinct()
    met = asked.join(parts, "cell").join(filed, ["cell", "part"])

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q_ids, q, ids, body, sketch = (c[r].as_buffer() for c in batch.columns)
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                q = np.frombuffer(q).reshape(len(q_ids), -1)
                x = np.frombuffer(body, np.float32).reshape(len(ids), -1).astype(np.float64)
                near = _apart(index.sketch(q), np.frombuffer(sketch, np.uint64).reshape(len(ids), -1)) <= index.limit
                if exclude_self:
                    near &= q_ids[:, None] != ids[None, :]
                row, col = np.nonzero(near)
                score = np.round(_products(q, x, row, col), 9)
                order = np.lexsort((ids[col], -score, row))
                row, col, score = row[order], col[order], score[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                compared = np.where(place == 0, np.bincount(row, minlength=len(q_ids))[row], 0)
                best = place < k
                columns = [q_ids[row[best]], ids[col[best]], score[best], compared[best]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score", "compared"])

    return met.select("q_ids", "q", "ids", "body", "sketch").mapInArrow(rank, "query_id long, vec_id long, score double, compared long")


def knn_cells(queries: DataFrame, filed: DataFrame, index: Cells, k: int, exclude_self: bool = False) -> DataFrame:
    """(query_id, vec_id, score, rank): the k filed vectors with the largest products that the index finds, ties by smaller id."""
    hits = cell_hits(queries, filed, index, k, exclude_self)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.select("query_id", "vec_id", "score", F.row_number().over(order).alias("rank"))
    return ranked.filter(F.col("rank") <= k)
