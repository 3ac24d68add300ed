"""Nearest vectors, exact and by hashing, text vectors, and batch answers."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from millrace.operators.corpus import build_prompts
from millrace.session import parallelism

# Executors get the functions below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 50_000
HITS = "query_id long, vec_id long, score double"
HIT_BYTES = 64
#: Vectors of a packed row of queries and of the corpus at most, queries whose lists one task keeps, about.
QUERY_TILE, CORPUS_TILE, KEPT = 512, 1024, 65_536
#: Stands for a null id inside tasks; sorts last.
NO_ID = 2**63 - 1


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, null components as NaN."""
    length = np.diff(column.offsets.to_numpy())
    if len(length) and (length != length[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length[0] if len(length) else 0)


class Best:
    """The ``k`` best corpus rows so far of each of some queries, ties by smaller id; infinite and undefined scores never."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int, exclude_self: bool):
        self.q_ids, self.q, self.k, self.exclude_self = q_ids, q.astype(np.float64, copy=False), k, exclude_self
        self.row, self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.floor, self.last = np.full(len(q), -np.inf), np.full(len(q), NO_ID)  # a full list's worst score and that one's id

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        for at in range(0, len(ids), 2 * CORPUS_TILE):
            self._add(ids[at : at + 2 * CORPUS_TILE], x[at : at + 2 * CORPUS_TILE].astype(np.float64, copy=False))

    def _add(self, ids: np.ndarray, x: np.ndarray) -> None:
        n, k = len(ids), self.k
        raw = self.q @ x.T
        # scores count rounded, so somewhat smaller ones may be as good
        under = lambda floor: (floor - 1e-8 - 1e-12 * np.abs(floor))[:, None]
        wanted = np.isfinite(raw) & (raw >= under(self.floor))
        if self.exclude_self:
            wanted &= self.q_ids[:, None] != ids[None, :]
        if n > k and np.count_nonzero(wanted) > 4 * k * len(raw):
            wanted &= raw >= under(np.partition(np.where(wanted, raw, -np.inf), n - k, axis=1)[:, n - k])
        row, col = np.nonzero(wanted)
        score, ids = np.round(raw[row, col], 9), ids[col]
        better = np.isfinite(score) & ((score > self.floor[row]) | ((score == self.floor[row]) & (ids < self.last[row])))
        if not better.any():
            return
        row, ids, score = (np.concatenate([old, new[better]]) for old, new in ((self.row, row), (self.ids, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        self.row, self.ids, self.score = (c[place < k] for c in (row, ids, score))
        full = place == k - 1
        self.floor[row[full]], self.last[row[full]] = score[full], ids[full]


def _found(lists: Iterable[Best]) -> Iterator[pa.RecordBatch]:
    parts = [(best.q_ids[best.row], best.ids, best.score) for best in lists]
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["query_id", "vec_id", "score"])


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    known = [F.nullif(F.col(c), F.lit(NO_ID)).alias(c) for c in ("query_id", "vec_id")]
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*known, "score", "rank")


def _number(df: DataFrame) -> str:
    return "float" if isinstance(df.schema["vector"].dataType.elementType, FloatType) else "double"


def _taking_part(df: DataFrame, key: str, exclude_self: bool) -> DataFrame:
    """(key, vector) of known vectors, in floats or doubles. A null id is neither equal to another nor different from it."""
    # columns of its own, as both sides may come from one table
    rows = df.filter(F.col("vector").isNotNull()).select(F.col(key).cast("long").alias(key), F.col("vector").cast(f"array<{_number(df)}>").alias("vector"))
    return rows.filter(F.col(key).isNotNull()) if exclude_self else rows


def query_bytes(queries: DataFrame) -> int:
    """Size of the query vectors; one row to the driver."""
    row = queries.agg(F.sum(F.size("vector")).alias("cells")).first()
    return 8 * (row["cells"] or 0)


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    exclude_self: bool = False,
    strategy: str = "auto",
) -> DataFrame:
    """The k corpus vectors with the largest dot product for each query, ties by smaller id.

    ``queries`` has (query_id, vector), ``corpus`` (vec_id, vector). Every pair is looked at, but
    none is written: a task keeps its k best per query. Queries go to all tasks while they are
    smaller than ``QUERY_BYTES``; beyond that both sides are cut into blocks that meet pairwise. Null vectors take no
    part, nor do null ids with ``exclude_self``.
    """
    queries, corpus = _taking_part(queries, "query_id", exclude_self), _taking_part(corpus, "vec_id", exclude_self)
    if strategy == "auto":
        strategy = "broadcast" if query_bytes(queries) <= QUERY_BYTES else "blocks"
    if strategy == "broadcast":
        return _top(_knn_broadcast(queries, corpus, k, exclude_self), k)
    if strategy == "blocks":
        return _top(_knn_blocks(queries, corpus, k, exclude_self), k)
    raise ValueError(f"unknown strategy {strategy!r}")


def _collected(queries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = queries.select("query_id", "vector").orderBy("query_id").toArrow().combine_chunks()  # size checked by the caller
    if len(rows) == 0:
        return np.array([], dtype=np.int64), np.zeros((0, 0))
    ids, vectors = (rows.column(i).chunk(0) for i in range(2))
    return ids.fill_null(NO_ID).to_numpy(), _matrix(vectors)


@dataclass(frozen=True)
class Buckets:
    """Random planes in bands: two vectors share a bucket if they lie on the same sides of a whole band."""

    planes: np.ndarray
    bands: int
    bits: int

    def signatures(self, x: np.ndarray) -> np.ndarray:
        sides = ((x @ self.planes) > 0).reshape(len(x), self.bands, self.bits)
        return sides @ (1 << np.arange(self.bits))


def _knn_broadcast(queries, corpus, k, exclude_self):
    shared = queries.sparkSession.sparkContext.broadcast(_collected(queries))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = shared.value
        lists = [Best(q_ids[at : at + QUERY_TILE], q[at : at + QUERY_TILE], k, exclude_self) for at in range(0, len(q_ids), QUERY_TILE)]
        for batch in batches:
            if lists and batch.num_rows:
                ids, x = batch.column(0).fill_null(NO_ID).to_numpy(), _matrix(batch.column(1))
                for best in lists:
                    best.add(ids, x)
        yield from _found(lists)

    return corpus.select("vec_id", "vector").mapInArrow(scan, HITS)


def _tiles(df: DataFrame, key: str, rows: int, buckets: Buckets | None = None) -> DataFrame:
    """(band, sig, ids, body): vectors packed, so many a row at most; with ``buckets`` each vector once a band, with those of its bucket."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).fill_null(NO_ID).to_numpy(), _matrix(batch.column(1))
            sigs = buckets.signatures(x) if buckets else np.zeros((len(ids), 1), np.int64)
            for band in range(sigs.shape[1]):
                order = np.argsort(sigs[:, band], kind="stable")
                sig = sigs[order, band]
                cuts = [*np.flatnonzero(np.append(True, sig[1:] != sig[:-1])).tolist(), len(sig)]
                spans = [(at, min(to, at + rows)) for start, to in zip(cuts, cuts[1:]) for at in range(start, to, rows)]
                packed = [(band, int(sig[at]), ids[order[at:to]].tobytes(), x[order[at:to]].tobytes()) for at, to in spans]
                types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed), types)], ["band", "sig", "ids", "body"])

    return df.select(key, "vector").mapInArrow(pack, "band int, sig long, ids binary, body binary")


def _meeting(left: DataFrame, right: DataFrame, by: list[str], types: tuple[str, str], k: int, exclude_self: bool) -> DataFrame:
    """Best corpus rows of every query and group, from packed rows of queries and of the corpus that share the group ``by``.

    A task keeps k rows for each of about ``KEPT`` queries and scores a packed row of queries against a bounded number of vectors at a time.
    """
    asked = left.select(*by, F.col("ids").alias("q_ids"), F.col("body").alias("q"))
    pairs = asked.join(right.select(*by, "ids", "body"), by)
    q_type, x_type = ({"float": np.float32, "double": np.float64}[t] for t in types)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[tuple, Best] = {}  # by group and query ids: rows with equal ids are one query in the end
        held, at, waiting = 0, None, []

        def score() -> None:
            if waiting:
                lists[at].add(*(np.concatenate(parts) for parts in zip(*waiting)))
                waiting.clear()

        for batch in batches:
            for r, key in enumerate(zip(*(batch.column(i).to_pylist() for i in range(len(by) + 1)))):
                if key != at or sum(len(ids) for ids, _ in waiting) >= CORPUS_TILE:
                    score()
                at = key
                q, ids, body = (batch.column(len(by) + i)[r].as_buffer() for i in (1, 2, 3))
                if key not in lists:
                    q_ids = np.frombuffer(key[-1], np.int64)
                    if held + len(q_ids) > KEPT:
                        yield from _found(lists.values())
                        lists.clear()
                        held = 0
                    lists[key] = Best(q_ids, np.frombuffer(q, q_type).reshape(len(q_ids), -1).astype(np.float64), k, exclude_self)
                    held += len(q_ids)
                ids = np.frombuffer(ids, np.int64)
                waiting.append((ids, np.frombuffer(body, x_type).reshape(len(ids), -1)))
            score()  # before the batch goes
        yield from _found(lists.values())

    return pairs.select(*by, "q_ids", "q", "ids", "body").mapInArrow(run, HITS)


def _knn_blocks(queries, corpus, k, exclude_self, block_rows: int | None = None):
    """Packed rows dealt over a grid of query and corpus blocks: about ``block_rows`` vectors a block, and at least as many cells as partitions."""
    block_rows = block_rows or BLOCK_ROWS
    cells = parallelism(queries.sparkSession)
    many_q, many_c = max(1, queries.count()), max(1, corpus.count())
    n_q = max(1, -(-many_q // block_rows), min(cells, round((cells * many_q / many_c) ** 0.5)))
    n_c = max(-(-many_c // block_rows), -(-cells // n_q))
    parts = max(cells, min(n_q * n_c, 4 * cells))

    def dealt(side: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>"))
        return side.withColumn(own, F.pmod(F.xxhash64("ids", "body"), F.lit(n_own))).withColumn(other, every).repartition(parts, "qb", "cb")

    left = dealt(_tiles(queries, "query_id", min(QUERY_TILE, block_rows)), "qb", n_q, "cb", n_c)
    right = dealt(_tiles(corpus, "vec_id", min(CORPUS_TILE, block_rows)), "cb", n_c, "qb", n_q)
    return _meeting(left, right, ["qb", "cb"], (_number(queries), _number(corpus)), k, exclude_self)


def knn_lsh(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    bands: int = 32,
    bits: int = 4,
    seed: int = 42,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate variant: ranks only vectors that share a bucket with the query in some band.

    Both sides are packed by band and signature and joined on them, so no pair outside a bucket is formed. A bucket with more than
    ``block_rows`` rows on a side is split, the parts of each side meeting those of the other; nothing is capped.
    What is approximate is the choice of buckets.
    """
    buckets = Buckets(np.random.default_rng(seed).standard_normal((dim, bands * bits)), bands, bits)
    queries, corpus = _taking_part(queries, "query_id", exclude_self), _taking_part(corpus, "vec_id", exclude_self)
    left = _tiles(queries, "query_id", min(QUERY_TILE, block_rows), buckets)
    right = _tiles(corpus, "vec_id", min(CORPUS_TILE, block_rows), buckets)
    at = ["band", "sig"]
    parts = lambda side, name: side.groupBy(*at).agg(F.ceil(F.sum(F.length("ids") / 8) / F.lit(block_rows)).alias(name))
    sizes = parts(left, "nq").join(parts(right, "nc"), at)

    def split(side: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_other) - 1))
        return side.join(sizes, at).withColumn(own, F.pmod(F.xxhash64("ids", "body"), F.col(n_own))).withColumn(other, every).drop("nq", "nc")

    left, right = split(left, "qb", "nq", "cb", "nc"), split(right, "cb", "nc", "qb", "nq")
    hits = _meeting(left, right, [*at, "qb", "cb"], (_number(queries), _number(corpus)), k, exclude_self)
    return _top(hits.dropDuplicates(["query_id", "vec_id"]), k)


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector of each group, summed per position with map-side combine."""
    cells = df.select(F.col(group).alias("query_id"), F.posexplode(vector).alias("i", "x"))
    means = cells.groupBy("query_id", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "m")))  # one entry per dimension
    return means.groupBy(F.col("query_id").cast("long").alias("query_id")).agg(
        F.transform(ordered, lambda c: c["m"]).alias("vector")
    )


def embed_text(df: DataFrame, key: str, text: str, dim: int = 256) -> DataFrame:
    """Unit-length tf-idf vectors over hashed words."""
    rows = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\s+").transform(rows)
    counts = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(words)
    weighted = IDF(inputCol="_tf", outputCol="_idf").fit(counts).transform(counts)
    unit = Normalizer(inputCol="_idf", outputCol="_unit").transform(weighted)
    return unit.select(key, vector_to_array("_unit").alias("vector"))


def answer_batch(
    questions: DataFrame,
    corpus: DataFrame,
    texts: DataFrame,
    template: str,
    k: int = 1,
    hook: Callable[[Column], Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Retrieve, build the prompt, answer, and name the sources, for every question.

    ``questions`` has (query_id, question, vector), ``corpus`` (vec_id, vector), ``texts``
    (vec_id, text). ``hook`` answers prompts as a column function; without it the best source's
    text is the answer. ``partitions`` sets how many tasks hold a model.
    """
    hits = knn(questions.select("query_id", "vector"), corpus, k)
    # There are k hits per question and no more: few enough hits go to the texts, not the other way.
    if questions.count() * k * HIT_BYTES <= QUERY_BYTES:
        hits = F.broadcast(hits)
    texts = texts.join(hits, "vec_id").select("query_id", "vec_id", "text")
    # a hit without text is still a source
    found = hits.join(texts, ["query_id", "vec_id"], "left").groupBy("query_id").agg(  # at most k entries per question
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "text"))).alias("_found")
    )
    rows = questions.select("query_id", "question").join(found, "query_id", "left")
    rows = rows.withColumns(
        {
            "_context": F.array_compact(F.transform("_found", lambda x: x["text"])),
            "sources": F.transform("_found", lambda x: x["vec_id"].cast("string")),
        }
    )
    rows = build_prompts(rows, template, "_context", "question")
    if partitions:
        rows = rows.repartition(partitions)
    answer = hook(F.col("prompt")) if hook else F.try_element_at("_context", F.lit(1))
    return rows.select("query_id", "question", "prompt", F.struct(answer.alias("answer"), "sources").alias("response"))
