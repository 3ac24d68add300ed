import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import vector_index as V
from millrace.operators.retrieve import knn

SCHEMA = "vec_id long, vector array<float>"


def clustered(n=3000, dim=16, groups=30, seed=0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 1, (groups, dim))
    return [(i, [float(x) for x in (centres[i % groups] + rnd.normal(0, 0.2, dim)).astype(np.float32)]) for i in range(n)]


def searched(spark, rows, k=5, **fit):
    corpus = spark.createDataFrame(rows, SCHEMA)
    queries = corpus.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    index = V.fit_cells(corpus, k, **fit)
    filed = V.file_vectors(corpus, index).cache()
    near = {(r["query_id"], r["vec_id"]): r["score"] for r in V.knn_cells(queries, filed, index, k, exclude_self=True).collect()}
    exact = {(r["query_id"], r["vec_id"]): r["score"] for r in knn(queries, corpus, k, exclude_self=True).collect()}
    compared = V.cell_hits(queries, filed, index, k, True).agg(F.sum("compared")).first()[0]
    return index, filed, near, exact, compared / (queries.count() * len(rows))


def test_clusters_need_few_cells_and_few_scores(spark):
    index, filed, near, exact, share = searched(spark, clustered())
    assert index.probe < 0.3 * len(index.centres)
    assert len(near.keys() & exact.keys()) >= 0.9 * len(exact) and share < 0.1
    assert all(near[p] == pytest.approx(exact[p], abs=1e-5) for p in near.keys() & exact.keys())
    assert filed.agg(F.sum("n")).first()[0] == 3000  # every vector is filed


def test_vectors_that_point_anywhere(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(0, 1, 48).astype(np.float32)]) for i in range(2500)]
    _, _, near, exact, share = searched(spark, rows)
    assert len(near.keys() & exact.keys()) >= 0.9 * len(exact) and share < 0.15


def test_crowded_cells_are_cut_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(V, "PART", 100)
    monkeypatch.setattr(V, "PACK", 30)
    rows = clustered(1500, groups=2)
    index, filed, near, exact, _ = searched(spark, rows, cells=3)
    assert filed.select("cell", "part").distinct().count() > 6 and filed.agg(F.max("n")).first()[0] <= 30
    ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in filed.collect()])
    assert sorted(ids) == list(range(1500)) and len(near.keys() & exact.keys()) >= 0.9 * len(exact)


def test_looking_everywhere_is_exact(spark):
    rows = clustered(300) + [(1000 + i, clustered(1)[0][1]) for i in range(5)]  # ties
    corpus = spark.createDataFrame(rows, SCHEMA)
    queries = corpus.withColumnRenamed("vec_id", "query_id")
    fitted = V.fit_cells(corpus, 3)
    every = V.Cells(fitted.centres, fitted.planes, len(fitted.centres), fitted.planes.shape[1])
    got = V.knn_cells(queries, V.file_vectors(corpus, every), every, 3)
    assert sorted(map(tuple, got.select("query_id", "vec_id", "rank").collect())) == sorted(map(tuple, knn(queries, corpus, 3).select("query_id", "vec_id", "rank").collect()))


def test_small_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (None, [1.0, 1.0]), (3, [0.5, 0.5])]
    corpus = spark.createDataFrame(rows, SCHEMA)
    index = V.fit_cells(corpus, 5)
    got = V.knn_cells(corpus.withColumnRenamed("vec_id", "query_id"), V.file_vectors(corpus, index), index, 5, exclude_self=True)
    assert sorted((r["query_id"], r["vec_id"]) for r in got.collect()) == [(1, 3), (3, 1)]
    empty = corpus.limit(0)
    index = V.fit_cells(empty, 5)
    assert V.knn_cells(corpus.withColumnRenamed("vec_id", "query_id"), V.file_vectors(empty, index), index, 5).count() == 0


def test_products_copy_few_vectors_at_a_time():
    import tracemalloc

    rnd = np.random.default_rng(2)
    q, x = rnd.normal(size=(300, 64)), rnd.normal(size=(1000, 64))
    row, col = (a.reshape(-1) for a in np.indices((300, 1000)))
    tracemalloc.start()
    got = V._products(q, x, row, col)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000 and np.allclose(got, (q @ x.T).reshape(-1))  # all copies at once have 307 MB
    assert len(V._products(q, x, row[:0], col[:0])) == 0
