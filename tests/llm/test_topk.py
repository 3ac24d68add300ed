import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import topk as T

SCHEMA = "id long, v array<float>"


def brute(rows, k, is_query):
    whole = [(i, [int(np.floor(np.float64(x) * 256)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if is_query(i)}):
        own = min(v for i, v in whole if i == q)
        scores = [(max(1 - T.LONG, min(T.LONG, sum(a * b for a, b in zip(own, v)))), i) for i, v in whole if i != q]
        found = sorted((-s, i) for s, i in scores)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def vectors(n=300, dim=8, seed=0):
    rnd = random.Random(seed)
    out = [(i, [float(np.float32(rnd.choice([rnd.gauss(0, 1), 0.5]))) for _ in range(dim)]) for i in range(n)]
    same = out[3][1]
    out += [(1000 + i, same) for i in range(60)]  # ties
    out += [(50, None), (51, [1.0, None]), (52, [float("nan")]), (53, [float("inf"), 1.0]), (None, [1.0]), (54, []), (55, [2.0] * 3), (56, [1.0] * 12), (7, out[7][1])]
    return out


@pytest.mark.parametrize("query_tile, shard_tile, k", [(1024, 4096, 5), (3, 7, 5), (4, 16, 1), (2, 5, 400)])
def test_equals_brute_force(spark, monkeypatch, query_tile, shard_tile, k):
    monkeypatch.setattr(T, "QUERY_TILE", query_tile)
    monkeypatch.setattr(T, "SHARD_TILE", shard_tile)
    rows = vectors()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, T.exact_topk(table, F.col("id") % 50 == 0, k).collect()))
    assert got == brute(rows, k, lambda i: i % 50 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(10.0 ** (i % 16) * s)) for s in (1, -3)]) for i in range(40)]
    got = sorted(map(tuple, T.exact_topk(spark.createDataFrame(rows, SCHEMA), F.col("id") % 5 == 0, 3).collect()))
    assert got == brute(rows, 3, lambda i: i % 5 == 0)


def test_grid_does_not_change_the_result(spark):
    table = spark.createDataFrame(vectors(), SCHEMA)
    one = sorted(map(tuple, T.exact_topk(table, F.col("id") % 50 == 0, 5).collect()))
    assert one == sorted(map(tuple, T.exact_topk(table.repartition(9), F.col("id") % 50 == 0, 5, share=1.0).collect()))


def test_tasks_keep_no_vectors_and_blocks_follow_the_queries(spark, monkeypatch):
    rows = vectors(200)
    table = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, T.exact_topk(table, F.col("id") % 2 == 0, 3).collect()))
    monkeypatch.setattr(T, "KEPT", 9)
    monkeypatch.setattr(T, "QUERY_TILE", 4)
    assert sorted(map(tuple, T.exact_topk(table, F.col("id") % 2 == 0, 3).collect())) == want


def test_copies_of_a_side_are_not_broadcast(spark):
    table = spark.createDataFrame(vectors(), SCHEMA)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    found = T.exact_topk(table, F.col("id") % 50 == 0, 5)
    assert found.count() == len(brute(vectors(), 5, lambda i: i % 50 == 0))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("most, size", [(2**15 - 1, 2), (2**15, 4), (2**31 - 1, 4), (2**31, 8), (2.0**60, 8), (0, 2)])
def test_tiles_travel_in_the_narrowest_kind(most, size):
    matrix = np.array([[most, -most, 0.0], [-1.0, 1.0, most]])
    body = T.to_bytes(matrix)
    assert len(body) == 6 * size and (T.from_bytes(body, 2, 3) == matrix).all()
    assert T.from_bytes(T.to_bytes(np.zeros((2, 0))), 2, 0).shape == (2, 0)


@pytest.mark.parametrize("kind", [np.float64, np.int64])
@pytest.mark.parametrize("high, width, k", [(10**6, 500, 3), (3, 500, 3), (1, 400, 2), (50, 7, 9), (50, 4, 4)])
def test_leading_equals_a_full_sort(kind, high, width, k):
    rnd = np.random.default_rng(high)
    ids = rnd.permutation(width * 2)[:width] - width
    none = -np.inf if kind is np.float64 else T.LEAST
    score = rnd.integers(-high, high + 1, (20, width)).astype(kind)
    score[rnd.random(score.shape) < 0.05] = none
    score[0], score[1, 1:] = none, none
    for least in (np.full(20, T.LEAST), rnd.integers(-high, high + 1, 20)):
        got = T.leading(score, ids, k, least)
        assert got[0].shape == got[1].shape == (20, k)
        for i in range(20):
            want = sorted((-int(s), int(x)) for s, x in zip(score[i], ids) if s != none)[:k]
            have = [(-int(s), int(x)) for s, x in zip(got[0][i], got[1][i]) if s != T.LEAST]
            # below ``least`` nothing need be there
            assert have == want[: len(have)] and all(-s < least[i] for s, _ in want[len(have) :])


def test_empty_and_alone(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.exact_topk(empty, F.col("id") % 50 == 0).count() == 0
    assert T.exact_topk(spark.createDataFrame([(50, [1.0])], SCHEMA), F.col("id") % 50 == 0).count() == 0
