import random

import numpy as np
import pytest

from millrace.llm import hard_negatives as N

SCHEMA = "id long, label int, v array<float>, score string, place int"


def brute(rows, anchor, k=5, many=10):
    good = [(i, l, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, l, v, *_ in rows
            if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, *_ in good if anchor(i)}):
        label, own = min((l, v) for i, l, v in good if i == a)
        score = [(max(-(2**63 - 1), min((2**63 - 1), sum(x * y for x, y in zip(own, v)))), i, l) for i, l, v in good if i != a]
        best = sorted((-s, i) for s, i, l in score if l == label)[:k]
        for place, (s, p) in enumerate(best):
            inside = sorted((-t, i) for t, i, l in score if l != label and 30 * -s <= 100 * t <= 90 * -s)[:many]
            out += [(a, p, rank + 1, i, -s, -t, place + 1) for rank, (t, i) in enumerate(inside)]
    return sorted(out)


def vectors(n=500, dim=6, seed=0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, rnd.randrange(4), [c + rnd.gauss(0, 0.3) for c in rnd.choice(centres)]) for i in range(n)]
    rows += [(2000 + i, i % 3, rows[3][2]) for i in range(70)]  # ties
    rows += [rows[8], rows[8], (9, 3, rows[11][2]), (10, 2, rows[1][2])]  # repeated rows, an anchor with two labels
    rows += [(20, 1, None), (30, None, [1.0]), (None, 1, [1.0] * dim), (40, 1, [float("nan")]), (50, 1, [None]), (60, 1, []), (70, 1, [0.5] * 9), (80, 2, [0.0] * dim)]
    return [(*r, "x", 1) for r in rows]


def found(spark, rows, anchor="id % 10 = 0", parts=3):
    return sorted(map(tuple, N.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(parts), anchor).collect()))


@pytest.mark.parametrize("tree, tile, kept", [(256, 2_000_000, 16_384), (3, 700, 4), (8, 100, 7)])
def test_equals_brute_force(spark, monkeypatch, tree, tile, kept):
    for name, value in (("TREE", tree), ("TILE_BYTES", tile), ("KEPT", kept)):
        monkeypatch.setattr(N, name, value)
    rows = vectors()
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rnd = random.Random(2)
    rows = [(i, i % 2, [rnd.choice([1, -3, 7]) * 10.0 ** rnd.randint(0, 14), 1.0], "", 0) for i in range(60)]
    assert found(spark, rows, "id % 5 = 0") == brute(rows, lambda i: i % 5 == 0)


def test_bounds_spare_most_candidates():
    rnd = np.random.default_rng(0)
    centres = rnd.normal(0, 40, (4, 16))
    anchors = np.floor(np.repeat(centres, 8, 0) + rnd.normal(0, 1, (32, 16)))
    candidates = np.floor(np.repeat(centres, 100, 0) + rnd.normal(0, 1, (400, 16)))
    tree, scored = N.spanning_tree(anchors), []
    for a, places, score in N.tree_scores(anchors, tree, candidates, lambda a, low, high: high >= 0.9 * (anchors[a] ** 2).sum()):
        exact = candidates @ anchors[a]
        assert set(np.flatnonzero(exact >= 0.9 * (anchors[a] ** 2).sum())) <= set(places) and (score == exact[places]).all()
        scored.append(len(places))
    assert sorted(np.bincount(np.clip(tree[1], -1, 31) + 1).tolist())[-1] < 32 and (tree[1] < 0).sum() == 1
    assert sum(scored) < 0.5 * 32 * 400


def test_spanning_tree_is_least():
    rnd = np.random.default_rng(1)
    points = rnd.integers(-50, 50, (40, 3)).astype(float)
    order, parent, length = N.spanning_tree(points)
    joined, total = {0}, 0.0
    while len(joined) < 40:  # Prim, one pair at a time
        d, j = min((np.linalg.norm(points[i] - points[j]), j) for i in joined for j in range(40) if j not in joined)
        joined.add(j)
        total += d
    assert length.sum() == pytest.approx(total) and sorted(order) == list(range(40))
    place = {int(a): i for i, a in enumerate(order)}
    assert all(parent[a] < 0 or place[int(parent[a])] < place[a] for a in range(40))


def test_empty_and_alone(spark):
    assert found(spark, []) == []
    assert found(spark, [(10, 1, [1.0], "", 0)]) == []
    assert found(spark, [(10, 1, [1.0], "", 0), (11, 1, [1.0], "", 0), (12, 2, [0.5], "", 0)]) == [(10, 11, 1, 12, 65536, 32768, 1)]


def test_copies_of_a_side_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE_BYTES", 700)  # many tiles, so many shards
    met, plans = N._met, []

    def watched(*args):
        out = met(*args)
        assert out.count() > 0
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(N, "_met", watched)
    rows = vectors()
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)


def test_no_more_shards_than_tiles(spark, monkeypatch):
    met, seen = N._met, []
    monkeypatch.setattr(N, "_met", lambda tiles, anchors, blocks, shards: seen.append((tiles.count(), shards)) or met(tiles, anchors, blocks, shards))
    rows = vectors()
    assert found(spark, rows, parts=2) == brute(rows, lambda i: i % 10 == 0)
    assert len(seen) == 2 and all(1 <= shards <= n for n, shards in seen)
