from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from millrace.operators.lookup import FeatureLookup, create_training_set, key_lookup, point_in_time, score_batch, tile_edges, tile_width

T0 = datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def frames(spark, labels, features):
    left = spark.createDataFrame([(i, k, at(t)) for i, k, t in labels], "id long, k long, ts timestamp_ntz")
    right = spark.createDataFrame([(k, at(t), v) for k, t, v in features], "k long, ts timestamp_ntz, v double")
    return left, right


def expected(labels, features):
    out = []
    for i, k, t in labels:
        best = None
        if k is not None and t is not None:
            past = [(ft, v) for fk, ft, v in features if fk == k and ft is not None and ft <= t]
            best = max(past, key=lambda p: p[0])[1] if past else None
        out.append((i, best))
    return sorted(out)


def found(spark, labels, features, width=None):
    left, right = frames(spark, labels, features)
    out = point_in_time(left, right, {"k": "k"}, "ts", "ts", ["v"], width)
    return sorted((r["id"], r["v"]) for r in out.collect())


EDGE_LABELS = [(1, 7, 100), (2, 7, 99), (3, 7, 5), (4, None, 100), (5, 8, 100), (6, 9, None), (7, 7, 1000)]
EDGE_FEATURES = [(7, 100, 1.0), (7, 10, 2.0), (7, 500, None), (8, 200, 3.0), (None, 0, 4.0), (9, 0, 5.0)]


@pytest.mark.parametrize("width", [None, 1, 50_000_000, 1_000_000_000])
def test_edges(spark, width):
    """Equal times match, later rows never do, a null feature stays null, null keys match nothing."""
    got = found(spark, EDGE_LABELS, EDGE_FEATURES, width)
    assert got == expected(EDGE_LABELS, EDGE_FEATURES)
    assert dict(got) == {1: 1.0, 2: 2.0, 3: None, 4: None, 5: None, 6: None, 7: None}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), max_size=25),
    st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), max_size=25, unique=True),
    st.sampled_from([None, 7_000_000, 20_000_000]),
)
def test_never_later(spark, labels, features, width):
    left = [(i, k, t) for i, (k, t) in enumerate(labels)]
    right = [(k, t, float(t)) for k, t in features]
    assert found(spark, left, right, width) == expected(left, right)


def test_tile_width_only_for_busy_keys(spark):
    left, _ = frames(spark, [(i, 1, i) for i in range(100)] + [(200, 2, 5)], [])
    assert tile_width((left, ["k"], "ts"), rows_per_task=1000) is None
    width = tile_width((left, ["k"], "ts"), rows_per_task=10)
    assert 8_000_000 <= width <= 11_000_000


def test_key_lookup_keeps_unmatched(spark):
    labels = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id long, k long")
    table = spark.createDataFrame([(5, "a"), (9, "b")], "key long, name string")
    assert rows(key_lookup(labels, table, {"k": "key"}, ["name"])) == [(1, 5, "a"), (2, None, None), (3, 6, None)]
    with pytest.raises(ValueError, match="already present"):
        key_lookup(labels.withColumnRenamed("id", "name"), table, {"k": "key"}, ["name"])


def test_training_set_and_scoring(spark):
    from pyspark.sql import functions as F

    left, right = frames(spark, [(1, 7, 100), (2, 7, 1)], [(7, 50, 3.0)])
    labels = left.withColumn("y", F.lit(True))
    spec = FeatureLookup("t", "k", None, "ts")
    made = create_training_set(labels, [spec], {"t": (right, ["k"], "ts")}, "y", ["k", "ts"])
    assert made.load_df().columns == ["id", "y", "v"]
    scored = score_batch(made, lambda df: F.coalesce(df["v"], F.lit(0.0)) * 2, "int")
    assert sorted((r["id"], r["prediction"]) for r in scored.collect()) == [(1, 6), (2, 0)]
    with pytest.raises(ValueError, match="label column"):
        create_training_set(labels, [], {}, "nope").load_df()


def test_a_table_key_twice_is_an_error(spark):
    labels = spark.createDataFrame([(1, 5)], "id long, k long")
    table = spark.createDataFrame([(5, "a"), (5, "b")], "key long, name string")
    with pytest.raises(Exception, match="several rows for key"):
        key_lookup(labels, table, {"k": "key"}, ["name"]).collect()
    with pytest.raises(Exception, match="several rows for one time"):
        found(spark, [(1, 7, 5)], [(7, 1, 1.0), (7, 1, 2.0)])


def test_edges_follow_bursts(spark):
    """One row early, the rest within a thousand ticks, and a second large key: no tile holds much more than its share."""
    burst = [(1, 0)] + [(1, 10**12 + i) for i in range(999)] + [(2, 7 * i) for i in range(500)] + [(3, 1)]
    side = spark.createDataFrame(burst, "k long, t long")
    edges = tile_edges((side, ["k"], "t"), rows_per_task=100)
    cuts = {r["k0"]: r["edges"] for r in edges.collect()}
    assert set(cuts) == {1, 2}
    for key in cuts:
        tiles = {}
        for k, t in burst:
            if k == key:
                at = sum(c <= t for c in cuts[key])
                tiles[at] = tiles.get(at, 0) + 1
        assert max(tiles.values()) <= 130
    labels = spark.createDataFrame([(i, k, t + 1) for i, (k, t) in enumerate(burst)], "id long, k long, ts long")
    features = side.withColumnRenamed("t", "ts").selectExpr("k", "ts", "ts * 2 AS v")
    plain = point_in_time(labels, features, {"k": "k"}, "ts", "ts", ["v"])
    cut = point_in_time(labels, features, {"k": "k"}, "ts", "ts", ["v"], edges=edges)
    assert rows(plain) == rows(cut)
