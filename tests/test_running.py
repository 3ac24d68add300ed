import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.running import hash_rank, quantiles, running_totals, split_points, with_tile


def values(n=400):
    rnd = random.Random(5)
    # One group holds most rows and one value a third of them.
    return [
        ("hot" if rnd.random() < 0.8 else rnd.choice(["a", None]), 7.0 if rnd.random() < 0.33 else round(rnd.gauss(0, 10), 1))
        for _ in range(n)
    ]


@pytest.mark.parametrize("cuts", [[], [0.0], [-10.0, -1.0, 0.0, 7.0, 7.5, 12.0]])
def test_quantiles_equal_numpy(spark, cuts):
    data = values()
    df = spark.createDataFrame(data + [("a", None)], "g string, v double")
    out = quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, cuts=cuts).collect()
    assert len(out) == 3
    for r in out:
        mine = [v for g, v in data if g == r["g"]]
        assert [r["p10"], r["p50"], r["p99"]] == pytest.approx(list(np.quantile(mine, [0.1, 0.5, 0.99])))


def test_running_totals_any_tiles(spark):
    data = [(i, i // 3) for i in range(50)]
    df = spark.createDataFrame(data, "id long, o long")
    for width in (1, 7, 100):
        out = running_totals(df.withColumn("_tile", F.floor(F.col("o") / width)), [], ["o"], {"n": F.lit(1)}).collect()
        assert {r["id"]: r["n"] for r in out} == {i: sum(1 for _, p in data if p <= o) for i, o in data}
        assert {r["n_total"] for r in out} == {50}


def test_running_totals_descending(spark):
    df = spark.range(40).withColumn("_tile", F.floor(F.col("id") / 8))
    out = running_totals(df, [], [F.desc("id")], {"n": F.lit(1)}, tile_descending=True).collect()
    assert {r["id"]: r["n"] for r in out} == {i: 40 - i for i in range(40)}


def test_hash_rank_is_a_numbering(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    out = hash_rank(df, ["g"], F.xxhash64("id"), F.col("id"), "r").collect()
    for g in range(3):
        mine = [r for r in out if r["g"] == g]
        assert sorted(r["r"] for r in mine) == list(range(1, len(mine) + 1))
        assert {r["r_total"] for r in mine} == {len(mine)}


def test_split_points_and_tiles(spark):
    df = spark.range(1000).selectExpr("cast(id as double) v").unionByName(
        spark.createDataFrame([(None,), (float("nan"),)], "v double")
    )
    cuts = split_points(df, ["v"], tiles=4, sample=1.0)["v"]
    assert cuts == sorted(set(cuts)) and 1 <= len(cuts) <= 3
    tiles = with_tile(df, "v", cuts).groupBy("_tile").count().collect()
    assert sum(r["count"] for r in tiles) == 1002
