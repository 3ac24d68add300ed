import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import simhash as S
from millrace.llm.components import components
import reference as R

SCHEMA = "doc_id long, text string, lang string, fp string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x") for i, t in rows], SCHEMA)


def some_rows(n=150, seed=3):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.choice([1, 2, 3, 40, 300]))) for _ in range(30)]
    out = [(None, "lost"), (None, None), (900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (5, "dup dup"), (5, "dup dup"), (5, "other")]
    for i in range(n):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words[rnd.randrange(len(words))] = "zz"
        out.append((1000 + i, " ".join(words).upper() if i % 5 == 0 else "  ".join(words)))
    return out


@pytest.mark.parametrize("hot", [2048, 3])
def test_equals_brute_force(spark, hot):
    rows = some_rows()
    got = sorted(map(tuple, S.near_duplicates(docs(spark, rows), hot=hot).collect()), key=str)
    assert got == sorted(R.simhash_groups(rows), key=str)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("hot", [4096, 5])
def test_links_connect_what_pairs_connect(spark, distance, hot):
    rnd = random.Random(distance)
    values = set()
    for _ in range(12):  # clusters around centres that share most bits: crowded buckets
        centre = rnd.getrandbits(12) << 50 | 0x2AAAAAAAA
        for _ in range(25):
            v = centre
            for _ in range(rnd.randrange(4)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long").repartition(3)
    found = S.links(table, distance, hot).collect()
    edges = {(a & (2**64 - 1), b & (2**64 - 1)) for a, b in found}
    assert len(edges) < 20 * len(values)
    want = R.closest(values, lambda a, b: (a ^ b).bit_count() <= distance)
    got = R.closest(values, lambda a, b: (a, b) in edges or (b, a) in edges)
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_thresholds_sum_as_the_rule_asks():
    for m in (1, 2, 3, 4):
        costs = [{-1: 0.0, 0: 10.0 * (i + 1), 1: 30.0, 2: 100.0} for i in range(m)]
        cost, chosen = S.allocate(costs, 2 - m + 1)
        assert sum(chosen) == 3 - m and cost == sum(c[t] for c, t in zip(costs, chosen))
    assert S.ball(10, 2) == 1 + 10 + 45


def test_correlated_bits_share_a_part():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 2, (4000, 64)).astype(float)
    for b in (9, 23, 41):
        x[:, b] = x[:, 5]
    parts = S.correlated_parts(np.vstack([x.T @ x, np.full(64, len(x))]), 3)
    assert sorted(sum(parts, [])) == list(range(64))
    assert any({5, 9, 23, 41} <= set(p) for p in parts)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 2000 + i) for i in range(300)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(101)} == {0} and {got[2000 + i] for i in range(300)} == {1000} and len(got) == 402
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = some_rows(60)
    table = docs(spark, rows).withColumn("_winner", F.lit(1))
    kept = S.drop_near_duplicates(table)
    assert kept.columns == table.columns
    got = [r["doc_id"] for r in kept.collect()]
    groups = R.simhash_groups(rows)
    named = {c for _, _, c in groups if c is not None}
    assert sorted(i for i in got if i is not None) == sorted(named)
    nameless = {f for i, f, c in groups if c is None}
    assert sum(i is None for i in got) == len(nameless)


def test_empty_table(spark):
    assert S.near_duplicates(docs(spark, [])).count() == 0
    assert S.drop_near_duplicates(docs(spark, [])).count() == 0
