from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string"


def docs(spark, n=900):
    rows = [(i, "w " * (i * i % 50), None if i % 9 == 0 else f"s{i % 4 if i % 3 else 0}", "x") for i in range(n)]
    rows += [(n, None, "s1", "x"), (n, None, "s1", "x"), (None, "a b c", "s2", "x"), (n + 1, "", "empty", "x")]
    return spark.createDataFrame(rows, SCHEMA)


def level_targets(sizes, weights, share, limit):
    """Fill by weight, cap, deal the excess out again until nobody is above."""
    left, open_ = Fraction(share) * sum(sizes.values()), dict(sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    out = {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > limit * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = Fraction(limit * sizes[s])
            left -= out[s]
            del open_[s]
    return out


@pytest.mark.parametrize("weights, share, limit", [((3, 1, 2), 1.5, 2), ((1,), 0.25, 2), ((9, 1), 2.5, 3), ((1, 2), 5, 2)])
def test_targets_and_totals(spark, weights, share, limit):
    got = M.copies(docs(spark), weights, share, limit).select("row.*", F.col("size").alias("words"), "source_size", "target", "copies").collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    want = level_targets(sizes, weights, share, limit)
    assert len(got) == 904
    for r in got:
        assert r["words"] == len((r["text"] or "").split()) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]])) and 0 <= r["copies"] <= limit
    for s, size in sizes.items():
        taken = sum(r["words"] * r["copies"] for r in got if r["source"] == s)
        assert abs(taken - want[s]) <= 50 * limit  # the largest document's worth


def test_reruns_and_layouts_agree_and_seeds_differ(spark):
    table = docs(spark)

    def taken(df, **more):
        rows = M.copies(df, **more).groupBy("row.doc_id").agg(F.sum("copies").alias("n")).collect()
        return {r["doc_id"]: r["n"] for r in rows}

    one = taken(table)
    assert one == taken(table.repartition(7)) and one != taken(table, seed=7)


def test_mix_repeats_rows_and_keeps_columns(spark):
    table = docs(spark)
    out = M.mixed(table)
    assert out.columns == table.columns
    times = {r["doc_id"]: r["n"] for r in M.copies(table).groupBy("row.doc_id").agg(F.sum("copies").alias("n")).collect()}
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in times.items() if v}


def test_empty(spark):
    assert M.copies(docs(spark).limit(0)).count() == 0
    assert M.copies(docs(spark).filter("source = 'empty'")).first()["copies"] == 0
