import random

import pytest

from millrace.operators.rolling import Rolling, frame_load, rolling

WEEK = 7 * 86_400


def data(n=300):
    rnd = random.Random(3)
    out = [(i, rnd.choice([1, 2, None]), rnd.randrange(0, 90 * 86_400), rnd.choice([None, round(rnd.uniform(-50, 50), 2)]), rnd.randrange(2)) for i in range(n)]
    # Exactly a week apart, a week and a second apart, and two rows in one second.
    edge = [(n, 9, 0, 1.0, 1), (n + 1, 9, WEEK, 2.0, 1), (n + 2, 9, WEEK + 1, 4.0, 0), (n + 3, 9, WEEK + 1, 8.0, 1)]
    return out + edge


def brute(rows, exclude=False):
    out = {}
    for i, k, s, _, _ in rows:
        frame = [r for r in rows if r[1] == k and s - WEEK <= r[2] <= s - (1 if exclude else 0)]
        far = [r for r in rows if r[1] == k and s - 30 * 86_400 <= r[2] <= s - (1 if exclude else 0)]
        known = [r[3] for r in frame if r[3] is not None]
        out[i] = (round(sum(known), 4) if known else None, len(frame), sum(r[4] for r in far) if far else None)
    return out


SPECS = [Rolling("total", "price", WEEK), Rolling("n", None, WEEK), Rolling("bought", "flag", 30 * 86_400)]


@pytest.mark.parametrize("strategy", ["frames", "totals", "auto"])
@pytest.mark.parametrize("exclude", [False, True])
def test_equals_brute_force(spark, strategy, exclude):
    rows = data()
    df = spark.createDataFrame(rows, "id long, k long, s long, price double, flag int")
    out = rolling(df, ["k"], "s", SPECS, strategy, exclude).collect()
    got = {r["id"]: (None if r["total"] is None else round(r["total"], 4), r["n"], r["bought"]) for r in out}
    want = brute(rows, exclude)
    assert {k: (v[0], v[1] or 0, v[2]) for k, v in got.items()} == want


def test_cancels_without_residue(spark):
    """A huge amount that left the frame leaves nothing behind."""
    rows = [(0, 1, 0, 1e15), (1, 1, 10, 0.1), (2, 1, WEEK + 5, 0.2)]
    df = spark.createDataFrame(rows, "id long, k long, s long, price double")
    out = rolling(df, ["k"], "s", [Rolling("total", "price", WEEK)], "totals")
    assert {r["id"]: r["total"] for r in out.collect()}[2] == pytest.approx(0.3, abs=1e-12)


def test_frame_load(spark):
    df = spark.createDataFrame([(1, s) for s in range(100)] + [(2, 5)], "k long, s long")
    mean, largest = frame_load(df, ["k"], "s", 50)
    assert largest == 100
    assert 49 <= mean <= 50


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        rolling(spark.range(1).selectExpr("id k", "id s"), ["k"], "s", [], "guess")


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize(
    "kind, values",
    [
        ("decimal(10,2)", [1.75, 2.5, None, -3.25, 99999999.99]),
        ("double", [1e-12, 3e-12, 1e30, float("nan"), float("inf"), None, 0.1]),
        ("float", [0.5, 1e-3, None]),
        ("bigint", [1, None, -7, 2**40]),
    ],
)
def test_strategies_agree(spark, kind, values, exclude):
    """The answer and its type do not depend on the strategy: decimals, NaN, infinities, tiny and huge amounts, null times."""
    from decimal import Decimal

    rnd = random.Random(5)

    def amount():
        x = rnd.choice(values)
        return Decimal(str(x)) if x is not None and kind.startswith("decimal") else x

    rows = [(i, rnd.choice([1, 2, None]), rnd.choice([None, rnd.randrange(-40, 400)]), amount()) for i in range(400)]
    df = spark.createDataFrame(rows, f"id long, k long, s long, price {kind}")
    specs = [Rolling("total", "price", 50), Rolling("n", None, 50), Rolling("longer", "price", 173)]
    by = {s: rolling(df, ["k"], "s", specs, s, exclude) for s in ("frames", "totals")}
    assert by["frames"].dtypes == by["totals"].dtypes
    plain = {s: {r["id"]: r for r in d.collect()} for s, d in by.items()}
    for i, a in plain["frames"].items():
        b = plain["totals"][i]
        assert a["n"] == b["n"], (a, b)
        for c in ("total", "longer"):
            assert a[c] == b[c] or (a[c] is not None and b[c] is not None and b[c] == pytest.approx(a[c], rel=1e-9, nan_ok=True)), (a, b)
