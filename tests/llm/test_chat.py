import random

import pytest

from millrace.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, piece string"


def brute(rows):
    convs = {}
    for c, turn, role, text, _ in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    turns = {c: [(r if hr else None, t if ht else None) for _, _, hr, r, ht, t in sorted(v)] for c, v in convs.items()}
    alone = {}
    for c in sorted(turns):
        alone.setdefault(tuple(turns[c]), c)
    kept = [c for t, c in alone.items() if not any(len(u) > len(t) and u[: len(t)] == t for u in alone)]
    out = []
    for c in kept:
        at = 0
        for i, (r, t) in enumerate(turns[c]):
            piece = f"<|{r or ''}|>\n{t or ''}<|end|>\n"
            out.append((c, i + 1, r, piece, at))
            at += len(piece)
    return sorted(out, key=str)


def some_rows(n=60, seed=1):
    rnd = random.Random(seed)
    logs = [[(rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "yes", "", None, "é🙂" * 40])) for _ in range(rnd.randint(1, 6))] for _ in range(12)]
    rows = []
    for c in range(n):
        log, first = rnd.choice(logs), rnd.choice([0, 1, 7])
        rows += [(c, first + i, r, t, "x") for i, (r, t) in enumerate(log[: rnd.randint(1, len(log))])]
    rows += [(200 + c, 0, "user", "hello", "x") for c in range(30)] + [(300, 0, "user", "hello", "x"), (300, 1, "assistant", "well", "x")]
    rows += [(None, 0, "user", "lost", "x"), (400, None, "user", "when", "x"), (400, 1, "user", "then", "x"), (401, 5, "user", "twice", "x"), (401, 5, "user", "twice", "x")]
    return rows


@pytest.mark.parametrize("turns", [4096, 2])
def test_equals_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(C, "TURNS", turns)
    rows = some_rows()
    got = sorted(map(tuple, C.rendered(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=str)
    assert got == brute(rows)


def test_a_shared_first_turn_and_many_copies(spark):
    rows = [(c, 0, "user", "same", "x") for c in range(300)] + [(c, 1, "user", str(c % 3), "x") for c in range(200)]
    got = C.rendered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted({r["conv_id"] for r in got}) == [0, 1, 2]


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.rendered(empty).count() == 0
    plan = C.rendered(spark.createDataFrame(some_rows(5), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
