import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import reference as R
from millrace.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, lang string, body int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 7) for i, t in rows], SCHEMA)


def some_rows(seed=2, n=120):
    rnd = random.Random(seed)

    def text(k):
        return "".join(rnd.choice("ab cdé\n日") for _ in range(k))

    passages = [text(rnd.choice([60, 100, 101, 130, 400])) for _ in range(8)] + ["x" * 250, "ab" * 180, "line of words that repeats\n" * 12]
    out = [(0, ""), (1, None), (2, "a" * 99), (3, "a" * 100), (4, "a" * 101), (5, "b" * 1000), (6, text(20_000))]
    for i in range(n):
        parts = [text(rnd.choice([0, 5, 50, 300]))]
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            p = rnd.choice(passages)
            parts += [p[rnd.randrange(30) :] if rnd.random() < 0.3 else p, text(rnd.choice([0, 3, 40]))]
        out.append((10 + i, "".join(parts)))
    out += [(500 + i, out[5 + i][1]) for i in range(min(30, n))]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("chunk, piece, many", [(1_500_000, 48_000_000, 1_500_000), (2_000, 3_000, 1_500_000), (1_500_000, 48_000_000, 50)])
def test_equals_brute_force(spark, monkeypatch, chunk, piece, many):
    for name, value in (("CHUNK", chunk), ("PIECE", piece), ("MANY", many), ("BLOCK", 5_000)):
        monkeypatch.setattr(S, name, value)
    rows = some_rows()
    got = sorted(map(tuple, S.suffix_report(docs(spark, rows)).collect()))
    assert got == sorted(R.suffix_digest(rows))


def test_one_passage_fills_buckets(spark, monkeypatch):
    """Every document shares one passage, so its codes fill whole buckets and are compared in pieces."""
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(140))
    rows = [(i, f"{rnd.random()} {passage} {rnd.random() if i % 3 else ''}") for i in range(400)]
    monkeypatch.setattr(S, "PIECE", 4_000)
    monkeypatch.setattr(S, "CHUNK", 1_000)
    got = sorted(map(tuple, S.suffix_report(docs(spark, rows).repartition(5)).collect()))
    assert got == sorted(R.suffix_digest(rows))


def test_full_codes_are_dealt_to_pieces(spark, monkeypatch):
    rows = [(i, "z" * 300) for i in range(40)] + [(99, "z" * 150 + "y" * 100)]
    got = sorted(map(tuple, S.suffix_report(docs(spark, rows)).collect()))
    assert got == sorted(R.suffix_digest(rows))


def test_other_lengths(spark):
    rows = some_rows(5, 40)
    got = sorted(map(tuple, S.suffix_report(docs(spark, rows), 64).collect()))
    assert got == sorted(R.suffix_digest(rows, 64))


def test_missing_and_repeated_ids(spark):
    a, b = "q" * 50 + "".join(map(str, range(60))), "other text " * 12
    rows = [(None, a), (None, b), (3, a), (3, a), (3, b + "!"), (3, None)]
    got = S.suffix_report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    # the rows without id come first; what they hold is gone from the others
    assert {r["n_removed"] for r in got if r["doc_id"] is None} >= {0}
    assert [r["n_removed"] for r in got if r["doc_id"] == 3 and r["n_bytes"] == len(a)] == [len(a)] * 2


def test_texts_without_repeats(spark):
    rows = some_rows(6, 40)
    table = docs(spark, rows).withColumnRenamed("lang", "_kept")
    out = S.drop_repeats(table)
    assert out.columns == table.columns
    want = {i: bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for i, b, gone in R.earlier_bytes(rows)}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_empty(spark):
    assert S.suffix_report(docs(spark, [])).count() == 0
    assert S.suffix_report(docs(spark, [(1, None)])).first()["n_spans"] == 0


def test_multikey_order():
    rnd = np.random.default_rng(1)
    tokens = [rnd.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order, new = S.multikey_order(tokens)
    keys = [tuple(int(t[i]) for t in tokens) for i in range(500)]
    assert sorted(order.tolist()) == list(range(500))
    runs = np.cumsum(new)
    assert len(set(runs.tolist())) == len(set(keys))
    assert all((keys[order[i]] == keys[order[i + 1]]) == (runs[i] == runs[i + 1]) for i in range(499))
