import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import gathered_tree as G
import reference as R
from millrace.llm import suffix_tree as S
from millrace.llm.toxicity import held_out

SCHEMA = "doc_id long, text string, score double"


def docs(spark, n=400, seed=2):
    rnd = random.Random(seed)
    syllables = ["ba", "ne", "tor", "mi", "sha", "qu", "é"]
    rows = [(i, " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.choice([0, 3, 40])))) for i in range(n)]
    rows += [(None, "Lost words"), (None, "Lost words"), (3, None), (3, "BA\tba\n\nBa."), (5000, "x" * 20_000), (5001, "🙂 \x0b w")]
    return rows, spark.createDataFrame([(i, t, 0.0) for i, t in rows], SCHEMA)


def test_counts_and_base_equal_brute_force(spark):
    rows, table = docs(spark)
    tokens = [[*R.WORD.findall(R.ascii_lower(t)), None] for _, t in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        want.append((str(i), h, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in S.score_texts(table, held_out(F.col("doc_id"), 10)).collect()]
    assert sorted(got) == sorted(want)


def test_scores_are_probabilities_of_the_tree(spark):
    rows, table = docs(spark)
    tree = G.grow_tree(table)
    assert tree.child.max() > 0  # some contexts stay
    assert np.allclose((10.0 ** tree.log).sum(1), 1, atol=1e-4)
    shares = np.bincount(S.CLASS, weights=10.0**tree.byte, minlength=S.CLASSES)
    assert np.allclose(shares[np.unique(S.CLASS)], 1)
    texts = [t for _, t in rows]
    for t, score in zip(texts, tree.score(texts)):
        body, total = S.stream(t), 0.0
        for at in range(S.DEPTH, len(body)):
            node = 0
            for back in range(1, S.DEPTH + 1):
                following = tree.child[node, S.CLASS[body[at - back]]]
                if not following:
                    break
                node = following
            total += float(tree.log[node, S.CLASS[body[at]]]) + tree.byte[body[at]]
        assert score == pytest.approx(total, rel=1e-5, abs=1e-4)


def test_beats_the_base_on_held_out_text(spark):
    rnd, vocabulary = random.Random(8), ["tan", "mo", "wel", "sib", "ru", "kad", "ple", "xo", "fin", "gah", "luz", "ver"]

    def text():
        at, out = rnd.randrange(12), []
        for _ in range(40):  # a word mostly calls for the next one
            at = (at + 1) % 12 if rnd.random() < 0.9 else rnd.randrange(12)
            out.append(vocabulary[at])
        return " ".join(out)

    rows = [(i, text(), 0.0) for i in range(800)]
    out = S.score_texts(spark.createDataFrame(rows, SCHEMA), held_out(F.col("doc_id"), 10)).filter("held_out")
    row = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row["s"] > row["b"]


def test_unknown_words_cost_and_layout_does_not_matter(spark):
    _, table = docs(spark, 200)
    one = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in S.score_texts(table, held_out(F.col("doc_id"), 10)).collect())
    two = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in S.score_texts(table.repartition(7), held_out(F.col("doc_id"), 10)).collect())
    assert one == two


def test_empty_and_all_held_out(spark):
    _, table = docs(spark, 20)
    assert S.score_texts(table.limit(0), F.lit(False)).count() == 0
    out = S.score_texts(table, F.lit(True)).collect()
    assert {r["n_known"] for r in out} == {0} and {r["train_tokens"] for r in out} == {0} and all(r["score"] < 0 for r in out)


def test_scores_equal_the_gathered_tree(spark):
    rows, table = docs(spark)
    held = held_out(F.col("doc_id"), 10)
    tree = G.grow_tree(table.filter(~held))
    got = sorted((str(r["doc_id"]), round(r["score"], 4)) for r in S.score_texts(table, held).collect())
    want = sorted((str(i), round(float(s), 4)) for (i, _), s in zip(rows, tree.score([t for _, t in rows])))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(a == pytest.approx(b, rel=1e-4, abs=1e-3) for (_, a), (_, b) in zip(got, want))


def test_rare_contexts_stay_however_large_the_corpus(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(["stone", "river", "house", "under", "a"], k=10_000)), 0.0) for i in range(1, 45)]
    rows += [(i, "jqxvzk", 0.0) for i in (-1, -2, -3)] + [(0, "jqxvzk", 0.0)]  # three times in over two million symbols
    out = S.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("doc_id") == 0).filter("doc_id = 0").first()
    assert out["score"] > -12


def swapped(n):
    """The Thue-Morse word of so many letters and its complement: sums of powers modulo 2^64 cannot tell them apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_repetitive_words_are_told_apart(spark):
    one, two = swapped(1024)
    rows = [(i, one, 0.0) for i in (1, 2, 3)] + [(0, two, 0.0)]
    out = S.score_texts(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") == 0).filter("doc_id = 0").first()
    assert out["n_known"] == 1  # the end
    assert out["base_score"] == pytest.approx(math.log10(0.1 / (6 + 0.1 * 3)) + math.log10(3.1 / (6 + 0.1 * 3)))


def test_codes_that_share_a_half():
    high, low = np.array([7, 3, 7, 7, 3], np.uint64), np.array([2, 9, 1, 2, 9], np.uint64)
    table = S._merged([(high, low, np.ones(5, np.int64))])
    assert [t.tolist() for t in table] == [[3, 7, 7], [9, 1, 2], [2, 1, 2]]
    assert S._found(np.array([7, 3, 7], np.uint64), np.array([2, 9, 1], np.uint64), table).tolist() == [2, 2, 1]


def test_slots_are_alike_in_weight_and_keep_branches_whole():
    rnd = np.random.default_rng(0)
    counts = rnd.integers(0, 50, S.CLASSES ** (S.SHORT + 1))
    edges = S.slot_edges(counts, 8)
    table = counts.reshape([S.CLASSES] * 3)
    # branch (newest, middle, oldest) is the string oldest, middle, newest: newest follows the context (middle, oldest)
    weight = np.array([table[m, o, s] for s in range(64) for m in range(64) for o in range(64)])
    shares = np.bincount(np.searchsorted(edges, np.arange(len(weight)), side="right"), weights=weight, minlength=8) / weight.sum()
    assert np.allclose(shares, 1 / 8, atol=0.01) and (np.diff(edges) > 0).all()


def test_many_buckets_give_the_same_scores(spark, monkeypatch):
    _, table = docs(spark, 200)
    one = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in S.score_texts(table, held_out(F.col("doc_id"), 10)).collect())
    monkeypatch.setattr(S, "BUCKET_BYTES", 3000)
    assert one == sorted((str(r["doc_id"]), round(r["score"], 6)) for r in S.score_texts(table, held_out(F.col("doc_id"), 10)).collect())
