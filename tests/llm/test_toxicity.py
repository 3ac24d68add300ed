import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity as T

WORDS = "the house was built near river with some stones under a large tree and people came there every summer to swim".split()
BAD = ["vermin", "dolt", "halfwit"]
LOOK = {"i": "1", "e": "3", "o": "0", "a": "4", "t": "7"}


def disguise(word, rnd):
    kind = rnd.choice(["plain", "look", "spaced", "repeat"])
    if kind == "look":
        return "".join(LOOK.get(c, c) for c in word)
    if kind == "spaced":
        return rnd.choice([" ", "."]).join(word)
    return word.replace(word[1], word[1] * 4, 1) if kind == "repeat" else word


def table(spark, n=1500, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rnd.choice(WORDS) for _ in range(rnd.randint(5, 60))]
        toxic = int(i % 6 == 0)
        for _ in range(toxic * rnd.randint(1, 3)):
            words.insert(rnd.randrange(len(words)), disguise(rnd.choice(BAD), rnd))
        rows.append((i, " ".join(words), "en", "s", toxic, 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, toxic int, score double")


def test_held_out_accuracy(spark):
    docs = table(spark)
    out = T.toxicity(docs, docs.select("doc_id", "toxic")).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert len(out) == 1500
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_read(spark):
    docs = table(spark, 300)
    labels = docs.select("doc_id", "toxic")
    flipped = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id"), 5), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, T.toxicity(docs, x).collect())) for x in (labels, flipped))
    assert one == two


@pytest.mark.parametrize("text, word", [("v3rm1n", "vermin"), ("v e r m i n", "vermin"), ("haaaalfwit", "halfwit"), ("d.o.l.t", "dolt"), ("h0use", "house")])
def test_restores(spark, text, word):
    model = T.CharModel(T.character_counts(table(spark, 300)))
    assert word in T.Restorer(model).words(f"this {text} here")


def test_odd_rows(spark):
    docs = table(spark, 100).select("doc_id", "text").union(
        spark.createDataFrame([(None, None), (7, ""), (7, ""), (9000, "1" * 5000 + "a" * 5000), (9001, "é🙂 " * 3000)], "doc_id long, text string")
    )
    labels = spark.createDataFrame([(7, None), (None, 1), (3, 1), (3, 0)], "doc_id long, toxic int")
    out = T.toxicity(docs, labels).collect()
    assert len(out) == 105 and all(0 <= r["score"] <= 1 for r in out)
    assert T.toxicity(docs.limit(0), labels.limit(0)).count() == 0
    assert T.toxicity(docs, labels.limit(0)).agg(F.countDistinct("score")).first()[0] == 1


@pytest.mark.parametrize(
    "text, word",
    [
        ("hous3", "house"), ("do17", "dolt"), ("halfw17", "halfwit"), ("sw1m", "swim"), ("und3r", "under"), ("vermmin", "vermin"), ("haalfwit", "halfwit"),
        ("v e r m i n,", "vermin"), ("v e r m i n!", "vermin"), ("(v e r m i n)", "vermin"), ("v-e-r-m-i-n,", "vermin"), ("v/e/r/m/i/n", "vermin"),
        ("v  e  r  m  i  n", "vermin"), ("v - e - r - m - i - n", "vermin"), ("v+e+r+m+i+n", "vermin"), ("'d.o.l.t'", "dolt"), ("a v e r m i n", "vermin"),
        ("v3rm1n/house", "vermin"), ("summer,d0lt", "dolt"), ("summer-d0lt", "summer"), ("v3rmin!", "vermin"),
    ],
)
def test_restores_every_disguise(spark, model, text, word):
    assert word in T.Restorer(model).words(f"this {text} here")


@pytest.fixture(scope="module")
def model(spark):
    return T.CharModel(T.character_counts(table(spark, 300)))


def every_reading(text, model, breaks):
    """Words and values of all paths through the lattice of a short stretch."""
    out = [("", 0, 0, 0.0)]
    for at in range(len(text)):
        following = []
        for c, cost in T._readings(text, at, breaks):
            for word, a, b, value in out:
                code = T.SYMBOLS.get(c, T.OTHER)
                if c == " ":
                    following.append((word + c, 0, 0, value + cost + (model.table[a][b][0] if b else 0.0)))
                elif c:
                    following.append((word + c, b, code, value + cost + model.table[a][b][code]))
                else:
                    following.append((word, a, b, value + cost))
        out = following
    return [(word, value if not b and word.strip() else value + model.table[a][b][0]) for word, a, b, value in out]


@pytest.mark.parametrize("breaks", [False, True])
def test_restored_words_are_the_likeliest_of_all(model, breaks):
    rnd = random.Random(5)
    for _ in range(150):
        text = "".join(rnd.choice("vermin0137@$!.-aae") for _ in range(rnd.randint(1, 7)))
        ways = every_reading(text, model, breaks)
        best = max(value for _, value in ways)
        assert T.restore(text, model, breaks) in {word for word, value in ways if value > best - 1e-9}


def test_settling_changes_nothing(model, monkeypatch):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdefgh0137@$.-") for _ in range(rnd.randint(50, 400))) for _ in range(20)]
    monkeypatch.setattr(T, "SETTLE", 10**9)
    plain = [T.restore(t, model, b) for t in texts for b in (False, True)]
    monkeypatch.setattr(T, "SETTLE", 3)
    assert plain == [T.restore(t, model, b) for t in texts for b in (False, True)]


def test_time_grows_with_the_length_of_a_run(model):
    rnd = random.Random(7)
    for letters in ("abcdefghijklmnopqrstuvwxyz0123456789", "1", "a1"):
        took = []
        for n in (20_000, 160_000):
            run = "".join(rnd.choice(letters) for _ in range(n))
            start = time.perf_counter()
            T.Restorer(model).words(run)
            took.append(time.perf_counter() - start)
        assert took[1] < 8 * 3 * took[0] + 1, (letters, took)
