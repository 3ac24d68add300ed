import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions.text import chunks, html_to_text, spread_sentences
from millrace.operators import corpus
from millrace.operators.retrieve import answer_batch, embed_text, knn, knn_lsh
from millrace.sources.files import read_xml

POSTS = """<?xml version="1.0"?><posts>
<row Id="1" Score="9" Body="&lt;p&gt;How to &lt;b&gt;prune&lt;/b&gt;?&lt;/p&gt;" />
<row Id="2" Score="7" ParentId="1" Body="&lt;script&gt;x()&lt;/script&gt;Cut &amp;amp; wait" />
<row Id="3" Score="1" ParentId="1" Body="bad" />
<row Id="4" Score="8" ParentId="99" Body="orphan" />
<row Id="5" Score="6" Body="Second?" />
</posts>"""


def test_posts_to_documents(spark, scratch, tmp_path):
    path = tmp_path / "posts.xml"
    path.write_text(POSTS)
    posts = read_xml(spark, str(path), "row", "_Id long, _ParentId long, _Score long, _Body string")
    text = corpus.posts_to_text(posts, "_Id", "_ParentId", "_Body", "_Score").select("id", "body", "parent_id")
    assert rows(text, "id") == [(1, "How to prune ?", None), (2, "Cut & wait", 1), (4, "orphan", 99), (5, "Second?", None)]
    docs = corpus.qa_documents(corpus.qa_pairs(text))
    assert rows(docs) == [(2, "How to prune ?\n\nCut & wait")]


def one(spark, col):
    return spark.range(1).select(col).first()[0]


def test_text_functions(spark):
    page = "<html><!-- a <b> --><STYLE>p{}</STYLE><p>1 &lt; 2&nbsp;&amp;lt;</p>\n <br/>x</html>"
    assert one(spark, html_to_text(F.lit(page))) == "1 < 2 &lt; x"
    text = "".join(random.Random(1).choice("abc ") for _ in range(2345))
    parts = one(spark, chunks(F.lit(text), 100, 10))
    assert parts[0] + "".join(p[10:] for p in parts[1:]) == text and max(map(len, parts)) == 100
    assert one(spark, chunks(F.lit("short"), 100, 10)) == ["short"]
    assert one(spark, spread_sentences(F.lit("One. Two. Three. Four"), 12)) == "One. Three."
    assert one(spark, spread_sentences(F.lit("One. Two."), 12)) == "One. Two."
    assert one(spark, spread_sentences(F.lit("no end here"), 5)) == "no end here"


def test_html_references_and_quotes(spark):
    page = """<p title="a > b" data-x='c > d'>caf&eacute; &#8217;&#x27;&mdash;&copy;2 &lt 3 &amp;amp; x<a href="unclosed>y</a> 1 < 2</p>"""
    assert one(spark, html_to_text(F.lit(page))) == "caf\u00e9 \u2019'\u2014\u00a92 < 3 &amp; x y 1 < 2"
    assert one(spark, html_to_text(F.lit(None).cast("string"))) is None


def test_pages_keep_no_references(spark):
    from conftest import SF

    pages = spark.read.parquet(f"{SF}/pages.parquet").select(html_to_text(F.col("html")).alias("t"))
    assert pages.filter(F.col("t").rlike("&[A-Za-z]+;|&#")).count() == 0


def test_prompts_keep_braces_of_texts(spark):
    df = spark.createDataFrame([(["{question}", "b"], "why?"), (None, None)], "c array<string>, q string")
    out = corpus.build_prompts(df, "C:{context}|Q:{question}|H:{history}.", "c", "q").select("prompt")
    assert {r[0] for r in out.collect()} == {"C:|Q:|H:.", "C:{question}\n\nb|Q:why?|H:."}


def test_shorten_with_hook(spark):
    df = spark.createDataFrame([("x" * 20,), ("short",)], "t string")
    out = corpus.shorten(df, "t", 10, hook=lambda c: F.concat(F.lit("sum:"), F.substring(c, 1, 2)))
    assert sorted(r["text_short"] for r in out.collect()) == ["short", "sum:xx"]


def test_hook_as_iterator_udf(spark):
    """A model hook loads once per task and sees batches."""
    from collections.abc import Iterator

    import pandas as pd

    @F.pandas_udf("string")
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        prefix = "model:"
        for texts in batches:
            yield prefix + texts.str.slice(0, 2)

    df = spark.createDataFrame([("x" * 20,), ("short",)], "t string")
    out = corpus.shorten(df, "t", 10, hook=model)
    assert sorted(r["text_short"] for r in out.collect()) == ["model:xx", "short"]


def turns(spark, n=37):
    return spark.createDataFrame([(c, t, f"w{t} " * (t % 4)) for c in (1, 2) for t in range(n)], "conv long, turn long, text string")


@pytest.mark.parametrize("cut", [1, 2, 5, 1000])
def test_dialogue_context(spark, cut):
    df = turns(spark).filter("turn % 3 <> 1")
    got = rows(corpus.dialogue_context(df, "conv", "turn", "text", 3, "|", turns=cut))
    data = sorted(tuple(r) for r in df.collect())
    want = []
    for c in (1, 2):
        mine = [r for r in data if r[0] == c]
        want += [(c, r[1], "|".join(x[2] for x in mine[max(0, i - 2) : i + 1])) for i, r in enumerate(mine)]
    assert got == sorted(want)


@pytest.mark.parametrize("cut", [3, 1000])
def test_trim_history(spark, cut):
    got = rows(corpus.trim_history(turns(spark), "conv", "turn", "text", 10, cut).select("conv", "turn"))
    want, total = [], 0
    for t in range(36, -1, -1):
        total += t % 4
        if total <= 10:
            want.append(t)
    assert got == sorted((c, t) for c in (1, 2) for t in want)


@pytest.mark.parametrize("piece", [1, 4, 200])
def test_recent_sources(spark, piece):
    rnd = random.Random(4)
    data = [(c, t, [f"d{x}" for x in rnd.sample(range(5), 2)]) for c in (1, 2, 3) for t in range(30)]
    data += [(4, t, ["a", "b"]) for t in range(30)]  # everything is dropped after the first turn
    df = spark.createDataFrame(data, "conv long, turn long, found array<string>")
    got = rows(corpus.dedupe_recent_sources(df, "conv", "turn", "found", 3, piece))
    want = []
    for c in (1, 2, 3, 4):
        used = []
        for _, t, found in sorted(d for d in data if d[0] == c):
            kept = [s for s in found if s not in used[-3:]]
            used += kept
            want.append((c, t, kept))
    assert got == sorted(want)


def vectors(spark, n=60, d=8, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d)).round(2)
    x[5] = x[4]  # a duplicate: equal scores, smaller id first
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, vector array<double>")


def brute(x, k, exclude):
    out = []
    for i in range(len(x)):
        s = np.round(x @ x[i], 9)
        order = sorted((j for j in range(len(x)) if not (exclude and j == i)), key=lambda j: (-s[j], j))[:k]
        out += [(i, j, r + 1) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("strategy", ["broadcast", "blocks", "auto"])
def test_knn(spark, strategy, monkeypatch):
    monkeypatch.setattr("millrace.operators.retrieve.BLOCK_ROWS", 17)
    x, df = vectors(spark)
    out = knn(df.withColumnRenamed("vec_id", "query_id"), df.repartition(5), 4, True, strategy)
    assert rows(out.select("query_id", "vec_id", "rank")) == brute(x, 4, True)


def test_knn_blocks_many(spark):
    from millrace.operators.retrieve import _knn_blocks, _top

    x, df = vectors(spark)
    out = _top(_knn_blocks(df.withColumnRenamed("vec_id", "query_id"), df, 4, False, block_rows=13), 4)
    assert rows(out.select("query_id", "vec_id", "rank")) == brute(x, 4, False)


def test_lsh_finds_mostly_the_same(spark):
    _, df = vectors(spark, 200, 16)
    queries = df.withColumnRenamed("vec_id", "query_id")
    exact = {tuple(r) for r in knn(queries, df, 1).select("query_id", "vec_id").collect()}
    near = {tuple(r) for r in knn_lsh(queries, df, 1, 16, bands=12, bits=4).select("query_id", "vec_id").collect()}
    assert len(exact & near) >= 190
    blocks = knn_lsh(queries, df, 1, 16, bands=12, bits=4, block_rows=7).select("query_id", "vec_id")
    assert {tuple(r) for r in blocks.collect()} == near
    assert knn(queries.limit(0), df, 3).count() == 0


def test_text_vectors_and_answers(spark):
    texts = spark.createDataFrame([(1, "roses need sun"), (2, "ferns like shade"), (3, "")], "vec_id long, text string")
    embedded = embed_text(texts, "vec_id", "text", 64)
    norms = [round(sum(v * v for v in r["vector"]), 6) for r in embedded.orderBy("vec_id").collect()]
    assert norms == [1.0, 1.0, 0.0]
    asked = embedded.filter("vec_id = 2").select(F.col("vec_id").alias("query_id"), F.lit("shade?").alias("question"), "vector")
    out = answer_batch(asked, embedded, texts, "{context}|{question}", 1).first()
    assert out["response"]["answer"] == "ferns like shade" and out["response"]["sources"] == ["2"]
    assert out["prompt"] == "ferns like shade|shade?"
    hooked = answer_batch(asked, embedded, texts, "{question}", 1, hook=F.upper, partitions=1).first()
    assert hooked["response"]["answer"] == "SHADE?"


def test_null_vectors_take_no_part(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.5, 0.0])], "vec_id long, vector array<double>")
    queries = df.withColumnRenamed("vec_id", "query_id")
    assert rows(knn(queries, df, 1, exclude_self=True).select("query_id", "vec_id")) == [(1, 3), (3, 1)]
    assert rows(knn_lsh(queries, df, 1, 2, bands=8, bits=1, exclude_self=True).select("query_id", "vec_id")) == [(1, 3), (3, 1)]


def test_a_hit_without_text_is_still_a_source(spark):
    vectors = spark.createDataFrame([(1, [1.0]), (2, [0.5])], "vec_id long, vector array<double>")
    texts = spark.createDataFrame([(2, "second")], "vec_id long, text string")
    asked = spark.createDataFrame([(9, "q?", [1.0])], "query_id long, question string, vector array<double>")
    row = answer_batch(asked, vectors, texts, "{context}|{question}", 2).first()
    assert row["response"]["sources"] == ["1", "2"] and row["response"]["answer"] == "second" and row["prompt"] == "second|q?"


def test_turns_told_by_time_and_turns_with_many_rows(spark):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    data = [(1, t0 + timedelta(minutes=i // 3), f"w{i} x") for i in range(600)]
    df = spark.createDataFrame(data, "c long, t timestamp, text string")
    kept = corpus.trim_history(df, "c", "t", "text", 60, turns=5)
    assert kept.count() == 30 and kept.agg(F.min("t")).first()[0] == t0 + timedelta(minutes=190)
    assert corpus.dialogue_context(df, "c", "t", "text").count() == 600


def test_references_equal_the_standard_library(spark):
    import html

    from millrace.functions.text import unescaped

    texts = ["&amp;lt;", "&unknownthing; &", "&#65;&#x41;&#X41", "&#150;&#0;&#xD800;&#99999999;", "a&b&&c;", "&Eacute;&eacute &AMP;", "&lt 3", "", "&hearts;&NotEqualTilde;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescaped(F.col("t")).alias("u")).collect()
    assert {r["t"]: r["u"] for r in got} == {t: html.unescape(t) for t in texts}


def test_registered_lsh_finds_nine_in_ten(spark):
    from conftest import SF
    from millrace.plans import QUERIES

    near, exact = ({(r["query_id"], r["vec_id"]) for r in QUERIES[name](spark, SF).collect()} for name in ("knn_lsh", "knn_topk"))
    assert len(near & exact) >= 0.9 * len(exact)


def test_lsh_defaults_find_nine_in_ten(spark):
    from conftest import SF

    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    queries = vectors.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    exact, near = (
        {(r["query_id"], r["vec_id"]) for r in found.collect()}
        for found in (knn(queries, vectors, 5, exclude_self=True), knn_lsh(queries, vectors, 5, 64, exclude_self=True))
    )
    assert len(near & exact) >= 0.9 * len(exact)


def test_a_task_holds_a_bounded_number_of_scores():
    import tracemalloc

    from millrace.operators.retrieve import Best

    rnd = np.random.default_rng(5)
    q, x = rnd.normal(size=(512, 8)), rnd.normal(size=(50_000, 8)).astype(np.float32)
    best = Best(np.arange(512), q, 3, True)
    tracemalloc.start()
    for at in range(0, len(x), 10_000):
        best.add(np.arange(at, at + 10_000), x[at : at + 10_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000  # one product with all vectors has 205 MB
    scores = np.round(q @ x.T.astype(float), 9)
    scores[np.arange(512), np.arange(512)] = -np.inf
    assert best.ids.reshape(512, 3).tolist() == np.argsort(-scores, axis=1, kind="stable")[:, :3].tolist()


def test_ties_and_undefined_scores():
    from millrace.operators.retrieve import Best

    best = Best(np.array([1, 2]), np.array([[1.0, 0.0], [0.0, 1.0]]), 2, False)
    best.add(np.array([9, 4, 7]), np.array([[1.0, np.nan], [1.0, 0.0], [np.inf, 0.0]]))
    best.add(np.array([8, 3, 5]), np.array([[1.0, 2.0], [1.0 + 1e-12, 0.0], [0.5, 0.0]]))
    assert list(zip(best.q_ids[best.row].tolist(), best.ids.tolist(), best.score.tolist())) == [(1, 3, 1.0), (1, 4, 1.0), (2, 8, 2.0), (2, 3, 0.0)]


def test_small_tables_are_spread_over_the_tasks(spark, monkeypatch):
    from millrace.operators import retrieve
    from millrace.operators.retrieve import _knn_blocks

    monkeypatch.setattr(retrieve, "parallelism", lambda session: 16)
    _, df = vectors(spark, 400)
    hits = _knn_blocks(df.withColumnRenamed("vec_id", "query_id").repartition(6), df.repartition(6), 2, True)
    assert hits.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("strategy", ["broadcast", "blocks"])
def test_null_ids(spark, strategy):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (None, [2.0, 0.0]), (3, [0.5, 0.0])], "vec_id long, vector array<double>")
    queries = df.withColumnRenamed("vec_id", "query_id")
    assert rows(knn(queries, df, 1, True, strategy).select("query_id", "vec_id")) == [(1, 3), (3, 1)]
    found = knn(queries, df, 1, False, strategy).select("query_id", "vec_id")
    assert {tuple(r) for r in found.collect()} == {(1, None), (None, None), (3, None)}


def test_buckets_travel_packed(spark):
    from millrace.operators.retrieve import Buckets, _tiles

    x, df = vectors(spark, 300)
    buckets = Buckets(np.random.default_rng(1).standard_normal((8, 6)), 3, 2)
    tiles = _tiles(df, "vec_id", 20, buckets).collect()
    sigs = buckets.signatures(x)
    got = [(r["band"], r["sig"], i) for r in tiles for i in np.frombuffer(r["ids"], np.int64).tolist()]
    assert sorted(got) == sorted((b, sigs[i, b], i) for i in range(300) for b in range(3))
    assert all(len(r["ids"]) <= 160 and (np.frombuffer(r["body"]).reshape(-1, 8) == x[np.frombuffer(r["ids"], np.int64)]).all() for r in tiles)


def test_long_texts_reach_python_in_small_batches(spark):
    import pandas as pd

    from conftest import SF
    from millrace.plans import QUERIES

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    QUERIES["model_hooks"](spark, SF)

    @F.pandas_udf("long")
    def together(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    texts = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"), "id")
    assert texts.select(together("text").alias("n")).agg(F.max("n")).first()[0] <= 10_000_000
