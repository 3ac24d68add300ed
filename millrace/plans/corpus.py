"""Queries on text, question-answer documents, dialogue and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import html_to_text
from millrace.operators import corpus
from millrace.operators.retrieve import answer_batch, centroids, embed_text, knn, knn_lsh
from millrace.operators.vector_index import cell_hits, file_vectors, fit_cells, knn_cells
from millrace.plans.bindings import load
from millrace.plans.registry import query
from millrace.session import scratch_path


def html_sql(col: str) -> str:
    """Tags out by a pattern of quoted and other parts, references by code point."""
    for pattern in (r"(?is)<!--.*?-->", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"""(?s)<[A-Za-z/!?]("[^"]*"|''[^'']*''|[^>"''])*>"""):
        col = f"regexp_replace({col}, '{pattern}', ' ', 'g')"
    # &amp; last, so that what it yields is not read again
    for name, point in (("copy", 169), ("middot", 183), ("nbsp", 160), ("lt", 60), ("gt", 62), ("quot", 34), ("#39", 39), ("apos", 39), ("amp", 38)):
        col = f"replace({col}, '&{name};', chr({point}))"
    return f"trim(regexp_replace({col}, '[ \\t\\r\\n\\x{{00A0}}]+', ' ', 'g'), ' ')"


@query("html_to_text", f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def html_to_text_query(spark, sf):
    return load(spark, sf, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


@query(
    "qa_quality_filter",
    """SELECT doc_id, quality, n_chars FROM documents JOIN labels USING (doc_id)
       WHERE quality >= 1 AND length(text) <= 1000""",
)
def qa_quality_filter(spark, sf):
    rows = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    return corpus.quality_filter(rows, "quality", "text", 1, 1000).select("doc_id", "quality", "n_chars")


def _posts(spark, sf):
    """Conversation turns as posts: a user turn asks, the assistant turn after it answers."""
    c = load(spark, sf, "conversations")
    id_ = F.col("conv_id") * 1_000_000 + F.col("turn")
    parent = F.when(F.col("role") == "assistant", id_ - 1)
    rows = c.filter(F.col("role").isin("user", "assistant"))
    return rows.select(id_.alias("id"), F.col("text").alias("body"), parent.alias("parent_id"))


PAIRS = """
pairs AS (SELECT b.conv_id * 1000000 + b.turn AS answer_id, a.text AS question, b.text AS answer
          FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1
          WHERE a.role = 'user' AND b.role = 'assistant')"""


@query("qa_pairs", f"WITH {PAIRS} SELECT * FROM pairs")
def qa_pairs(spark, sf):
    return corpus.qa_pairs(_posts(spark, sf))


@query("qa_documents", f"WITH {PAIRS} SELECT answer_id AS source, question || chr(10) || chr(10) || answer AS text FROM pairs")
def qa_documents(spark, sf):
    return corpus.qa_documents(corpus.qa_pairs(_posts(spark, sf)))


@query(
    "chunk_text",
    """SELECT doc_id, CAST(i AS INTEGER) AS chunk, substr(text, i * 900 + 1, 1000) AS chunk_text
       FROM (SELECT doc_id, text, unnest(generate_series(0, CAST(greatest(0, ceil((length(text) - 1000) / 900.0)) AS BIGINT))) AS i
             FROM documents)""",
)
def chunk_text(spark, sf):
    return corpus.chunk_text(load(spark, sf, "documents"), "doc_id", "text")


@query(
    "shorten_long_text",
    r"""WITH s AS (SELECT doc_id, text, greatest(1, ceil(length(text) / 1000.0::DOUBLE)::INT) AS m,
                 string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents)
        SELECT doc_id, CASE WHEN length(text) <= 5000 THEN text
          ELSE array_to_string(list_filter(parts, lambda x, i: (i - 1) % m = 0), ' ') END AS text_short FROM s""",
)
def shorten_long_text(spark, sf):
    return corpus.shorten(load(spark, sf, "documents"), "text").select("doc_id", "text_short")


TEMPLATE = "Answer from the paragraphs below.\n{context}\n\nBefore: {history}\nQuestion: {question}\nAnswer:"


@query(
    "build_prompts",
    f"""WITH {PAIRS} SELECT answer_id,
        'Answer from the paragraphs below.' || chr(10) || answer || chr(10) || chr(10) || 'Before: ' || answer_id
          || chr(10) || 'Question: ' || question || chr(10) || 'Answer:' AS prompt FROM pairs""",
)
def build_prompts(spark, sf):
    rows = corpus.qa_pairs(_posts(spark, sf)).withColumns(
        {"context": F.array("answer"), "history": F.col("answer_id").cast("string")}
    )
    return corpus.build_prompts(rows, TEMPLATE, "context", "question", "history").select("answer_id", "prompt")


@query(
    "trim_history",
    r"""WITH t AS (SELECT conv_id, turn, CASE WHEN trim(text, ' ') = '' THEN 0
          ELSE len(string_split_regex(trim(text, ' '), '[ \t\n\x0B\f\r]+')) END AS tokens FROM conversations),
    s AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS tokens_from_end FROM t)
    SELECT conv_id, turn, tokens, CAST(tokens_from_end AS BIGINT) AS tokens_from_end FROM s WHERE tokens_from_end <= 100""",
)
def trim_history(spark, sf):
    out = corpus.trim_history(load(spark, sf, "conversations"), "conv_id", "turn", "text", 100)
    return out.select("conv_id", "turn", "tokens", "tokens_from_end")


@query(
    "dialogue_context",
    """SELECT conv_id, turn, array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), ' ' || chr(10)) AS context
       FROM conversations WHERE role = 'user'""",
)
def dialogue_context(spark, sf):
    rows = load(spark, sf, "conversations").filter("role = 'user'")
    return corpus.dialogue_context(rows, "conv_id", "turn", "text")


@query(
    "dedupe_recent_sources",
    """WITH RECURSIVE r AS (
      SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n,
             ['s' || (length(text) % 4), 't' || (turn % 3)] AS retrieved FROM conversations),
    walk AS (
      SELECT conv_id, turn, n, retrieved AS kept, retrieved AS used FROM r WHERE n = 1
      UNION ALL
      SELECT r.conv_id, r.turn, r.n, list_filter(r.retrieved, lambda s: NOT list_contains(w.used[-3:], s)),
             w.used[-3:] || list_filter(r.retrieved, lambda s: NOT list_contains(w.used[-3:], s))
      FROM walk w JOIN r ON r.conv_id = w.conv_id AND r.n = w.n + 1)
    SELECT conv_id, turn, array_to_string(kept, ',') AS kept FROM walk""",
)
def dedupe_recent_sources(spark, sf):
    """Sources a chat turn retrieves, less those among the last three used in the conversation."""
    c = load(spark, sf, "conversations")
    found = F.array(
        F.concat(F.lit("s"), F.pmod(F.length("text"), F.lit(4)).cast("string")),
        F.concat(F.lit("t"), F.pmod("turn", F.lit(3)).cast("string")),
    )
    out = corpus.dedupe_recent_sources(c.withColumn("found", found), "conv_id", "turn", "found")
    return out.select("conv_id", "turn", F.array_join("kept", ",").alias("kept"))


CENTROIDS = """
cells AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY ALL),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS qv FROM means GROUP BY label),
pairs AS (SELECT query_id, vec_id, round(list_dot_product(qv, embedding::DOUBLE[]), 9) AS score FROM q, embeddings),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)"""


def _vectors(spark, sf):
    rows = load(spark, sf, "embeddings")
    return centroids(rows, "label", "embedding"), rows.select("vec_id", F.col("embedding").alias("vector"))


@query(
    "knn_topk",
    f"""WITH {CENTROIDS} SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score
        FROM top WHERE rank <= 5""",
)
def knn_topk(spark, sf):
    """The five vectors nearest to the mean vector of every label, among all vectors."""
    queries, vectors = _vectors(spark, sf)
    return knn(queries, vectors, 5).withColumn("score", F.round("score", 6))


@query(
    "knn_self",
    """WITH pairs AS (SELECT a.vec_id AS query_id, b.vec_id,
         round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
       FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
    SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM top WHERE rank <= 3""",
)
def knn_self(spark, sf):
    """The three nearest other vectors of every vector, both sides cut into blocks."""
    rows = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    out = knn(rows.withColumnRenamed("vec_id", "query_id"), rows, 3, exclude_self=True, strategy="blocks")
    return out.withColumn("score", F.round("score", 6))


@query("knn_lsh")
def knn_lsh_query(spark, sf):
    queries, vectors = _vectors(spark, sf)
    return knn_lsh(queries, vectors, 5, 64)


@query(
    "knn_lsh_recall",
    "SELECT count(*) AS queries, true AS found_most, true AS all_true_scores FROM embeddings WHERE vec_id % 50 = 0",
)
def knn_lsh_recall(spark, sf):
    """Every 50th vector against all: do buckets find nine in ten of the true nearest five, and never a wrong score?"""
    vectors = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    queries = vectors.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    exact = knn(queries, vectors, 5, exclude_self=True)
    near = knn_lsh(queries, vectors, 5, 64, bands=32, bits=4, exclude_self=True)
    both = exact.join(near.select("query_id", "vec_id", F.col("score").alias("s")), ["query_id", "vec_id"], "left")
    return both.agg(
        F.countDistinct("query_id").alias("queries"),
        (F.count("s") >= 0.9 * F.count("*")).alias("found_most"),
        (F.count(F.when(F.abs(F.col("s") - F.col("score")) > 1e-6, 1)) == 0).alias("all_true_scores"),
    )


def _cells(spark, sf, target=0.93):
    """Every 50th vector as a query, all vectors, the fitted index and the vectors filed under it."""
    vectors = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    index = fit_cells(vectors, 5, target=target)
    path = scratch_path(spark, "cells")
    file_vectors(vectors, index).write.parquet(path)
    return vectors.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), vectors, index, spark.read.parquet(path)


@query(
    "knn_cells",
    """WITH pairs AS (SELECT a.vec_id AS query_id, b.vec_id,
         round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
       FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
    SELECT query_id, vec_id, round(score, 6) AS score FROM top WHERE rank = 1""",
)
def knn_cells_query(spark, sf):
    """The nearest other vector of every 50th one, through the cell index."""
    queries, _, index, filed = _cells(spark, sf, target=0.999)
    near = knn_cells(queries, filed, index, 5, exclude_self=True).filter("rank = 1")
    return near.select("query_id", "vec_id", F.round("score", 6).alias("score"))


@query(
    "knn_cells_recall",
    """SELECT count(*) FILTER (vec_id % 50 = 0) AS queries, count(*) FILTER (vec_id % 50 = 0) * count(*) AS pairs,
              true AS found_nine_in_ten, true AS scored_under_a_tenth FROM embeddings""",
)
def knn_cells_recall(spark, sf):
    """Every 50th vector against all: the share of the nearest five that the index finds, and of pairs scored exactly."""
    queries, vectors, index, filed = _cells(spark, sf)
    exact = knn(queries, vectors, 5, exclude_self=True)
    near = knn_cells(queries, filed, index, 5, exclude_self=True).select("query_id", "vec_id", F.lit(1).alias("hit"))
    found = exact.join(near, ["query_id", "vec_id"], "left").agg(F.countDistinct("query_id").alias("queries"), (F.count("hit") / F.count("*")).alias("recall"))
    scored = cell_hits(queries, filed, index, 5, True).agg(F.sum("compared").alias("scored"))
    every = found.unionByName(scored, allowMissingColumns=True).unionByName(vectors.agg(F.count("*").alias("n")), allowMissingColumns=True)
    row = every.agg(*[F.max(c).alias(c) for c in ("queries", "recall", "scored", "n")])
    return row.select(
        "queries", (F.col("queries") * F.col("n")).alias("pairs"), (F.col("recall") >= 0.9).alias("found_nine_in_ten"),
        (F.col("scored") < 0.1 * F.col("queries") * F.col("n")).alias("scored_under_a_tenth"),
    )


@query(
    "tfidf_vectors",
    """SELECT doc_id, 256 AS dim, CASE WHEN regexp_matches(text, '\\S') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents""",
)
def tfidf_vectors(spark, sf):
    """Length and norm of each text's vector."""
    rows = embed_text(load(spark, sf, "documents"), "doc_id", "text")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select("doc_id", F.size("vector").alias("dim"), F.round(F.sqrt(square), 6).alias("norm"))


QA_TEMPLATE = "Use these paragraphs.\n{context}\nQuestion: {question}\nResponse:"
ANSWERS = f"""
WITH {CENTROIDS},
hits AS (SELECT t.query_id, t.rank, t.vec_id, d.text FROM top t LEFT JOIN documents d ON d.doc_id = t.vec_id
         WHERE t.rank <= 2)
SELECT q.query_id, 'What is typical of label ' || q.query_id || '?' AS question,
       'Use these paragraphs.' || chr(10) || coalesce(string_agg(h.text, chr(10) || chr(10) ORDER BY h.rank), '') || chr(10)
         || 'Question: What is typical of label ' || q.query_id || '?' || chr(10) || 'Response:' AS prompt,
       arg_min(h.text, h.rank) AS answer, string_agg(CAST(h.vec_id AS VARCHAR), ',' ORDER BY h.rank) AS sources
FROM q LEFT JOIN hits h USING (query_id) GROUP BY q.query_id"""


def _answers(spark, sf):
    queries, vectors = _vectors(spark, sf)
    asked = F.concat(F.lit("What is typical of label "), F.col("query_id").cast("string"), F.lit("?"))
    texts = load(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return answer_batch(queries.withColumn("question", asked), vectors, texts, QA_TEMPLATE, 2)


@query("answer_batch", ANSWERS)
def answer_batch_query(spark, sf):
    """One question per label, answered from the documents nearest to the label's mean vector."""
    out = corpus.flatten(_answers(spark, sf), "response", ["query_id", "question", "prompt"])
    return out.withColumn("sources", F.array_join("sources", ","))


@query("struct_flatten", f"SELECT query_id, answer, sources FROM ({ANSWERS})")
def struct_flatten(spark, sf):
    out = corpus.flatten(_answers(spark, sf), "response", ["query_id"])
    return out.withColumn("sources", F.array_join("sources", ","))
