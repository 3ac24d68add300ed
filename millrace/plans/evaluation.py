"""Queries on evaluation, gates, training and anomaly scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.operators.anomaly import diagonal_distance, fit_diagonal, fit_gaussian, mahalanobis
from millrace.operators.model import train
from millrace.operators.split import hash_split
from millrace.plans.bindings import SCORED, load, rounded, scored
from millrace.plans.registry import query


@query(
    "segment_accuracy",
    f"""WITH {SCORED} SELECT lang, source, CAST(sum(CAST(quality = predicted AS INTEGER)) AS BIGINT) AS acc, count(*) AS obs,
        round(avg(CAST(quality = predicted AS INTEGER)), 6) AS pct_acc FROM scored GROUP BY lang, source""",
)
def segment_accuracy(spark, sf):
    out = evaluate.segment_accuracy(scored(spark, sf), ["lang", "source"], "quality", "predicted")
    return out.withColumn("pct_acc", F.round("pct_acc", 6))


@query(
    "accuracy",
    f"""WITH {SCORED} SELECT count(*) AS rows, round(avg(CAST(quality = predicted AS INTEGER)), 8) AS accuracy
        FROM scored""",
)
def accuracy(spark, sf):
    return evaluate.accuracy(scored(spark, sf), "quality", "predicted").withColumn("accuracy", F.round("accuracy", 8))


COUNTS = """c AS (SELECT count(*) FILTER (quality = 1 AND predicted = 1) AS tp,
  count(*) FILTER (quality = 0 AND predicted = 1) AS fp, count(*) FILTER (quality = 1 AND predicted = 0) AS fn,
  count(*) FILTER (quality = 0 AND predicted = 0) AS tn FROM scored)"""


@query("confusion_matrix", f"WITH {SCORED}, {COUNTS} SELECT tp, fp, fn, tn FROM c")
def confusion_matrix(spark, sf):
    return evaluate.confusion(scored(spark, sf), "quality", "predicted")


@query(
    "classifier_metrics",
    f"""WITH {SCORED}, {COUNTS} SELECT round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy,
        round(tp / (tp + fp), 8) AS precision, round(tp / (tp + fn), 8) AS recall,
        round(2 * tp / (2 * tp + fp + fn), 8) AS f1 FROM c""",
)
def classifier_metrics(spark, sf):
    out = evaluate.classifier_metrics(scored(spark, sf), "quality", "predicted")
    return out.select(*rounded("accuracy", "precision", "recall", "f1", digits=8))


@query(
    "log_loss",
    f"""WITH {SCORED} SELECT round(-avg(CASE WHEN quality = 1 THEN ln(least(greatest(score, 1e-15), 1 - 1e-15))
        ELSE ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END), 7) AS log_loss FROM scored""",
)
def log_loss(spark, sf):
    return evaluate.log_loss(scored(spark, sf), "quality", "score").select(*rounded("log_loss", digits=7))


CUMULATIVE = """
v AS (SELECT score AS threshold, sum(quality)::BIGINT AS pos, sum(1 - quality)::BIGINT AS neg FROM scored GROUP BY score),
cum AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p,
               sum(neg) OVER () AS n FROM v WINDOW w AS (ORDER BY threshold DESC))"""


@query(
    "roc_curve",
    f"WITH {SCORED}, {CUMULATIVE} SELECT threshold, round(fp / n, 8) AS fpr, round(tp / p, 8) AS tpr FROM cum",
)
def roc_curve(spark, sf):
    out = evaluate.roc_curve(scored(spark, sf), "score", "quality")
    return out.select("threshold", *rounded("fpr", "tpr", digits=8))


@query(
    "pr_curve",
    f"""WITH {SCORED}, {CUMULATIVE} SELECT threshold, round(tp / (tp + fp), 8) AS precision,
        round(tp / p, 8) AS recall FROM cum""",
)
def pr_curve(spark, sf):
    out = evaluate.pr_curve(scored(spark, sf), "score", "quality")
    return out.select("threshold", *rounded("precision", "recall", digits=8))


@query(
    "auroc",
    f"""WITH {SCORED}, {CUMULATIVE} SELECT round(sum(pos * (n - fp + neg / 2)) / max(p * n), 8) AS auroc FROM cum""",
)
def auroc(spark, sf):
    return evaluate.auroc(scored(spark, sf), "score", "quality").select(*rounded("auroc", digits=8))


@query(
    "best_f1_threshold",
    f"""WITH {SCORED}, {CUMULATIVE} SELECT threshold, round(2 * tp / (tp + fp + p), 8) AS f1 FROM cum
        ORDER BY 2 * tp / (tp + fp + p) DESC, threshold LIMIT 1""",
)
def best_f1_threshold(spark, sf):
    out = evaluate.best_f1_threshold(scored(spark, sf), "score", "quality")
    return out.select("threshold", *rounded("f1", digits=8))


@query(
    "minmax_scores",
    f"""WITH {SCORED} SELECT doc_id, round((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()), 7)
        AS normalised FROM scored""",
)
def minmax_scores(spark, sf):
    out = evaluate.minmax(scored(spark, sf), "score")
    return out.select("doc_id", *rounded("normalised", digits=7))


@query(
    "validation_gates",
    f"""WITH {SCORED}, s AS (SELECT avg(CAST(quality = predicted AS INTEGER)) AS pct FROM scored GROUP BY lang),
    w AS (SELECT min(pct) AS worst FROM s), n AS (SELECT count(*) AS n FROM scored)
    SELECT 'predicts' AS gate, true AS passed, n::DOUBLE AS value FROM n
    UNION ALL SELECT 'has_signature', true, 2.0 UNION ALL SELECT 'demo_test', worst >= 0.55, round(worst, 8) FROM w
    UNION ALL SELECT 'has_description', true, 43.0 UNION ALL SELECT 'has_artifacts', true, 3.0
    UNION ALL SELECT 'verdict', worst >= 0.55, NULL FROM w""",
)
def validation_gates(spark, sf):
    out = evaluate.run_gates(
        scored(spark, sf),
        "quality",
        "predicted",
        ["lang"],
        "Quality by length, with a saturating curve.",
        3,
        ["n_chars", "lang"],
    )
    return out.withColumn("value", F.round("value", 8))


@query(
    "permutation_importance",
    f"""WITH {SCORED}, r AS (
      SELECT quality, score, CASE lang WHEN 'en' THEN 1 ELSE 0 END AS is_en, count(*) OVER () AS n,
             row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT, doc_id) AS at FROM scored),
    m AS (
      SELECT r.quality, r.score, r.is_en, a.score AS new_score, b.is_en AS new_is_en
      FROM r JOIN r a ON a.at = (r.at - 1 + ceil(r.n * 1 / 3.0::DOUBLE)::BIGINT) % r.n + 1
             JOIN r b ON b.at = (r.at - 1 + ceil(r.n * 2 / 3.0::DOUBLE)::BIGINT) % r.n + 1),
    s AS (
      SELECT avg(CASE WHEN (score + is_en * 0.05::DOUBLE >= 0.4::DOUBLE)::INT = quality THEN 1 ELSE 0 END) AS base,
             avg(CASE WHEN (new_score + is_en * 0.05::DOUBLE >= 0.4::DOUBLE)::INT = quality THEN 1 ELSE 0 END) AS one,
             avg(CASE WHEN (score + new_is_en * 0.05::DOUBLE >= 0.4::DOUBLE)::INT = quality THEN 1 ELSE 0 END) AS two FROM m)
    SELECT 'score' AS feature, round(base, 9) AS accuracy, round(one, 9) AS shuffled_accuracy, round(base - one, 9) AS importance FROM s
    UNION ALL SELECT 'is_en', round(base, 9), round(two, 9), round(base - two, 9) FROM s""",
)
def permutation_importance(spark, sf):
    rows = scored(spark, sf).withColumn("is_en", (F.col("lang") == "en").cast("int"))

    def predict(x):
        return ((x["score"] + x["is_en"] * 0.05) >= 0.4).cast("int")

    out = evaluate.permutation_importance(rows, "doc_id", ["score", "is_en"], "quality", predict)
    return out.select("feature", *rounded("accuracy", "shuffled_accuracy", "importance", digits=9))


@query(
    "train_score_split",
    f"""WITH {SCORED} SELECT doc_id, quality, true AS sound FROM scored
        WHERE ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT >= 0.8::DOUBLE * pow(2, 60)""",
)
def train_score_split(spark, sf):
    """Fit on 60 %, choose the setting on 20 %, score the last 20 %."""
    rows = scored(spark, sf).select("doc_id", "score", (F.col("lang") == "en").cast("double").alias("is_en"), "quality")
    rows = hash_split(rows, ["doc_id"], {"train": 0.6, "val": 0.2, "test": 0.2}, 42)
    grid = [{"regParam": r, "maxIter": 20} for r in (0.0, 0.1)]
    best = train(rows, ["score", "is_en"], "quality", "split", grid)
    out = best.transform(rows.filter("split = 'test'"))
    sound = F.col("probability").between(0, 1) & (F.col("prediction") == (F.col("probability") > 0.5).cast("double"))
    return out.select("doc_id", "quality", sound.alias("sound"))


NORMAL = "SELECT i, avg(x) AS m, var_pop(x) AS v FROM cells WHERE label = 0 GROUP BY i"
CELLS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
           FROM embeddings)"""


@query(
    "anomaly_diag",
    f"""WITH {CELLS}, g AS ({NORMAL})
    SELECT vec_id, label, round(sqrt(sum((x - m) * (x - m) / (v + 0.01))), 5) AS distance
    FROM cells JOIN g USING (i) GROUP BY vec_id, label""",
)
def anomaly_diag(spark, sf):
    """Distance of every vector from the vectors of label 0, dimensions taken as independent."""
    rows = load(spark, sf, "embeddings")
    mean, variance = fit_diagonal(rows.filter("label = 0"), "embedding")
    distance = diagonal_distance(F.col("embedding"), mean, variance)
    return rows.select("vec_id", "label", F.round(distance, 5).alias("distance"))


@query("anomaly_mahalanobis")
def anomaly_mahalanobis(spark, sf):
    rows = load(spark, sf, "embeddings")
    model = fit_gaussian(rows.filter("label = 0"), "embedding")
    return rows.select("vec_id", "label", mahalanobis(model, F.col("embedding")).alias("distance"))


@query(
    "anomaly_threshold",
    f"""WITH {CELLS}, g AS ({NORMAL}),
    scored AS (SELECT round(sqrt(sum((x - m) * (x - m) / (v + 0.01))), 4) AS score, CAST(label <> 0 AS INTEGER) AS quality
               FROM cells JOIN g USING (i) GROUP BY vec_id, label), {CUMULATIVE},
    best AS (SELECT threshold, 2 * tp / (tp + fp + p) AS f1 FROM cum ORDER BY 2 DESC, 1 LIMIT 1)
    SELECT threshold, round(f1, 8) AS f1 FROM best""",
)
def anomaly_threshold(spark, sf):
    """From vectors to scores to the threshold that tells label 0 from the others best."""
    rows = load(spark, sf, "embeddings")
    mean, variance = fit_diagonal(rows.filter("label = 0"), "embedding")
    distance = F.round(diagonal_distance(F.col("embedding"), mean, variance), 4)
    out = rows.select(distance.alias("score"), (F.col("label") != 0).cast("int").alias("anomalous"))
    return evaluate.best_f1_threshold(out, "score", "anomalous").select("threshold", *rounded("f1", digits=8))
