"""Evaluation of scored rows: segments, confusion, curves, thresholds, gates, importance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import DRAW_BITS, drawn
from millrace.operators.running import hash_rank, running_totals, split_points, with_tile


def _hit(truth: str, predicted: str) -> Column:
    return F.coalesce((F.col(truth) == F.col(predicted)).cast("int"), F.lit(0))


def segment_accuracy(df: DataFrame, segments: Sequence[str], truth: str, predicted: str) -> DataFrame:
    """Correct rows, rows and share of correct rows for every combination of segment values."""
    hit = _hit(truth, predicted)
    return df.groupBy(*segments).agg(
        F.sum(hit).alias("acc"), F.count("*").alias("obs"), F.avg(hit).alias("pct_acc")
    )


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.avg(_hit(truth, predicted)).alias("accuracy"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    return df.agg(
        F.count(F.when(t & p, 1)).alias("tp"),
        F.count(F.when(~t & p, 1)).alias("fp"),
        F.count(F.when(t & ~p, 1)).alias("fn"),
        F.count(F.when(~t & ~p, 1)).alias("tn"),
    )


def classifier_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1; null where a ratio has no rows under it."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, truth, predicted).select(
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def log_loss(df: DataFrame, truth: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """Mean of -log of the probability given to the truth; rows with an unknown truth or probability are left out."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    known = df.filter(F.col(truth).isNotNull() & F.col(probability).isNotNull())
    return known.agg((-F.avg(F.when(F.col(truth) == 1, F.log(p)).otherwise(F.log(1 - p)))).alias("log_loss"))


def score_counts(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Positives and negatives per distinct score: all that curves and ranks need."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(truth).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.sum(F.col(truth).cast("long")).alias("pos"), F.sum(1 - F.col(truth).cast("long")).alias("neg"))
    )


def cumulative_counts(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Per distinct score, positives (tp) and negatives (fp) scored at least as high."""
    cuts = split_points(df, [score])[score]
    counts = with_tile(score_counts(df, score, truth), "threshold", cuts)
    return running_totals(counts, [], [F.desc("threshold")], {"tp": "pos", "fp": "neg"}, tile_descending=True)


def roc_curve(df: DataFrame, score: str, truth: str) -> DataFrame:
    return cumulative_counts(df, score, truth).select(
        "threshold",
        F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide("tp", "tp_total").alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str, truth: str) -> DataFrame:
    return cumulative_counts(df, score, truth).select(
        "threshold",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "tp_total").alias("recall"),
    )


def auroc(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Exact area under the ROC curve: share of positive-negative pairs in order, ties half."""
    cum = cumulative_counts(df, score, truth)
    # Negatives scored lower than this value, and half of those scored the same.
    beaten = (F.col("fp_total") - F.col("fp")).cast("double") + F.col("neg") / 2
    return cum.agg(
        F.try_divide(
            F.sum(F.col("pos") * beaten), F.max("tp_total").cast("double") * F.max("fp_total")
        ).alias("auroc")
    )


def best_f1_threshold(df: DataFrame, score: str, truth: str) -> DataFrame:
    """The score from which calling everything positive gives the best F1; ties go to the lower score."""
    cum = cumulative_counts(df, score, truth)
    f1 = F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("tp_total"))
    best = cum.select("threshold", f1.alias("f1")).agg(
        F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("best")
    )
    return best.select("best.threshold", "best.f1")


def fit_minmax(df: DataFrame, score: str) -> tuple[float, float]:
    row = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    return row["lo"], row["hi"]


def minmax(df: DataFrame, score: str, bounds: tuple[float, float] | None = None, name: str = "normalised") -> DataFrame:
    """Scale scores to [0, 1]; bounds come from the same rows or from a validation set. Others are clipped."""
    lo, hi = bounds or fit_minmax(df, score)
    if lo is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    span = (hi - lo) or 1.0
    scaled = (F.col(score) - F.lit(lo)) / F.lit(span)
    return df.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)))


def run_gates(
    scored: DataFrame,
    truth: str,
    predicted: str,
    segments: Sequence[str],
    description: str | None,
    artifacts: int,
    inputs: Sequence[str] = (),
    min_segment_accuracy: float = 0.55,
    min_description: int = 20,
) -> DataFrame:
    """One row per validation gate and a last one for the verdict: all gates passed."""
    present = set(scored.columns)
    known = [s for s in segments if s in present]
    sound = bool(known) and len(known) == len(segments)
    per_segment = segment_accuracy(scored, known, truth, predicted)
    nulls = scored.agg(F.count("*").alias("n"), F.count(predicted).alias("predicted"))
    worst = per_segment.agg(F.min("pct_acc").alias("worst"))
    gates = [
        ("predicts", F.col("s.predicted") == F.col("s.n"), F.col("s.predicted").cast("double")),
        ("has_signature", F.lit(all(i in present for i in inputs)), F.lit(float(len(inputs)))),
        ("demo_test", F.col("s.worst") >= min_segment_accuracy, F.col("s.worst")),
        ("has_description", F.lit(len(description or "") > min_description), F.lit(float(len(description or "")))),
        ("has_artifacts", F.lit(artifacts > 0), F.lit(float(artifacts))),
    ]
    if not sound:
        gates[2] = ("demo_test", F.lit(False), F.lit(None).cast("double"))
    summary = nulls.select(
        F.struct("n", "predicted", worst.scalar().alias("worst") if sound else F.lit(None).alias("worst")).alias("s")
    )
    passed = [F.coalesce(ok, F.lit(False)) for _, ok, _ in gates]
    rows = [
        F.struct(F.lit(name).alias("gate"), ok.alias("passed"), value.alias("value"))
        for (name, _, value), ok in zip(gates, passed, strict=True)
    ]
    verdict = reduce(lambda a, b: a & b, passed)
    rows.append(F.struct(F.lit("verdict").alias("gate"), verdict.alias("passed"), F.lit(None).cast("double").alias("value")))
    return summary.select(F.inline(F.array(*rows)))


def permutation_importance(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    truth: str,
    predict: Callable[[Mapping[str, Column]], Column],
    seed: int = 42,
) -> DataFrame:
    """Accuracy lost when one feature's values are dealt out anew among the rows.

    Rows are numbered once, in the order of numbers drawn from their key; for each feature a row takes the value of
    the row so many places on, the i-th of k features going i / (k + 1) of the way round.
    """
    rows = df.select(key, truth, *features)
    first = hash_rank(rows, [], drawn(seed, key), F.col(key), "_at", DRAW_BITS)
    hit = lambda values: F.avg((predict(values) == F.col(truth)).cast("int"))
    base = rows.agg(hit({f: F.col(f) for f in features}).alias("b"))
    out = []
    for i, f in enumerate(features):
        on = F.ceil(F.col("_at_total") * F.lit(i + 1) / F.lit(len(features) + 1))
        dealt = first.select((F.pmod(F.col("_at") - 1 - on, F.col("_at_total")) + 1).alias("_at"), F.col(f).alias("_new"))
        mixed = first.join(dealt, "_at")
        values = {g: F.col("_new") if g == f else F.col(g) for g in features}
        out.append(mixed.agg(F.lit(f).alias("feature"), hit(values).alias("shuffled_accuracy")))
    every = reduce(lambda a, b: a.unionByName(b), out)
    return every.select(
        "feature",
        base.scalar().alias("accuracy"),
        "shuffled_accuracy",
        (base.scalar() - F.col("shuffled_accuracy")).alias("importance"),
    )
