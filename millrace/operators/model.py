"""Training with a small search, and scoring as a column function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from millrace.operators.evaluate import classifier_metrics


@dataclass(frozen=True)
class Trained:
    """The best model of a search, its settings and the validation F1 of every run."""

    model: Model
    features: tuple[str, ...]
    params: Mapping[str, object]
    runs: tuple[tuple[Mapping[str, object], float], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction``."""
        assembled = _assemble(df, self.features)
        out = self.model.transform(assembled).withColumn("_p", vector_to_array("probability")[1])
        return out.drop("rawPrediction", "probability", "_features").withColumnRenamed("_p", "probability")


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep").transform(df)


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    split: str,
    grid: Sequence[Mapping[str, object]],
    kind: str = "logistic",
    parallel: int = 4,
) -> Trained:
    """Fit every setting on ``train`` rows and keep the one with the best F1 on ``val`` rows.

    ``gbt`` also stops adding trees once the validation rows get no better.
    """
    rows = _assemble(df.select(*features, label, split), features).withColumn("_y", F.col(label).cast("double"))
    rows = rows.withColumn("_val", F.col(split) == "val").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def fit(params: Mapping[str, object]) -> tuple[Model, float]:
            if kind == "logistic":
                model = LogisticRegression(featuresCol="_features", labelCol="_y", **params).fit(rows.filter(F.col(split) == "train"))
            elif kind == "gbt":
                trees = GBTClassifier(featuresCol="_features", labelCol="_y", validationIndicatorCol="_val", **params)
                model = trees.fit(rows.filter(F.col(split).isin("train", "val")))
            else:
                raise ValueError(f"unknown kind {kind!r}")
            f1 = classifier_metrics(model.transform(rows.filter("_val")), "_y", "prediction").first()["f1"]
            return model, f1 if f1 is not None else 0.0

        # settings are fitted side by side: their Spark jobs share the cluster
        with ThreadPoolExecutor(max_workers=min(parallel, len(grid))) as pool:
            found = list(pool.map(fit, grid))
        fitted, runs = [m for m, _ in found], [(dict(p), f1) for p, (_, f1) in zip(grid, found)]
        best = max(range(len(runs)), key=lambda i: runs[i][1])
        return Trained(fitted[best], tuple(features), runs[best][0], tuple(runs))
    finally:
        rows.unpersist()


def logistic_sql(coefficients: Mapping[str, float], intercept: float) -> str:
    """A fitted logistic model as an SQL expression over its feature columns."""
    terms = [repr(float(intercept)) + "D", *[f"{float(w)!r}D * `{name}`" for name, w in coefficients.items()]]
    return f"1 / (1 + exp(-({' + '.join(terms)})))"


def logistic_column(coefficients: Mapping[str, float], intercept: float) -> Column:
    return F.expr(logistic_sql(coefficients, intercept))


def tree_sql(trained: Trained) -> str:
    """A fitted boosted-tree model as an SQL expression: the weighted trees, each a nest of conditions, then the link."""
    trees = [f"{float(w)!r}D * ({_branch(t._java_obj.rootNode(), trained.features)})" for t, w in zip(trained.model.trees, trained.model.treeWeights)]
    return f"1 / (1 + exp(-2 * ({' + '.join(trees)})))"


def _branch(node, features: Sequence[str]) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{float(node.prediction())!r}D"
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only splits of numbers can be written as SQL")
    test = f"`{features[split.featureIndex()]}` <= {float(split.threshold())!r}D"
    return f"CASE WHEN {test} THEN {_branch(node.leftChild(), features)} ELSE {_branch(node.rightChild(), features)} END"


def as_sql(trained: Trained) -> str:
    """The trained model's probability as SQL over its feature columns, for batch, streams and the feature store."""
    if hasattr(trained.model, "coefficients"):
        return logistic_sql(dict(zip(trained.features, trained.model.coefficients.toArray(), strict=True)), trained.model.intercept)
    return tree_sql(trained)


def as_column(trained: Trained) -> Column:
    """The trained model's probability as a column expression."""
    return F.expr(as_sql(trained))


def register_sql(spark: SparkSession, name: str, trained: Trained) -> None:
    """Make the trained model callable from SQL, features in the order of training: a function that is an expression."""
    body, names = as_sql(trained), [f"x{i}" for i in range(len(trained.features))]
    for feature, argument in zip(trained.features, names):
        body = body.replace(f"`{feature}`", argument)
    arguments = ", ".join(f"{n} DOUBLE" for n in names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS DOUBLE RETURN {body}")


def score_table(df: DataFrame, probability: Column, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("probability", probability).withColumn(
        "prediction", (F.col("probability") > threshold).cast("int")
    )
