"""Classifiers and scoring with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ctrflow.functions.codes import threshold_label
from ctrflow.schema import TARGET, spare_names


def _fit(df: DataFrame, classifier, target: str, weight: str | None = None) -> PipelineModel:
    inputs = [c for c in df.columns if c not in (target, weight)]
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
    return Pipeline(stages=[assembler, classifier]).fit(df)


def _roles(target: str) -> dict[str, str]:
    return {"featuresCol": "_features", "labelCol": target, "predictionCol": "_predicted"}


def fit_logistic(
    df: DataFrame, target: str = TARGET, inverse_penalty: float = 1.0, max_iter: int = 100, tol: float = 1e-4
) -> PipelineModel:
    """L2-penalised logistic regression on the unscaled features.

    Spark weighs the penalty against the mean loss, hence the division by the number of rows.
    """
    penalty = 1.0 / (inverse_penalty * max(df.count(), 1))
    classifier = LogisticRegression(
        **_roles(target), regParam=penalty, elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tol,
    )
    return _fit(df, classifier, target)


def fit_forest(
    df: DataFrame, target: str = TARGET, trees: int = 500, max_depth: int = 10, seed: int = 42, bootstrap: bool = True
) -> PipelineModel:
    """A random forest; without ``bootstrap`` every tree sees all rows.

    Trees that see all rows only need to know how often each row occurs: equal rows go in once, weighed by their number. The
    counts of a split, and so the trees, are those of the single rows. A bootstrap draws every row for itself, so there
    they stay apart. Values beyond the 32 bins of a column are binned by a sample of the rows that go in.
    """
    classifier = RandomForestClassifier(
        **_roles(target), numTrees=trees, maxDepth=max_depth, seed=seed, bootstrap=bootstrap
    )
    if bootstrap:
        return _fit(df, classifier, target)
    (weight,) = spare_names(df, "_weight")
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("double").alias(weight))
    return _fit(rows, classifier.setWeightCol(weight), target, weight)


def fit_boosted(
    df: DataFrame,
    target: str = TARGET,
    rounds: int = 1000,
    max_depth: int = 10,
    step: float = 0.01,
    subsample: float = 0.7,
    min_rows: int = 6,
    min_gain: float = 0.0,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees with logistic loss.

    ``min_rows`` and ``min_gain`` bound a leaf by rows and a split by impurity gain; they play the
    part of a minimum child weight and a minimum loss reduction without having their units.
    """
    classifier = GBTClassifier(
        **_roles(target), lossType="logistic", maxIter=rounds, maxDepth=max_depth, stepSize=step,
        subsamplingRate=subsample, minInstancesPerNode=min_rows, minInfoGain=min_gain, seed=seed,
    )
    return _fit(df, classifier, target)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``probability``, the probability of class 1."""
    scored = model.transform(df).withColumn(
        "probability", vector_to_array(F.col("probability"))[1]
    )
    return scored.drop("_features", "rawPrediction", "_predicted")


def predict(
    model: PipelineModel, df: DataFrame, threshold: float = 0.5, inclusive: bool = False
) -> DataFrame:
    """Adds ``probability`` and the 0/1 ``prediction``."""
    label = threshold_label(F.col("probability"), threshold, inclusive)
    return score(model, df).withColumn("prediction", label)
