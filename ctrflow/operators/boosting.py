"""Gradient-boosted trees fitted in blocks of rounds, each going on from the saved model of the blocks before it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ctrflow.schema import TARGET
from ctrflow.session import scratch_path
from ctrflow.sources.commits import Commits

#: Rounds of a block. A row passes the trees of its own block once per round, and all earlier trees once per block.
BLOCK = 25
_SHARES = 1 << 30
#: Columns of the stored rows; the features are in one vector, so no column of the caller can clash.
_ROW, _SIGN, _FEATURES, _MARGIN, _PULL = "row", "sign", "features", "margin", "pull"


def _pull(sign: Column, margin: Column) -> Column:
    """Negative gradient of the logistic loss 2 log(1 + exp(-2 sign margin)) at the margin."""
    return 4 * sign / (1 + F.exp(2 * sign * margin))


def _drawn(share: float, round_: int, seed: int) -> Column:
    """Whether a row takes part in a round; every try of the round draws the same rows."""
    digits = F.pmod(F.xxhash64(F.col(_ROW), F.lit(round_), F.lit(seed)), F.lit(_SHARES))
    return digits < int(share * _SHARES)


def _assembled(trees: list[DecisionTreeRegressionModel], weights: list[float]) -> GBTClassificationModel:
    """The trees as one model of Spark ML, which saves, loads and scores like any other."""
    context = SparkSession.active().sparkContext
    gateway, jvm = context._gateway, context._jvm
    java_trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    java_weights = gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        java_trees[i], java_weights[i] = tree._java_obj, float(weight)
    classes = jvm.org.apache.spark.ml.classification.GBTClassificationModel
    made = GBTClassificationModel(classes("gbtc", java_trees, java_weights))
    made._resetUid("gbtc")
    return made.setFeaturesCol("_features").setPredictionCol("_predicted")


def _block(
    rows: DataFrame, before: GBTClassificationModel | None, first: int, rounds: int,
    max_depth: int, step: float, subsample: float, min_rows: int, min_gain: float, seed: int,
) -> GBTClassificationModel:
    """The model after ``rounds`` more rounds, of which the first has the number ``first``."""
    trees, weights = (list(before.trees), list(before.treeWeights)) if before else ([], [])
    margin = F.lit(0.0)
    if before:
        model = before.copy().setFeaturesCol(_FEATURES)
        rows = model.transform(rows)
        margin = vector_to_array("rawPrediction")[1]
    path = scratch_path(rows.sparkSession, "margins")
    rows.select(_ROW, _SIGN, _FEATURES, margin.alias(_MARGIN)).write.parquet(path)
    rows = rows.sparkSession.read.parquet(path)
    for round_ in range(first, first + rounds):
        given = rows.where(_drawn(subsample, round_, seed)) if subsample < 1 else rows
        # The first tree is fitted on the signs themselves, and counts fully.
        pull = _pull(F.col(_SIGN), F.col(_MARGIN)) if round_ else F.col(_SIGN)
        learner = DecisionTreeRegressor(
            featuresCol=_FEATURES, labelCol=_PULL, predictionCol="step", maxDepth=max_depth,
            minInstancesPerNode=min_rows, minInfoGain=min_gain, seed=seed + round_,
        )
        tree, weight = learner.fit(given.withColumn(_PULL, pull)), step if round_ else 1.0
        trees.append(tree)
        weights.append(weight)
        moved = F.col(_MARGIN) + weight * F.col("step")
        rows = tree.transform(rows).select(_ROW, _SIGN, _FEATURES, moved.alias(_MARGIN))
    return _assembled(trees, weights)


def fit_boosted_blocks(
    df: DataFrame,
    path: str,
    target: str = TARGET,
    rounds: int = 1000,
    max_depth: int = 10,
    step: float = 0.01,
    subsample: float = 0.7,
    min_rows: int = 6,
    min_gain: float = 0.0,
    seed: int = 42,
    block: int = BLOCK,
) -> PipelineModel:
    """Boosted trees with logistic loss, like ``fit_boosted``, but what is done survives the job.

    The training rows are stored once below ``path``, numbered. Each block of rounds reads them with the margins of the
    model so far, stores these, and saves its model; a state file names it. A job that starts again with the same path
    goes on after the last block, and one that asks for more rounds continues the model. Neither a plan nor a lineage
    is longer than a block.

    Without subsampling the model is that of Spark's own boosting. ``subsample`` draws rows by a hash of row, round and
    seed, so that a round that is repeated draws the same rows. Asking a path for other parameters than it was
    begun with raises, as does asking for fewer rounds than it has. The rows of the first call are the ones that count.
    """
    if rounds < 1 or block < 1:
        raise ValueError("rounds and block must be at least 1")
    spark = df.sparkSession
    inputs = [c for c in df.columns if c != target]
    given = dict(max_depth=max_depth, step=step, subsample=subsample, min_rows=min_rows, min_gain=min_gain, seed=seed)
    asked = {**given, "target": target, "inputs": inputs}
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
    states = Commits(spark, f"{path}/states")
    number, state = states.last()
    if state is None:
        stored = f"{path}/rows-{number + 1}"
        sign = F.when(F.col(target) == 1, 1.0).otherwise(-1.0)
        numbered = assembler.transform(df).select(F.monotonically_increasing_id().alias(_ROW), sign.alias(_SIGN), F.col("_features").alias(_FEATURES))
        numbered.write.mode("overwrite").parquet(stored)
        state = {"asked": asked, "rows": stored, "rounds": 0, "model": None}
        number = _next(states, number, state)
    if state["asked"] != asked:
        raise ValueError(f"{path} was begun with {state['asked']}, not {asked}")
    if state["rounds"] > rounds:
        raise ValueError(f"{path} has {state['rounds']} rounds, more than {rounds}")
    rows = spark.read.parquet(state["rows"])
    model = GBTClassificationModel.load(state["model"]) if state["model"] else None
    while state["rounds"] < rounds:
        done = min(rounds, state["rounds"] + block)
        model = _block(rows, model, state["rounds"], done - state["rounds"], **given)
        saved = f"{path}/model-{done}-{number + 1}"
        model.write().overwrite().save(saved)
        # The trees of the next block start from what is on disk, not from what this process holds.
        model = GBTClassificationModel.load(saved)
        state = {**state, "rounds": done, "model": saved}
        number = _next(states, number, state)
    return PipelineModel(stages=[assembler, model])


def _next(states: Commits, number: int, state: dict) -> int:
    if not states.claim(number + 1, state):
        raise RuntimeError("another job goes on with this model")
    return number + 1


def boosting_at(path: str, **options) -> Callable[[DataFrame], PipelineModel]:
    """``fit_boosted_blocks`` below ``path``, as the ``fit`` of a training job."""
    return partial(fit_boosted_blocks, path=path, **options)
