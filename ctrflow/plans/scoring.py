"""Request scoring: from JSON batches to the feature matrix, probabilities and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ctrflow.functions.codes import click_text, gender_code
from ctrflow.functions.time import time_of_day
from ctrflow.operators.encode import Encoder
from ctrflow.operators.model import predict
from ctrflow.schema import ENCODED, FEATURES_ENGINEERED, TARGET, USER
from ctrflow.sources.feature_table import lookup_default
from ctrflow.sources.requests import parse_requests

RECENT = "most_recent_clicked_product_encoding"
MATRIX = [c for c in FEATURES_ENGINEERED if c != TARGET]


def request_features(
    requests: DataFrame, encoder: Encoder, customers: DataFrame, body: str = "body"
) -> DataFrame:
    """One row per request row: its user and the model features.

    Every row is looked up by its own user; users without a record get -1. Unknown labels get a
    null code. ``requests`` may be a stream; ``customers`` holds the latest record per user.
    """
    rows = parse_requests(requests, body)
    keep = [c for c in rows.columns if c not in (*ENCODED, "gender", "hour")]
    coded = rows.withColumns({
        "gender_encoding": gender_code(F.col("gender")),
        "time_of_day": time_of_day(F.col("hour")),
    })
    coded = encoder.transform(coded, ENCODED, on_unseen="null")
    return lookup_default(coded, customers, USER, RECENT).select(*keep, *MATRIX)


def score_with(
    model: PipelineModel, requests: DataFrame, customers: DataFrame, threshold: float = 0.5, body: str = "body"
) -> DataFrame:
    """Request rows scored by a model that has its encoder as first stage; nothing but the model and the customers is needed."""
    codes, *rest = model.stages
    features = request_features(requests, codes.encoder, customers, body)
    return score_requests(features, PipelineModel(stages=rest), threshold)


def score_requests(features: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Adds probability, the 0/1 prediction and its text; all null where a code is unknown."""
    given = features.withColumn("_given", F.struct(*MATRIX))
    scored = predict(
        model, given.withColumns({c: F.coalesce(c, F.lit(-1)) for c in MATRIX}), threshold
    )
    known = reduce(Column.__and__, [F.col(f"_given.{c}").isNotNull() for c in MATRIX])
    answers = {
        "probability": F.col("probability"),
        "prediction": F.col("prediction"),
        "label": click_text(F.col("prediction")),
    }
    return scored.select(
        *[c for c in features.columns if c not in MATRIX],
        *[F.col(f"_given.{c}").alias(c) for c in MATRIX],
        *[F.when(known, value).alias(name) for name, value in answers.items()],
    )
