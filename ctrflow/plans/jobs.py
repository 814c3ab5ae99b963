"""Preparation, feature ingestion, and training jobs.

Each job stages the cleaned rows once in the shared folder. The passes that follow (fill values,
encoder fits, busy users, class sizes, output) then read single columns of a Parquet table instead
of repeating the scan and the de-duplication.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ctrflow.functions.codes import gender_code
from ctrflow.functions.time import stamp
from ctrflow.operators.clean import clean_rows
from ctrflow.operators.codes_stage import CodeLookup
from ctrflow.operators.conform import EVENT_TIME
from ctrflow.operators.customers import customer_profile
from ctrflow.operators.encode import (
    Encoder, TargetEncoder, fit_label, fit_ordinal_ctr, fit_target,
)
from ctrflow.operators.impute import fit_imputer
from ctrflow.operators.metrics import f1_score
from ctrflow.operators.model import fit_boosted, predict
from ctrflow.operators.rolling import rolling_top
from ctrflow.operators.sample import balance, shuffle_rows
from ctrflow.operators.split import time_split
from ctrflow.plans.scoring import score_with
from ctrflow.schema import (
    ENCODED, ENGINEERED, FEATURES, FEATURES_ENGINEERED, ID, TIME, USER, infer_definitions,
    project, to_string,
)
from ctrflow.session import stage
from ctrflow.sources.feature_table import append_features, ingest
from ctrflow.sources.files import as_report, write_matrix, write_report
from ctrflow.sources.registry import (
    F1_THRESHOLD, PENDING, approved_path, claim_version, quality_gate, read_registry, register_models,
)

# ---- fixed values: default cut points of the time split --------------------------------------
FIRST_CUT, SECOND_CUT = "2017-07-06", "2017-07-07"
# ---- end of fixed values --------------------------------------------------------------------


def staged_clean(impressions: DataFrame) -> DataFrame:
    """Cleaned and de-duplicated rows in the shared folder, for all jobs that start from this log."""
    return stage(clean_rows(impressions), "clean")


def prepare(
    impressions: DataFrame, cuts: tuple[str, str] | None = None, fit_on: str = "all", clean: DataFrame | None = None
) -> DataFrame:
    """Cleaned, de-duplicated and imputed rows with time parts.

    The fill values come from all rows; ``fit_on='train'`` takes them from the rows before the
    first cut point. ``clean`` are the rows of ``staged_clean``, where the caller has them.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be all or train, not {fit_on!r}")
    if fit_on == "train" and not cuts:
        raise ValueError("fit_on='train' needs the cut points of the split")
    rows = staged_clean(impressions) if clean is None else clean
    if fit_on == "train":
        return fit_imputer(time_split(rows, *cuts)[0], applied_to=rows).transform(rows)
    return fit_imputer(rows).transform(rows)


def staged_rolling(
    impressions: DataFrame, cuts: tuple[str, str] | None = None, fit_on: str = "all", clean: DataFrame | None = None
) -> DataFrame:
    """Prepared rows with rolling features in the shared folder, for all jobs that start from this log."""
    return stage(rolling_top(prepare(impressions, cuts, fit_on, clean)), "rolling")


@dataclass
class Prepared:
    """Encoded train, validation and test frames with the encoder that was fitted on train."""

    train: DataFrame
    validation: DataFrame
    test: DataFrame
    encoder: Encoder | TargetEncoder

    def __iter__(self):
        return iter((self.train, self.validation, self.test))


def preprocess(
    impressions: DataFrame,
    cuts: tuple[str, str] = (FIRST_CUT, SECOND_CUT),
    encoding: str = "label",
    engineered: bool = False,
    columns: list[str] = ENCODED,
    fit_on: str = "all",
    on_unseen: str = "error",
    rolling: DataFrame | None = None,
) -> Prepared:
    """Clean, split by time, and encode with codes fitted on the training rows.

    ``encoding`` is label, ordinal (by click rate) or target. Target encoding treats gender like
    the other columns; the other two give it its fixed code. ``rolling`` are the rows of ``staged_rolling``, where the
    caller has them.
    """
    if rolling is not None and not engineered:
        raise ValueError("rows with rolling features need engineered=True")
    if rolling is not None:
        rows = rolling
    elif engineered:
        rows = staged_rolling(impressions, cuts, fit_on)
    else:
        rows = prepare(impressions, cuts, fit_on)
    if encoding == "target":
        train, _, _ = time_split(rows, *cuts)
        encoder = fit_target(train, [*columns, "gender"])
        _, validation, test = time_split(encoder.transform(rows), *cuts)
        return Prepared(encoder.transform_train(train), validation, test, encoder)
    fits: dict[str, Callable[..., Encoder]] = {"label": fit_label, "ordinal": fit_ordinal_ctr}
    if encoding not in fits:
        raise ValueError(f"unknown encoding {encoding!r}")
    rows = rows.withColumn("gender_encoding", gender_code(F.col("gender")))
    encoder = fits[encoding](time_split(rows, *cuts)[0], columns)
    lookups = {c: c for c in columns}
    if engineered:
        lookups |= {name: base for base, name in ENGINEERED.items()}
    encoded = encoder.transform(rows, lookups, on_unseen=on_unseen)
    return Prepared(*time_split(encoded, *cuts), encoder)


def encode_all(
    rows: DataFrame, encoder: Encoder | None = None, columns: list[str] = ENCODED,
    on_unseen: str = "error",
) -> tuple[DataFrame, Encoder]:
    """Single-frame form: gender code, labels and, where present, engineered columns.

    Uses the given encoder, or fits one on these very rows.
    """
    encoder = encoder or fit_label(rows, columns)
    lookups = {c: c for c in columns}
    lookups |= {name: base for base, name in ENGINEERED.items() if name in rows.columns}
    coded = rows.withColumn("gender_encoding", gender_code(F.col("gender")))
    return encoder.transform(coded, lookups, on_unseen=on_unseen), encoder


def matrices(
    prepared: Prepared, features: list[str] = FEATURES, how: str = "downsample"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Target-first feature matrices; the training rows are balanced."""
    train = balance(prepared.train, how)
    return tuple(project(df, features) for df in (train, prepared.validation, prepared.test))


def preprocess_to_files(
    impressions: DataFrame, out: str, cuts: tuple[str, str] = (FIRST_CUT, SECOND_CUT),
    engineered: bool = False, **options,
) -> Prepared:
    """Writes train (balanced and shuffled), validation and test as headerless CSV folders."""
    features = FEATURES_ENGINEERED if engineered else FEATURES
    prepared = preprocess(impressions, cuts, engineered=engineered, **options)
    train = shuffle_rows(balance(prepared.train))
    for name, df in (
        ("train", train), ("validation", prepared.validation), ("test", prepared.test),
    ):
        write_matrix(project(df, features), f"{out}/{name}")
    return prepared


UNSEEN = ("error", "null", "extend", "reject")


def transactions(
    impressions: DataFrame, encoder: Encoder | None = None, on_unseen: str = "error", rolling: DataFrame | None = None
) -> tuple[DataFrame, Encoder]:
    """All impressions with rolling features and codes, and the encoder that gave them.

    Pass the saved encoder of the trained model to keep its codes; without one they are fitted on
    this load. A label that the encoder does not know raises, gets a null code (null, reject), or the next free code (extend).
    ``rolling`` are the rows of ``staged_rolling``, where the caller has them.
    """
    if on_unseen not in UNSEEN:
        raise ValueError(f"on_unseen must be one of {UNSEEN}, not {on_unseen!r}")
    rows = staged_rolling(impressions) if rolling is None else rolling
    if encoder is not None and on_unseen == "extend":
        encoder = encoder.extended(rows)
    return encode_all(rows, encoder, on_unseen="null" if on_unseen in ("null", "reject") else "error")


def ingest_features(
    impressions: DataFrame,
    transactions_path: str,
    customers_path: str,
    load_time: str,
    encoder: Encoder | None = None,
    on_unseen: str = "error",
) -> Encoder:
    """Feature ingestion: both feature tables from one load; returns the encoder, to be saved where it was extended.

    See ``transactions`` for ``on_unseen``; with ``reject``, rows with a label without a code go to
    ``<transactions_path>_unseen`` instead of the tables.
    """
    rows, encoder = transactions(impressions, encoder, on_unseen)
    if on_unseen == "reject":
        codes = [F.col(c) for c in rows.columns if c.endswith("_encoding")]
        known = reduce(Column.__and__, [c.isNotNull() for c in codes])
        append_features(stamp(rows.where(~known), load_time), f"{transactions_path}_unseen", load_id=load_time)
        rows = rows.where(known)
    customers = customer_profile(rows)
    for df, path, key in ((rows, transactions_path, ID), (customers, customers_path, USER)):
        ingest(df, path, infer_definitions(df), key, load_time, rejects_path=f"{path}_rejects")
    return encoder


def feature_store_frames(
    impressions: DataFrame, load_time: str, cuts: tuple[str, str] = (FIRST_CUT, SECOND_CUT)
) -> tuple[DataFrame, DataFrame]:
    """Store-ready transactions and customers of the training rows only, ids and times as text."""
    train = preprocess(impressions, cuts, engineered=True).train
    customers = stamp(customer_profile(train), load_time, EVENT_TIME)
    stamped = stamp(train, load_time, EVENT_TIME)
    return to_string(stamped, [USER, ID, EVENT_TIME, TIME]), customers


def train_evaluate(
    impressions: DataFrame,
    out: str,
    cuts: tuple[str, str] = (FIRST_CUT, SECOND_CUT),
    group: str = "ctr",
    version: int | None = None,
    created: str | None = None,
    fit: Callable[[DataFrame], PipelineModel] = fit_boosted,
    comparison: str = ">=",
    threshold: float = F1_THRESHOLD,
    status: str = PENDING,
    engineered: bool = False,
    rolling: DataFrame | None = None,
) -> DataFrame:
    """Prepare, fit, evaluate on the test rows, report, and register the model if it passes.

    Returns one row with the F1 score; the model, the report and the registry lie below ``out``. The registry gives the
    version number, unless one is asked for that nobody has; nothing is ever overwritten. The model keeps its encoder as
    its first stage. ``created`` is now by default. ``rolling`` as in ``preprocess``.
    """
    prepared = preprocess(impressions, cuts, engineered=engineered, rolling=rolling)
    train, _, test = matrices(prepared, FEATURES_ENGINEERED if engineered else FEATURES)
    model = fit(stage(train, "train"))
    version = claim_version(impressions.sparkSession, f"{out}/registry", group, version)
    created = created or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    model_path = f"{out}/models/{group}/{version}"
    PipelineModel(stages=[CodeLookup(encoder=prepared.encoder), *model.stages]).write().save(model_path)
    report = stage(f1_score(predict(model, test, inclusive=True)), "report")
    write_report(as_report(report), f"{out}/reports/{group}/{version}")
    candidate = report.select(
        F.lit(group).alias("model_group"), F.lit(version).alias("version"),
        F.lit(model_path).alias("model_path"),
        F.lit(created).cast("timestamp_ntz").alias("created"), F.col("f1_score").alias("f1"),
    )
    passed = quality_gate(candidate, "f1", comparison, threshold)
    register_models(passed, f"{out}/registry", status)
    return report


def approved_model(spark: SparkSession, out: str, group: str = "ctr") -> PipelineModel:
    """The newest approved model of a group, its encoder included; raises when there is none."""
    return PipelineModel.load(approved_path(read_registry(spark, f"{out}/registry"), group))


def score_approved(
    requests: DataFrame, customers: DataFrame, out: str, group: str = "ctr", threshold: float = 0.5
) -> DataFrame:
    """Request rows scored by the newest approved model of a group, from what lies below ``out`` alone."""
    return score_with(approved_model(requests.sparkSession, out, group), requests, customers, threshold)
