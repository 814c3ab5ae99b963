"""The model registry table and the quality gate before it."""

from __future__ import annotations

import operator
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ctrflow.sources.commits import Commits

# ---- fixed values: approval states ----------------------------------------------------------
PENDING, APPROVED, REJECTED = "PendingManualApproval", "Approved", "Rejected"
# ---- end of fixed values --------------------------------------------------------------------
REGISTRY = (
    "model_group string, version int, model_path string, status string, created timestamp_ntz, f1 double, "
    "changed timestamp_ntz"
)
COMPARISONS = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt}
F1_THRESHOLD = 0.2


class NoApprovedModel(Exception):
    """A group has no approved version."""


class UnknownVersion(Exception):
    """A version that the registry does not have."""


class VersionTaken(Exception):
    """A version number that another model has."""


def claim_version(spark: SparkSession, path: str, group: str, version: int | None = None) -> int:
    """The next version number of a group, or the given one; nobody else gets it, whether the model is registered in the end or not."""
    numbers = Commits(spark, f"{path.rstrip('/')}/_versions/{quote(group, safe='')}")
    if version is None:
        return numbers.update(lambda _: {})
    if not numbers.claim(version, {}):
        raise VersionTaken(f"version {version} of group {group} exists")
    return version


def quality_gate(
    df: DataFrame, metric: Column | str = "f1", comparison: str = ">=", threshold: float = F1_THRESHOLD
) -> DataFrame:
    """The candidates whose metric passes."""
    value = F.col(metric) if isinstance(metric, str) else metric
    return df.where(COMPARISONS[comparison](value, F.lit(threshold)))


def register_models(df: DataFrame, path: str, status: str = PENDING) -> None:
    """Appends candidates to the registry; without a status of their own they await approval."""
    if "status" not in df.columns:
        df = df.withColumn("status", F.lit(status))
    if "changed" not in df.columns:
        df = df.withColumn("changed", F.col("created"))
    names = [part.split()[0] for part in REGISTRY.split(", ")]
    df.select(*names).write.mode("append").parquet(path)


def set_status(registry: DataFrame, path: str, group: str, version: int, status: str, changed: Column) -> None:
    """Appends a change of status of a version; raises if ``registry`` has no such version."""
    known = registry.where((F.col("model_group") == group) & (F.col("version") == version)).drop("status", "changed").limit(1)
    if known.isEmpty():
        raise UnknownVersion(f"no version {version} of group {group}")
    register_models(known.withColumns({"status": F.lit(status), "changed": changed.cast("timestamp_ntz")}), path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(path)


def latest_approved(registry: DataFrame) -> DataFrame:
    """The newest approved version of every group that has one.

    The table is append-only: a change of status is a new row of the version with the time of the change. The last change
    counts; of changes at one time the one that is not an approval.
    """
    newest = F.struct("created", "version", "model_path", "f1")
    last = F.struct(F.coalesce("changed", "created").alias("at"), (F.col("status") != APPROVED).alias("not_approved"), "*")
    current = registry.groupBy("model_group", "version").agg(F.max(last).alias("_last")).select("_last.*")
    return (
        current.where(F.col("status") == APPROVED)
        .groupBy("model_group")
        .agg(F.max(newest).alias("_newest"))
        .select("model_group", "_newest.version", "_newest.model_path", "_newest.created", "_newest.f1")
    )


def approved_path(registry: DataFrame, group: str) -> str:
    """Path of the newest approved model of one group; raises when there is none."""
    found = latest_approved(registry.where(F.col("model_group") == group)).first()
    if found is None:
        raise NoApprovedModel(f"no approved model in group {group}")
    return found["model_path"]
