"""CSV files and JSON metric reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ctrflow.schema import IMPRESSIONS, TARGET


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = IMPRESSIONS, **options: str
) -> DataFrame:
    """CSV with a header row and a declared schema (no inference pass)."""
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row; times keep their microseconds."""
    df.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def write_matrix(df: DataFrame, path: str, target: str = TARGET) -> None:
    """Headerless CSV, target column first. Row order is kept, one file per partition."""
    features = [c for c in df.columns if c != target]
    df.select(target, *features).write.option("header", False).csv(path)


def read_matrix(
    spark: SparkSession, path: str, features: Sequence[str], target: str = TARGET, dtype: str = "int"
) -> DataFrame:
    """Headerless CSV whose column 0 is the target."""
    schema = ", ".join(f"`{c}` {dtype}" for c in [target, *features])
    return spark.read.schema(schema).csv(path)


# ---- fixed values: layout of the evaluation report ------------------------------------------
REPORT = "classification_metrics struct<f1_score: struct<value: double>>"
F1_PATH = "$.classification_metrics.f1_score.value"
# ---- end of fixed values --------------------------------------------------------------------


def report_struct(f1: Column) -> Column:
    return F.struct(F.struct(f1.alias("value")).alias("f1_score"))


def as_report(df: DataFrame, f1: str = "f1_score") -> DataFrame:
    """Replaces the metric column with the nested report."""
    return df.withColumn("classification_metrics", report_struct(F.col(f1))).drop(f1)


def write_report(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_report(spark: SparkSession, path: str, keys: str = "") -> DataFrame:
    return spark.read.schema(", ".join(filter(None, [keys, REPORT]))).json(path)


def json_metric(report: Column, path: str = F1_PATH) -> Column:
    """A number out of a JSON text."""
    return F.get_json_object(report, path).cast("double")
