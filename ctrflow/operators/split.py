"""Row subsets: by time, by class, and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ctrflow.schema import TARGET, TIME

PARTS = ("train", "validation", "test")


def time_point(text: str):
    return F.lit(text).cast("timestamp_ntz")


def with_split(df: DataFrame, first: str, second: str, time: str = TIME) -> DataFrame:
    """Adds ``split``: train before ``first``, validation before ``second``, test from there on."""
    part = (
        F.when(F.col(time) < time_point(first), "train")
        .when(F.col(time) < time_point(second), "validation")
        .when(F.col(time) >= time_point(second), "test")
    )
    return df.withColumn("split", part)


def time_split(
    df: DataFrame, first: str, second: str, time: str = TIME
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three filtered frames; the cut points are literals, so they reach a Parquet scan."""
    t = F.col(time)
    return (
        df.where(t < time_point(first)),
        df.where((t >= time_point(first)) & (t < time_point(second))),
        df.where(t >= time_point(second)),
    )


def class_split(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """Rows of class 0 and of class 1; others belong to neither."""
    return df.where(F.col(target) == 0), df.where(F.col(target) == 1)


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)
