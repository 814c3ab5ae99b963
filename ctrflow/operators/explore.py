"""Summaries of an impression log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ctrflow.schema import ID, TARGET, TIME, USER


def time_bounds(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.agg(F.min(time).alias("earliest"), F.max(time).alias("latest"))


def distinct_users(df: DataFrame, user: str = USER) -> DataFrame:
    return df.agg(F.count_distinct(user).alias("users"))


def _rate(target: str) -> Column:
    return F.sum(target) / F.count(target)


def overall_ctr(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Clicks and click rate over the rows whose target is known."""
    return df.agg(F.sum(target).alias("clicks"), _rate(target).alias("ctr"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, then by value; nulls do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def clicks_by(df: DataFrame, column: str, target: str = TARGET) -> DataFrame:
    """Clicks per value of a column (a timestamp, an hour), in its order; null keys drop out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.coalesce(F.sum(target), F.lit(0)).alias("number_of_clicks"))
        .orderBy(column)
    )


def category_ctr(
    df: DataFrame, column: str, target: str = TARGET, row_id: str = ID
) -> DataFrame:
    """Sessions, clicks and click rate per category; the rate is null where no row has a session."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            F.count(row_id).alias("no_of_sessions"),
            F.coalesce(F.sum(target), F.lit(0)).alias("no_of_clicks"),
        )
        .withColumn("ctr", F.try_divide("no_of_clicks", "no_of_sessions"))
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Non-null count and type per column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column"),
            F.col(name).alias("non_null"),
            F.lit(dtype).alias("dtype"),
        )
        for name, dtype in df.dtypes
    ])
    return counts.select(F.inline(rows))


def top_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group, the lowest one when several are.

    Counts are combined before the shuffle; the ranking sees one row per group and value.
    """
    counts = (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("count"), value))
    return counts.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def sort_impressions(df: DataFrame, order: Sequence[str] = (USER, TIME, ID)) -> DataFrame:
    return df.orderBy(*order)


def newest_first(df: DataFrame, time: str = "event_time", then: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(time), *then)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows of an order."""
    return df.orderBy(*order).limit(n)


def summary(df: DataFrame, time: str = TIME, user: str = USER, target: str = TARGET) -> DataFrame:
    """Time bounds, users, clicks and click rate in one row and one pass."""
    return df.agg(
        F.min(time).alias("earliest"),
        F.max(time).alias("latest"),
        F.count_distinct(user).alias("users"),
        F.sum(target).alias("clicks"),
        _rate(target).alias("ctr"),
    )
