"""Per-value counts of several columns in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def value_tally(
    df: DataFrame, columns: Sequence[str], *aggregates: Column, by: Sequence[str] = ()
) -> DataFrame:
    """One row per column and distinct non-null value (and ``by`` value), with the aggregates.

    Rows carry ``column`` and the value in its own, typed column; the other value columns are
    null, so sorting by all of them sorts by the value. Grouping sets read the input once and
    combine before the shuffle, so a frequent value is no hot spot.
    """
    columns = list(columns)
    sets = [[c, *by] for c in columns]
    grouped = df.groupingSets(sets, *columns, *by).agg(
        *[F.grouping(c).alias(f"_without_{c}") for c in columns], *aggregates
    )
    name = F.coalesce(*[
        F.when((F.col(f"_without_{c}") == 0) & F.col(c).isNotNull(), c) for c in columns
    ])
    return (
        grouped.withColumn("column", name)
        .where(F.col("column").isNotNull())
        .drop(*[f"_without_{c}" for c in columns])
    )
