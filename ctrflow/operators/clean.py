"""Required fields and duplicate impressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ctrflow.functions.time import with_time_parts
from ctrflow.schema import DEDUP_KEY, ID, REQUIRED


def nan_as_null(df: DataFrame) -> DataFrame:
    """A number column has one way to say that a value is missing."""
    return df.withColumns({c: F.nullif(c, F.lit(float("nan"))) for c, t in df.dtypes if t == "double"})


def drop_null_required(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows where all of the columns are known; unlike ``na.drop`` this reaches the scan."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def dedup_impressions(
    df: DataFrame, key: Sequence[str] = DEDUP_KEY, order: str = ID
) -> DataFrame:
    """One row per key, the one with the lowest ``order`` value; nulls in the key compare equal.

    A grouping rather than a window: copies collapse before the shuffle, so a key that holds a
    large share of all rows costs one row per input partition.
    """
    others = [c for c in df.columns if c not in key and c != order]
    if not others:
        first = df.groupBy(*key).agg(F.min(order).alias(order))
    else:
        first = (
            df.groupBy(*key)
            .agg(F.min(F.struct(order, *others)).alias("_first"))
            .select(*key, "_first.*")
        )
    return first.select(*df.columns)


def clean_rows(df: DataFrame) -> DataFrame:
    """Required fields present, duplicates gone, missing numbers null, hour and time of day added."""
    return with_time_parts(dedup_impressions(drop_null_required(nan_as_null(df))))
