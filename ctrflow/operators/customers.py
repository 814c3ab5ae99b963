"""Customer-level features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ctrflow.schema import ENGINEERED, ID, TIME, USER

FIRST = ["gender_encoding", "age_level_encoding"]
LARGEST = [f"{c}_encoding" for c in ENGINEERED.values()]


def customer_profile(
    df: DataFrame,
    first: Sequence[str] = FIRST,
    largest: Sequence[str] = LARGEST,
    user: str = USER,
    order: Sequence[str] = (TIME, ID),
) -> DataFrame:
    """Per user: the earliest known value of some columns and the largest value of others.

    Every aggregate combines before the shuffle, so a busy user is no hot spot.
    """
    earliest = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in first
    ]
    return df.groupBy(user).agg(*earliest, *[F.max(c).alias(c) for c in largest])


def attach_features(
    df: DataFrame, features: DataFrame, keys: Sequence[str] = (USER, ID)
) -> DataFrame:
    """Features stored elsewhere, by key; rows without any keep nulls and none is multiplied.

    A key that is repeated in the feature table counts once, with its largest record (compared column by column from the
    first, nulls lowest).
    """
    keys = list(keys)
    rest = [c for c in features.columns if c not in keys]
    unique = features.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_record")).select(*keys, "_record.*")
    return df.join(unique, keys, "left")
