"""Frames that fit a declared feature schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ctrflow.functions.time import stamp
from ctrflow.schema import infer_definitions

EVENT_TIME = "event_time"
# ---- fixed values: declared feature kinds ---------------------------------------------------
SPARK_TYPES = {"Integral": "bigint", "Fractional": "double", "String": "string"}
# ---- end of fixed values --------------------------------------------------------------------
_SAFE = {("Integral", "Integral"), ("Integral", "Fractional"), ("Fractional", "Fractional")}


def _features(df: DataFrame, definitions: Mapping[str, str]) -> list[str]:
    names = [name for name in definitions if name != EVENT_TIME]
    if absent := [name for name in names if name not in df.columns]:
        raise ValueError(f"features missing from the frame: {', '.join(absent)}")
    return names


def conform(df: DataFrame, definitions: Mapping[str, str], load_time: str) -> DataFrame:
    """The declared features in their declared kinds, restamped with the load time.

    A value that does not fit its kind becomes null; ``split_valid`` tells such rows apart. A kind
    nobody knows is stored as a string.
    """
    return stamp(df.select(*declared(df, definitions)), load_time, EVENT_TIME)


def declared(df: DataFrame, definitions: Mapping[str, str]) -> list[Column]:
    """The declared features in their kinds; null where a value does not fit."""
    return [
        F.col(c).try_cast(SPARK_TYPES.get(definitions[c], "string")).alias(c)
        for c in _features(df, definitions)
    ]


def _may_not_fit(source: str, kind: str) -> bool:
    """Whether values of a frame kind can fail to become a declared kind."""
    return kind in ("Integral", "Fractional") and (source, kind) not in _SAFE


def is_valid(
    df: DataFrame, definitions: Mapping[str, str], key: str, time: str = EVENT_TIME
) -> Column:
    """Whether a raw row can be stored: key and time present, every value fits its kind.

    Columns whose type already fits are not looked at, so checking a typed frame costs next to
    nothing: the filter on the key reaches the scan.
    """
    kinds = infer_definitions(df)
    risky = [c for c in _features(df, definitions) if _may_not_fit(kinds[c], definitions[c])]
    fits = [
        F.col(c).isNull() | F.col(c).try_cast(SPARK_TYPES[definitions[c]]).isNotNull() for c in risky
    ]
    return reduce(Column.__and__, fits, F.col(key).isNotNull() & F.col(time).isNotNull())


def split_valid(
    df: DataFrame, definitions: Mapping[str, str], key: str, time: str = EVENT_TIME
) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored and rows that cannot."""
    valid = is_valid(df, definitions, key, time)
    return df.where(valid), df.where(~valid)
