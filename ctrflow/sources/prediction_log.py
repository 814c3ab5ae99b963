"""Sampled log of scoring inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ctrflow.functions.hashing import percent_bucket
from ctrflow.schema import ID

# ---- fixed values: sampling percentage by stage ---------------------------------------------
CAPTURE_PERCENT = {"staging": 100, "prod": 80}
# ---- end of fixed values --------------------------------------------------------------------


def sample_log(
    df: DataFrame, percent: int = CAPTURE_PERCENT["prod"], key: str = ID, seed: int = 42
) -> DataFrame:
    """The rows to log: a percentage of keys, the same ones in every run."""
    return df.where(percent_bucket(F.col(key), seed) < percent)


def append_log(df: DataFrame, path: str, **sampling) -> None:
    sample_log(df, **sampling).write.mode("append").parquet(path)
