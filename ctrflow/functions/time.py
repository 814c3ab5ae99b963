"""Timestamps, day parts and their text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ctrflow.schema import TIME


def parse_datetime(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]") -> Column:
    """Text to a timestamp without time zone."""
    return F.to_timestamp_ntz(text, F.lit(pattern))


def time_of_day(hour: Column) -> Column:
    """Part of the day for an hour 0-23; midnight and a missing hour count as evening."""
    return (
        F.when(hour.between(1, 4) | (hour == 23), "night")
        .when(hour.between(5, 9), "early-morning")
        .when(hour.between(10, 13), "morning")
        .when(hour.between(14, 17), "afternoon")
        .otherwise("evening")
    )


def with_time_parts(df: DataFrame, time: str = TIME) -> DataFrame:
    """Adds ``hour`` and ``time_of_day``."""
    hour = F.hour(time)
    return df.withColumns({"hour": hour, "time_of_day": time_of_day(hour)})


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 in UTC with milliseconds and a trailing Z (the session time zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def stamp(df: DataFrame, load_time: str, column: str = "event_time") -> DataFrame:
    """One constant load time for all rows; an argument, so that a re-run gives the same table."""
    return df.withColumn(column, F.lit(load_time))
