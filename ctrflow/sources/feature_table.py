"""Feature tables of replaceable loads, and the views on them.

A load is written to a folder of its own, and becomes part of the table when the table's newest state names it. So a load that
fails halfway leaves nothing behind that anybody reads, and a load that is given again under its id replaces the earlier one.
States also hold the declared schema of each load, so that reading opens no file to learn it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ctrflow.operators.conform import EVENT_TIME, conform, split_valid
from ctrflow.schema import spare_names
from ctrflow.sources.commits import Commits

DATE = T.StructField("event_date", T.DateType())
#: Names of the folders of a load, which partition discovery gives back as columns.
LOAD, ATTEMPT = "_load", "_attempt"
#: Partition column and raw text of rows that a verified stream did not take.
REJECTED, RECORD = "is_rejected", "rejected_record"


def commits(spark: SparkSession, path: str) -> Commits:
    return Commits(spark, f"{path.rstrip('/')}/_commits")


def dated(df: DataFrame, event_time: str = EVENT_TIME) -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.substring(F.col(event_time).cast("string"), 1, 10)))


def append_features(df: DataFrame, path: str, event_time: str = EVENT_TIME, load_id: str | None = None) -> None:
    """Adds a load, partitioned by the date of its event time; a load of the same ``load_id`` is replaced.

    No repartitioning: a load usually has one date, and shuffling by it would make a hot spot.
    """
    load = load_id or uuid.uuid4().hex
    folder = f"{LOAD}={quote(load, safe='')}/{ATTEMPT}={uuid.uuid4().hex}"
    rows = dated(df, event_time)
    rows.write.partitionBy("event_date").parquet(f"{path.rstrip('/')}/{folder}")
    fields = [f for f in json.loads(rows.schema.json())["fields"] if f["name"] != "event_date"]

    def add(state: dict | None) -> dict:
        state = state or {"loads": {}, "stream": None}
        return state | {"loads": {k: v for k, v in state["loads"].items() if k != load} | {load: {"folder": folder, "fields": fields}}}

    commits(df.sparkSession, path).update(add)


def remove_load(spark: SparkSession, path: str, load_id: str) -> None:
    """Takes a load out of the table; raises if it is not there."""

    def drop(state: dict | None) -> dict:
        if not state or load_id not in state["loads"]:
            raise KeyError(f"no load {load_id} in {path}")
        return state | {"loads": {k: v for k, v in state["loads"].items() if k != load_id}}

    commits(spark, path).update(drop)


def declare_stream(spark: SparkSession, path: str, schema: T.StructType, verified: bool = False) -> None:
    """Notes the schema of what a stream adds; columns that it had before stay.

    The files of a ``verified`` stream are parted by ``REJECTED``. A table takes streams of one of the two kinds.
    """
    fields = [f for f in json.loads(schema.json())["fields"] if f["name"] not in ("event_date", REJECTED, RECORD)]

    def note(state: dict | None) -> dict:
        state = state or {"loads": {}, "stream": None}
        if state["stream"] and state.get("verified", False) != verified:
            raise ValueError(f"the streams of {path} are {'not ' * verified}verified")
        return state | {"stream": _together(path, [state["stream"] or [], fields]), "verified": verified}

    state = commits(spark, path).last()[1]
    if not state or note(state) != state:
        commits(spark, path).update(note)


def read_stream_files(spark: SparkSession, path: str, state: dict, fields: list[dict], files: Sequence[str] = ()) -> DataFrame:
    """The rows that streams added, all of them or those of the given files; rejects stay out by their partition."""
    verified = state.get("verified", False)
    schema = _schema(fields, *[T.StructField(REJECTED, T.BooleanType())] * verified)
    folder = stream_path(path)
    reader = spark.read.schema(schema)
    df = reader.option("basePath", folder).parquet(*[f"{folder}/{f}" for f in files]) if files else reader.parquet(folder)
    return df.where(~F.col(REJECTED)).drop(REJECTED) if verified else df


def read_stream_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(event_date, record): what verified streams could not store, each record as the JSON text of all it had."""
    schema = T.StructType([T.StructField(RECORD, T.StringType()), DATE, T.StructField(REJECTED, T.BooleanType())])
    _, state = commits(spark, path).last()
    if not state or not state.get("verified") or not _has_files(spark, stream_path(path)):
        return spark.createDataFrame([], T.StructType([DATE, schema[RECORD]]))
    return spark.read.schema(schema).parquet(stream_path(path)).where(REJECTED).select("event_date", RECORD)


def stream_path(path: str) -> str:
    """Where streams put their files. The sink keeps a log there that hides all other files of its folder from readers,
    so it is a folder of its own, which readers of the table itself pass over for its underscore."""
    return f"{path.rstrip('/')}/_stream"


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is anything but hidden files in the folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return any(not n.startswith(("_", ".")) for n in names)


def _together(path: str, parts: Sequence[list[dict]]) -> list[dict]:
    """Fields of all parts in the order they first appear; types that differ raise."""
    found: dict[str, dict] = {}
    for field in (f for fields in parts for f in fields):
        known = found.setdefault(field["name"], field | {"nullable": True})
        if known["type"] != field["type"]:
            raise ValueError(f"{field['name']} is {known['type']} in some loads of {path} and {field['type']} in others")
    return list(found.values())


def _schema(fields: list[dict], *more: T.StructField) -> T.StructType:
    return T.StructType([*T.StructType.fromJson({"type": "struct", "fields": fields}).fields, DATE, *more])


def read_loads(spark: SparkSession, path: str, folders: Sequence[str], fields: list[dict]) -> DataFrame:
    """The rows of the given folders, with the given fields and the date; fields that a load lacks are null."""
    schema = _schema(fields, T.StructField(LOAD, T.StringType()), T.StructField(ATTEMPT, T.StringType()))
    root = path.rstrip("/")
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*[f"{root}/{f}" for f in folders]).drop(LOAD, ATTEMPT)


def read_features(
    spark: SparkSession, path: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The whole table, or the loads of a date range (by partition pruning).

    Loads and streams lie side by side. A column that only some of them have is null in the others; one whose types
    differ raises.
    """
    _, state = commits(spark, path).last()
    if state is None:
        raise FileNotFoundError(f"no feature table at {path}")
    loads = list(state["loads"].values())
    fields = _together(path, [*[x["fields"] for x in loads], state["stream"] or []])
    frames = [read_loads(spark, path, [x["folder"] for x in loads], fields)] if loads else []
    if state["stream"] and _has_files(spark, stream_path(path)):
        frames.append(read_stream_files(spark, path, state, fields))
    df = reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], _schema(fields))
    if since:
        df = df.where(F.col("event_date") >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col("event_date") <= F.lit(until).cast("date"))
    return df


class RejectedRows(Exception):
    """Some rows of a load could not be stored."""


def ingest(
    df: DataFrame,
    path: str,
    definitions: Mapping[str, str],
    key: str,
    load_time: str,
    rejects_path: str | None = None,
    fail: bool = True,
    load_id: str | None = None,
) -> int:
    """Adds the rows that fit the declared schema; returns the number of rows that do not.

    ``load_time`` stamps the rows and names the load, unless ``load_id`` does. Rejects are stored when there are any, and raise
    after that unless ``fail`` is off. A load that is given again under its name replaces its rows and its rejects, so a
    retry doubles nothing. Looking for rejects reads only the columns whose values may not fit.
    """
    spark, load_id = df.sparkSession, load_id or load_time
    stamped = df.withColumn(EVENT_TIME, F.lit(load_time))
    good, bad = split_valid(stamped, definitions, key)
    append_features(conform(good, definitions, load_time), path, load_id=load_id)
    rejects = bad.count()
    if rejects_path:
        if rejects:
            append_features(bad, rejects_path, load_id=load_id)
        elif load_id in (commits(spark, rejects_path).last()[1] or {"loads": {}})["loads"]:
            remove_load(spark, rejects_path, load_id)
    if rejects and fail:
        raise RejectedRows(f"{rejects} rows could not be stored in {path}")
    return rejects


def latest_per_key(
    df: DataFrame, key: str, event_time: str = EVENT_TIME, then: Sequence[str] = ()
) -> DataFrame:
    """The newest record per key; ``then`` settles equal times, the largest first, and after it a hash of the record.

    Spark drops all but the first rank of each input partition before the shuffle.
    """
    order = [F.desc(event_time), *[F.desc(c) for c in then], F.xxhash64(*df.columns)]
    rank = spare_names(df, "_rank")[0]
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(rank) == 1).drop(rank)


def get_record(
    df: DataFrame, key: str, value, event_time: str = EVENT_TIME, then: Sequence[str] = ()
) -> DataFrame:
    """The newest record of one key; the filter reaches the scan. Empty when there is none."""
    return latest_per_key(df.where(F.col(key) == F.lit(value)), key, event_time, then)


def lookup_default(
    df: DataFrame, latest: DataFrame, key: str, feature: str, default: float = -1.0
) -> DataFrame:
    """One feature by key, as a double, with a default for keys without a record."""
    at, value = spare_names(df, "_key", "_found")
    found = latest.select(F.col(key).alias(at), F.col(feature).cast("double").alias(value))
    return (
        df.join(found, F.col(key) == F.col(at), "left")
        .withColumn(feature, F.coalesce(value, F.lit(default)))
        .drop(at, value)
    )
