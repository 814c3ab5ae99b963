"""The online view of a feature table: one row per key, kept up to date with the table's loads.

The snapshot lies in the table's folder as generations, each one row per key, dealt to buckets by a hash of the key and
sorted by it, with a bloom filter of the keys in every file. A refresh reads only loads and stream files that came since the last
one, and writes their newest rows as a further generation. When the later generations together have grown to half of the
first, or are many, all are merged into one. So a refresh costs what is new, and a merge is paid for by the rows before it.

Reading one generation is a plain scan; several are put together by ``max_by``. One key is looked up in its bucket alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ctrflow.operators.conform import EVENT_TIME
from ctrflow.sources.commits import Commits
from ctrflow.sources.feature_table import _has_files, _schema, _together, commits, read_loads, read_stream_files, stream_path

BUCKET = "_bucket"
#: Generations that are read side by side before they are merged.
MOST_GENERATIONS = 8


def _root(path: str, key: str) -> str:
    return f"{path.rstrip('/')}/_latest/{key}"


def newest(df: DataFrame, key: str, event_time: str = EVENT_TIME, then: Sequence[str] = ()) -> DataFrame:
    """The newest record per key; ``then`` settles equal times, the largest first, and after it a hash of the record.

    An aggregate that combines before the shuffle, with the same answer as ``latest_per_key``.
    """
    rest = [c for c in df.columns if c != key]
    # The last rank goes to the smallest hash, so its bits are turned over.
    order = F.struct(event_time, *then, F.bitwise_not(F.xxhash64(*[c for c in df.columns if c != BUCKET])))
    found = df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("record"))
    return found.select(*[F.col(key) if c == key else F.col(f"record.{c}").alias(c) for c in df.columns])


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def refresh_latest(
    spark: SparkSession, path: str, key: str, event_time: str = EVENT_TIME, then: Sequence[str] = (), buckets: int | None = None
) -> int:
    """Brings the snapshot of ``key`` up to the table's newest state; returns the number of generations it has then.

    ``buckets`` counts for the first refresh (the number of shuffle partitions if not given). The order has to stay the
    same. Rows without a key are nobody's record and stay out. If a load was replaced or removed since, the snapshot is
    built anew, since a newest row cannot be taken back. Stream files are told apart by their names, which a state lists.
    """
    log = Commits(spark, f"{_root(path, key)}/_commits")
    _, table = commits(spark, path).last()
    if table is None:
        raise FileNotFoundError(f"no feature table at {path}")
    number, state = log.last()
    folders = [x["folder"] for x in table["loads"].values()]
    fields = _together(path, [*[x["fields"] for x in table["loads"].values()], table["stream"] or []])
    order = [event_time, *then]
    if state and state["order"] != order:
        raise ValueError(f"the snapshot is ordered by {state['order']}, not by {order}")
    count = state["buckets"] if state else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not state or not set(state["folders"]) <= set(folders):
        state = {"generations": [], "folders": [], "stream_files": []}

    fresh = [f for f in folders if f not in set(state["folders"])]
    files = _stream_files(spark, path, fields) if table["stream"] else []
    seen = set(state["stream_files"])
    new_files = [f for f in files if f not in seen]
    frames = [read_loads(spark, path, fresh, fields)] if fresh else []
    if new_files:
        frames.append(read_stream_files(spark, path, table, fields, new_files))
    generations = list(state["generations"])
    if frames:
        keyed = reduce(DataFrame.unionByName, frames).where(F.col(key).isNotNull())
        generations.append(_write(newest(keyed, key, event_time, then), path, key, count))
    small = sum(g["rows"] for g in generations[1:])
    if len(generations) > 1 and (len(generations) > MOST_GENERATIONS or 2 * small >= generations[0]["rows"]):
        generations = [_write(newest(_read(spark, path, key, generations, fields), key, event_time, then), path, key, count)]
    if not frames and fields == state.get("fields") and set(folders) == set(state["folders"]):
        return len(generations)
    changed = {"generations": generations, "folders": folders, "stream_files": files, "fields": fields, "order": order, "buckets": count}
    if not log.claim(number + 1, changed):
        raise RuntimeError(f"another refresh of {key} in {path} was faster")
    return len(generations)


def _stream_files(spark: SparkSession, path: str, fields: list[dict]) -> list[str]:
    """Files that the sink has committed, below the folder of the stream."""
    folder = stream_path(path)
    if not _has_files(spark, folder):
        return []
    start = "/_stream/"
    return sorted(f[f.rindex(start) + len(start):] for f in spark.read.schema(_schema(fields)).parquet(folder).inputFiles())


def _write(df: DataFrame, path: str, key: str, buckets: int) -> dict:
    folder = f"generation={uuid.uuid4().hex}"
    rows = df.withColumn(BUCKET, _bucket(F.col(key), buckets)).repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, key)
    target = f"{_root(path, key)}/{folder}"
    rows.write.partitionBy(BUCKET).option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(target)
    return {"folder": folder, "rows": df.sparkSession.read.schema(rows.schema).parquet(target).count()}


def _read(spark: SparkSession, path: str, key: str, generations: list[dict], fields: list[dict]) -> DataFrame:
    schema = _schema(fields, T.StructField(BUCKET, T.IntegerType()), T.StructField("generation", T.StringType()))
    root = _root(path, key)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{g['folder']}" for g in generations]).drop("generation")


def _state(spark: SparkSession, path: str, key: str) -> dict:
    _, state = Commits(spark, f"{_root(path, key)}/_commits").last()
    if state is None:
        raise FileNotFoundError(f"no snapshot of {key} in {path}; refresh it first")
    return state


def _view(spark: SparkSession, path: str, key: str, state: dict, only: Column | None = None) -> DataFrame:
    if not state["generations"]:
        return spark.createDataFrame([], _schema(state["fields"]))
    df = _read(spark, path, key, state["generations"], state["fields"])
    if only is not None:
        df = df.where(only)
    df = df.drop(BUCKET)
    return df if len(state["generations"]) == 1 else newest(df, key, state["order"][0], state["order"][1:])


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest record of every key as of the last refresh."""
    return _view(spark, path, key, _state(spark, path, key))


def get_latest(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The newest record of one key as of the last refresh: one bucket is read, and in it what the bloom filters let through.

    Empty when there is none.
    """
    state = _state(spark, path, key)
    kind = T.StructType.fromJson({"type": "struct", "fields": state["fields"]})[key].dataType
    wanted = F.lit(value).cast(kind)
    return _view(spark, path, key, state, (F.col(BUCKET) == _bucket(wanted, state["buckets"])) & (F.col(key) == wanted))


def drop_old_generations(spark: SparkSession, path: str, key: str) -> int:
    """Deletes generations that the newest state does not name; returns how many. Not while somebody reads an older state."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_root(path, key))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    used = {g["folder"] for g in _state(spark, path, key)["generations"]}
    old = [f.getPath() for f in files.listStatus(root) if f.getPath().getName().startswith("generation=") and f.getPath().getName() not in used]
    for folder in old:
        files.delete(folder, True)
    return len(old)
