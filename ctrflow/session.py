"""Session set-up, shared scratch space and staging."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Largest lookup that may travel through the driver and be broadcast.
MAX_LOCAL_ROWS = 100_000


def build_session(app: str = "ctrflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # State of a stream lives on disk, not in the heap of the executors.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local-mode session without
    that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="ctrflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return os.path.join(scratch_root(spark), "ctrflow", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and lets every later pass read
    only the columns it needs, which a cached or checkpointed frame would not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_staged(df: DataFrame, name: str, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """``df`` as a local relation when it has at most ``max_rows`` rows, else as a staged table.

    Spark knows the size of both and chooses the join from it: the former is broadcast, the latter
    is shuffled unless its files turn out small.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(head, df.schema)
    return stage(df, name)
