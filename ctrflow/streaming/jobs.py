"""Continuous feature ingest, latest record per key, and scoring.

All jobs are restartable from their checkpoint and end when the input present at the start is
consumed, unless another trigger is given. Sinks are Parquet files, exactly once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ctrflow.functions.hashing import percent_bucket
from ctrflow.operators.conform import EVENT_TIME, declared, is_valid
from ctrflow.operators.encode import Encoder
from ctrflow.plans.scoring import request_features, score_requests
from ctrflow.schema import spare_names
from ctrflow.sources.feature_table import RECORD, REJECTED, dated, declare_stream, stream_path
from ctrflow.sources.snapshot import refresh_latest

NOW = {"availableNow": True}


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _to_parquet(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, *partition_by: str
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").trigger(**trigger)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).start(path)


def stream_ingest(
    df: DataFrame, path: str, checkpoint: str, event_time: str = EVENT_TIME, trigger: dict = NOW
) -> StreamingQuery:
    """Appends every micro-batch to the offline table, beside its batch loads (see ``stream_path``)."""
    rows = dated(df, event_time)
    declare_stream(df.sparkSession, path, rows.schema)
    return _to_parquet(rows, stream_path(path), checkpoint, trigger, "event_date")


def stream_verified_ingest(
    df: DataFrame, path: str, checkpoint: str, definitions: Mapping[str, str], key: str, event_time: str = EVENT_TIME,
    identity: Sequence[str] | None = None, resent_within: str = "1 day", trigger: dict = NOW,
) -> StreamingQuery:
    """Appends the rows that fit the declared schema to the offline table and keeps the others as rejects, in one pass.

    A row is rejected if key or event time is null, the latter has no date, or a value does not fit its kind; see
    ``read_stream_rejects``. A row that was received before within ``resent_within`` adds nothing; rows are the same if their
    ``identity`` columns are, all of them if not given, nulls included. The watermark follows the time of receipt, so no row is
    late, whatever its event time, and the state holds a digest per row of that span.
    """
    columns = list(identity or df.columns)
    if taken := {REJECTED, RECORD} & {c.lower() for c in df.columns}:
        raise ValueError(f"names of the rejects' columns: {', '.join(sorted(taken))}")
    digest, received = spare_names(df, "_digest", "_received")
    keep_nulls = {"ignoreNullFields": "false"}
    date = F.substring(F.col(event_time).cast("string"), 1, 10).try_cast("date")
    rejected = ~(is_valid(df, definitions, key, event_time) & date.isNotNull())
    marked = df.withColumns({
        REJECTED: rejected,
        RECORD: F.when(rejected, F.to_json(F.struct(*df.columns), keep_nulls)),
        "event_date": date,
        digest: F.sha2(F.to_json(F.struct(*columns), keep_nulls), 256),
        received: F.current_timestamp(),
    })
    once = marked.withWatermark(received, resent_within).dropDuplicatesWithinWatermark([digest])
    time = F.col(event_time).cast("string").alias(event_time)
    features = {c: d for c, d in definitions.items() if c != event_time}
    rows = once.select(*declared(df, features), time, RECORD, "event_date", REJECTED)
    declare_stream(df.sparkSession, path, rows.schema, verified=True)
    return _to_parquet(rows, stream_path(path), checkpoint, trigger, REJECTED, "event_date")


def stream_latest(
    df: DataFrame, path: str, checkpoint: str, key: str, event_time: str = EVENT_TIME,
    then: Sequence[str] = (), trigger: dict = NOW, every_seconds: int = 60,
) -> None:
    """Appends a stream to the table and keeps the table's snapshot of the newest records current until the stream ends.

    Each refresh takes in the files that the sink has committed since the one before, so it costs what is new; a late record
    never replaces a newer one. A failure of the stream is raised after the last refresh.
    """
    query = stream_ingest(df, path, checkpoint, event_time, trigger)
    try:
        while not query.awaitTermination(every_seconds):
            refresh_latest(df.sparkSession, path, key, event_time, then)
    finally:
        refresh_latest(df.sparkSession, path, key, event_time, then)


def stream_request_features(
    requests: DataFrame, encoder: Encoder, customers: DataFrame, path: str, checkpoint: str,
    trigger: dict = NOW,
) -> StreamingQuery:
    """Continuous scoring up to the feature matrix: request stream joined to the customer table."""
    return _to_parquet(request_features(requests, encoder, customers), path, checkpoint, trigger)


def stream_scores(
    requests: DataFrame, encoder: Encoder, customers: DataFrame, model: PipelineModel, path: str,
    checkpoint: str, threshold: float = 0.5, log_percent: int | None = None,
    log_by: Sequence[str] | None = None, seed: int = 42, trigger: dict = NOW, body: str = "body",
) -> StreamingQuery:
    """Continuous scoring: features, probability and label of every request row.

    With ``log_percent`` there is ``logged`` too: true for that share of requests, the same ones in every run, with all their rows, so
    scores and prediction log come from one pass. A request is known by ``log_by``, all its columns but the body if not given.
    """
    scored = score_requests(request_features(requests, encoder, customers, body), model, threshold)
    if log_percent is not None:
        known = list(log_by or [c for c in requests.columns if c != body])
        if not known:
            raise ValueError("requests need a column that tells them apart")
        request = F.concat_ws(":", *known)
        scored = scored.withColumn("logged", percent_bucket(request, seed) < log_percent)
    return _to_parquet(scored, path, checkpoint, trigger)
