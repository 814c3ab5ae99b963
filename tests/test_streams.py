import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from ctrflow.operators import encode, model
from ctrflow.operators.customers import customer_profile
from ctrflow.plans import scoring
from ctrflow import schema
from ctrflow.sources import feature_table as ft, snapshot
from ctrflow.sources.prediction_log import sample_log
from ctrflow.streaming import jobs
from tests.conftest import same, skewed


def by_day(df, path, newest_first):
    """One file per stretch of days, written in time order or in reverse."""
    days = sorted(r[0] for r in df.select(F.to_date("DateTime").alias("d")).distinct().collect())
    stretches = [days[i::4] if newest_first else days[i * 8:(i + 1) * 8] for i in range(4)]
    for part in reversed(stretches) if newest_first else stretches:
        df.where(F.to_date("DateTime").isin(part)).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def records(clean):
    return fx.events_with_time(skewed(clean)).select("DateTime", "session_id", "user_id", "product", "age_level", "event_time")


@pytest.mark.parametrize("newest_first", [False, True])
def test_latest_equals_the_batch_view_in_any_order(spark, records, tmp_path, newest_first):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    by_day(records, source, newest_first)
    stream = jobs.read_stream(spark, source, records.schema, 1)
    jobs.stream_latest(stream, out, str(tmp_path / "cp"), "user_id", then=["session_id"], every_seconds=1)
    want = ft.latest_per_key(records, "user_id", then=["session_id"])
    assert same(snapshot.read_latest(spark, out, "user_id").drop("event_date"), want)


def test_latest_goes_on_from_its_checkpoint_and_ignores_late_records(spark, records, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    late, early = records.where("DateTime >= '2024-01-15'"), records.where("DateTime < '2024-01-15'")
    for part in (late, early, late.limit(1)):
        part.write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, records.schema)
        jobs.stream_latest(stream, out, checkpoint, "user_id", then=["session_id"])
    changes = snapshot.read_latest(spark, out, "user_id").drop("event_date")
    known = late.select("user_id").distinct()
    # Early records changed nothing for users already seen with a later one.
    assert changes.join(known, "user_id", "left_semi").where("DateTime < '2024-01-15'").isEmpty()
    assert same(changes, ft.latest_per_key(records, "user_id", then=["session_id"]))


def test_latest_keeps_nulls(spark, tmp_path):
    schema_ = "user_id long, event_time string, code int, note string"
    rows = spark.createDataFrame([(1, "2024-01-01", 5, "a"), (1, "2024-01-02", None, None), (None, "2024-01-03", 1, "x")], schema_)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.parquet(source)
    jobs.stream_latest(jobs.read_stream(spark, source, rows.schema), out, str(tmp_path / "cp"), "user_id")
    latest = snapshot.read_latest(spark, out, "user_id").drop("event_date")
    assert [tuple(r) for r in latest.collect()] == [(1, "2024-01-02", None, None)]


def test_large_numbers_beside_nulls_survive(spark, tmp_path):
    big = 2**53 + 1
    rows = spark.createDataFrame([(big, "2024-01-01", big, None), (2, "2024-01-01", None, 1.5)], "user_id long, event_time string, code long, x double")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.coalesce(1).write.parquet(source)
    jobs.stream_latest(jobs.read_stream(spark, source, rows.schema), out, str(tmp_path / "cp"), "user_id")
    assert same(snapshot.read_latest(spark, out, "user_id").drop("event_date"), rows)
    assert snapshot.get_latest(spark, out, "user_id", big).first()["code"] == big


def test_ingest_appends_every_row_once(spark, records, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (records.where("DateTime < '2024-01-15'"), records.where("DateTime >= '2024-01-15'")):
        part.coalesce(2).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, records.schema, 1)
        jobs.stream_ingest(stream, out, checkpoint).awaitTermination()
    assert same(ft.read_features(spark, out).drop("event_date"), records)


def test_streamed_request_features_equal_the_batch_form(spark, clean, tmp_path):
    small = "/root/testdata/sf0.001"
    batches = fx.request_batches(spark, small)
    encoder = encode.fit_label(clean, schema.ENCODED)
    coded = encoder.transform(clean).withColumn("gender_encoding", F.lit(0)).withColumns({
        f"{c}_encoding": F.lit(3) for c in schema.ENGINEERED.values()})
    customers = customer_profile(coded)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches.repartition(3).write.parquet(source)
    stream = jobs.read_stream(spark, source, batches.schema, 1)
    jobs.stream_request_features(stream, encoder, customers, out, str(tmp_path / "cp")).awaitTermination()
    features = scoring.request_features(batches, encoder, customers)
    assert same(spark.read.parquet(out), features)

    fitted = model.fit_logistic(schema.project(coded, schema.FEATURES_ENGINEERED))
    scored = scoring.score_requests(features, fitted, 0.2)
    for percent in (None, 50):
        stream = jobs.read_stream(spark, source, batches.schema, 2)
        out = str(tmp_path / f"scores-{percent}")
        jobs.stream_scores(stream, encoder, customers, fitted, out, f"{out}-cp", 0.2, percent).awaitTermination()
        got = spark.read.parquet(out)
        if percent:
            # whole requests are logged, and every row is scored
            assert {r.logged for r in got.select("logged").distinct().collect()} == {True, False}
            assert got.groupBy("batch_id").agg(F.count_distinct("logged").alias("n")).where("n > 1").isEmpty()
            assert same(got.where("logged").drop("logged"), sample_log(scored, percent, key="batch_id"))
        assert same(got.drop("logged"), scored)


KINDS = {"user_id": "Integral", "code": "Integral", "note": "String"}


def verified(spark, source, out, checkpoint, **options):
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 1)
    jobs.stream_verified_ingest(stream, out, checkpoint, KINDS, "user_id", **options).awaitTermination()


def test_verified_ingest_keeps_rejects_and_takes_resent_files_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = spark.createDataFrame([
        ("1", "2024-01-01T00:00:00Z", "5", "a", None), ("1", "2023-01-01T00:00:00Z", None, None, 1), ("2", "2024-01-02", "x", "b", 1),
        (None, "2024-01-02", "1", "c", 1), ("3", None, "1", "d", 1), ("4", "soon", "1", "e", 1),
    ], "user_id string, event_time string, code string, note string, _digest int")
    for _ in range(2):  # the second file is the first one again, in a run of its own
        rows.coalesce(1).write.mode("append").parquet(source)
        verified(spark, source, out, checkpoint)
    rows.limit(1).withColumn("code", F.lit("6")).coalesce(1).write.mode("append").parquet(source)
    verified(spark, source, out, checkpoint)
    got = {tuple(r) for r in ft.read_features(spark, out).select("user_id", "event_time", "code", "note").collect()}
    assert got == {(1, "2024-01-01T00:00:00Z", 5, "a"), (1, "2023-01-01T00:00:00Z", None, None), (1, "2024-01-01T00:00:00Z", 6, "a")}
    assert ft.read_features(spark, out).count() == 3
    rejects = ft.read_stream_rejects(spark, out).select(F.get_json_object(ft.RECORD, "$.note").alias("n"), "event_date").collect()
    assert sorted(r.n for r in rejects) == ["b", "c", "d", "e"]
    assert all((r.event_date is None) == (r.n in "de") for r in rejects)
    snapshot.refresh_latest(spark, out, "user_id")
    assert {r.user_id for r in snapshot.read_latest(spark, out, "user_id").collect()} == {1}


def test_verified_and_plain_streams_do_not_mix(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("1", "2024-01-01", "5", "a")], "user_id string, event_time string, code string, note string")
    rows.write.parquet(source)
    jobs.stream_ingest(jobs.read_stream(spark, source, rows.schema), out, str(tmp_path / "a")).awaitTermination()
    assert ft.read_stream_rejects(spark, out).isEmpty()
    with pytest.raises(ValueError, match="verified"):
        verified(spark, source, out, str(tmp_path / "b"))
