"""Cases that used to go wrong outside the fixtures."""

import pytest
from pyspark.sql import functions as F

from ctrflow.operators.customers import attach_features
from ctrflow.operators.encode import Encoder, TargetEncoder, fit_target
from ctrflow.operators.explore import category_ctr
from ctrflow.operators.sample import downsample
from ctrflow.sources import feature_table as ft
from ctrflow.sources import registry
from ctrflow.streaming import jobs
from tests.conftest import table


@pytest.mark.parametrize("rows", [
    [{"is_click": 0}, {"is_click": 0, "product": "B"}, {"is_click": 0}],                      # one class
    [{"session_id": 5, "is_click": 1}, {"session_id": 10, "is_click": 0}],                    # one fold
    [{"session_id": 5, "is_click": 1}, {"session_id": 6, "is_click": 0}, {"session_id": 7}],  # clicks in one fold
])
def test_target_encoder_of_plain_data(rows_of, rows):
    df = rows_of(*rows)
    fitted = fit_target(df, ["product"])
    assert fitted.transform_train(df).where("product_encoding IS NULL").isEmpty()
    assert fitted.transform(df).where("product_encoding IS NULL").isEmpty()


def test_target_encoder_is_the_same_after_loading(spark, clean, rows_of, tmp_path):
    fitted = fit_target(clean, ["product"])
    fitted.save(str(tmp_path / "t"))
    loaded = TargetEncoder.load(spark, str(tmp_path / "t"))
    unseen = rows_of({"product": "nobody knows it"})
    for frame in (unseen, clean.limit(50)):
        a, b = (table(e.transform(frame).select("session_id", "product_encoding"), "session_id") for e in (fitted, loaded))
        assert a == b
    a, b = (table(e.transform_train(clean).select("session_id", "product_encoding"), "session_id") for e in (fitted, loaded))
    assert a == b
    assert Encoder.load(spark, str(tmp_path / "t/full")).columns() == ["product"]


def test_click_rate_without_sessions_is_null(rows_of):
    df = rows_of({}).withColumn("session_id", F.lit(None).cast("int"))
    assert category_ctr(df, "product").select("ctr").first()[0] is None


def test_repeated_feature_record_is_taken_whole(spark):
    features = spark.createDataFrame([(1, "A", 9), (1, "B", 2)], "k int, x string, y int")
    assert table(attach_features(spark.createDataFrame([(1,)], "k int"), features, ["k"])) == [(1, "B", 2)]


def test_null_key_of_class_0_stops_the_downsampling(rows_of):
    df = rows_of(*[{"is_click": int(i < 2)} for i in range(8)])
    df = df.withColumn("session_id", F.when(F.col("session_id") > 3, F.col("session_id")))
    with pytest.raises(ValueError, match="null"):
        downsample(df)


def test_batch_and_stream_loads_lie_side_by_side(spark, tmp_path):
    path, source = str(tmp_path / "t"), str(tmp_path / "source")
    rows = lambda *ids: spark.createDataFrame([(i, "2024-01-01T00:00:00Z") for i in ids], "id int, event_time string")
    ft.append_features(rows(1, 2), path)
    rows(3).write.parquet(source)
    jobs.stream_ingest(jobs.read_stream(spark, source, rows(3).schema), path, str(tmp_path / "c")).awaitTermination()
    assert table(ft.read_features(spark, path).select("id"), "id") == [(1,), (2,), (3,)]
    ft.append_features(rows(4).withColumn("more", F.lit(7)), path)
    assert table(ft.read_features(spark, path).select("id", "more"), "id") == [(1, None), (2, None), (3, None), (4, 7)]


def test_withdrawn_version_is_not_approved(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([("g", 1, "p1", "Approved", 0.5), ("g", 2, "p2", "Approved", 0.6)],
                                 "model_group string, version int, model_path string, status string, f1 double")
    registry.register_models(rows.withColumn("created", F.lit("2024-01-01").cast("timestamp_ntz")), path)
    assert registry.approved_path(registry.read_registry(spark, path), "g") == "p2"
    registry.set_status(registry.read_registry(spark, path), path, "g", 2, "Rejected", F.lit("2024-02-01"))
    assert registry.approved_path(registry.read_registry(spark, path), "g") == "p1"


def test_equal_times_always_settle_the_same_way(spark):
    df = spark.createDataFrame([(1, "t", i) for i in range(20)], "k int, event_time string, v int")
    a, b = (table(ft.latest_per_key(df.repartition(n), "k")) for n in (1, 7))
    assert a == b
    assert ft.get_record(df, "k", 1, then=["v"]).first()["v"] == 19
