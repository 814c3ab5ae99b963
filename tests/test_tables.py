import json
import os

import pytest
from pyspark.sql import functions as F

from ctrflow import schema
from ctrflow.operators import conform, customers
from ctrflow.operators.rolling import rolling_top
from ctrflow.session import scratch_path, small_or_staged, stage
from ctrflow.sources import commits, feature_table as ft, files, prediction_log, registry, snapshot
from tests.conftest import executed, same, skewed, table

LOAD = "2024-02-01T00:00:00.000Z"


def test_csv_round_trip(spark, raw, tmp_path):
    files.write_csv(raw, str(tmp_path / "c"))
    assert same(files.read_csv(spark, str(tmp_path / "c")), raw)


def test_matrix_is_headerless_with_the_target_first(spark, rows_of, tmp_path):
    path = str(tmp_path / "m")
    files.write_matrix(rows_of({"is_click": 1, "webpage_id": 7}).select("webpage_id", "is_click").coalesce(1), path)
    (name,) = [n for n in os.listdir(path) if n.endswith(".csv")]
    assert open(f"{path}/{name}").read() == "1,7\n"
    assert table(files.read_matrix(spark, path, ["webpage_id"])) == [(1, 7)]


def test_report_layout(spark, tmp_path):
    path = str(tmp_path / "r")
    files.write_report(files.as_report(spark.createDataFrame([(0.25,)], "f1_score double").coalesce(1)), path)
    (name,) = [n for n in os.listdir(path) if n.endswith(".json")]
    text = open(f"{path}/{name}").read()
    assert json.loads(text) == {"classification_metrics": {"f1_score": {"value": 0.25}}}
    df = spark.createDataFrame([(text,), ("{}",), (None,)], "j string")
    assert [r[0] for r in df.select(files.json_metric(F.col("j"))).collect()] == [0.25, None, None]
    assert files.read_report(spark, path).first().classification_metrics.f1_score.value == 0.25


def test_conform_casts_and_stores_unknown_kinds_as_text(rows_of):
    df = rows_of({"product": "12", "age_level": 2.0})
    out = conform.conform(df, {"product": "Integral", "age_level": "String", "is_click": "Odd", "webpage_id": "Fractional", "event_time": "String"}, LOAD)
    assert out.dtypes == [("product", "bigint"), ("age_level", "string"), ("is_click", "string"), ("webpage_id", "double"), ("event_time", "string")]
    assert table(out) == [(12, "2.0", "0", 1.0, LOAD)]
    with pytest.raises(ValueError, match="nope"):
        conform.conform(df, {"nope": "String"}, LOAD)


def test_definitions(raw):
    kinds = schema.infer_definitions(raw)
    assert kinds["session_id"] == kinds["is_click"] == "Integral"
    assert kinds["age_level"] == "Fractional" and kinds["product"] == kinds["DateTime"] == "String"
    assert schema.columns_of(raw, "String") == ["product", "gender"]


def test_ingest_stores_good_rows_and_rejects_the_others(spark, tmp_path):
    df = spark.createDataFrame([("1", "5"), ("2", "x"), (None, "7"), ("4", None)], "session_id string, v string")
    definitions = {"session_id": "Integral", "v": "Integral"}
    path, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    with pytest.raises(ft.RejectedRows, match="2 rows"):
        ft.ingest(df, path, definitions, "session_id", LOAD, bad)
    assert table(ft.read_features(spark, path).select("session_id", "v"), "session_id") == [(1, 5), (4, None)]
    assert spark.read.parquet(bad).count() == 2
    assert ft.ingest(df.where("v = '5'"), path, definitions, "session_id", LOAD) == 0
    assert ft.ingest(df, path, definitions, "session_id", LOAD, fail=False) == 2


def test_a_load_given_again_replaces_its_rows_and_rejects(spark, tmp_path):
    df = spark.createDataFrame([("1", "5"), ("2", "x"), ("4", None)], "session_id string, v string")
    definitions = {"session_id": "Integral", "v": "Integral"}
    path, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    for _ in range(2):
        with pytest.raises(ft.RejectedRows):
            ft.ingest(df, path, definitions, "session_id", LOAD, bad)
    assert ft.read_features(spark, path).count() == 2 and ft.read_features(spark, bad).count() == 1
    mended = df.replace("x", "7")
    assert ft.ingest(mended, path, definitions, "session_id", LOAD, bad) == 0
    assert table(ft.read_features(spark, path).select("session_id", "v"), "session_id") == [(1, 5), (2, 7), (4, None)]
    assert ft.read_features(spark, bad).isEmpty()
    later = LOAD.replace("02-01", "02-02")
    assert ft.ingest(mended, path, definitions, "session_id", later, load_id="a/b c=d") == 0
    assert ft.read_features(spark, path).count() == 6 and ft.read_features(spark, path, since="2024-02-02").count() == 3
    ft.remove_load(spark, path, "a/b c=d")
    assert ft.read_features(spark, path).count() == 3
    with pytest.raises(KeyError):
        ft.remove_load(spark, path, "a/b c=d")


def test_a_load_that_fails_halfway_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, LOAD)], "k int, event_time string")
    ft.append_features(rows, path)
    with pytest.raises(Exception):
        ft.append_features(rows.withColumn("k", F.raise_error(F.lit("lost")).cast("int")), path)
    ft.dated(rows).write.partitionBy("event_date").parquet(f"{path}/_load=x/_attempt=y")  # written, never named
    assert ft.read_features(spark, path).count() == 1


def test_readers_take_the_schema_from_the_state(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.append_features(spark.createDataFrame([(1, LOAD)], "k int, event_time string"), path)
    ft.append_features(spark.createDataFrame([(2, LOAD, "n")], "k int, event_time string, note string"), path)
    df = ft.read_features(spark, path)
    assert df.columns == ["k", "event_time", "note", "event_date"]
    assert table(df.select("k", "note"), "k") == [(1, None), (2, "n")]
    ft.append_features(spark.createDataFrame([("3", LOAD)], "k string, event_time string"), path)
    with pytest.raises(ValueError, match="k is integer"):
        ft.read_features(spark, path)


def test_numbers_of_states_are_claimed_once(spark, tmp_path):
    log = commits.Commits(spark, str(tmp_path / "c"))
    assert log.last() == (0, None) and log.claim(1, {"a": 1}) and not log.claim(1, {"a": 2})
    assert log.last() == (1, {"a": 1})
    assert log.update(lambda s: s | {"b": 2}) == 2 and log.last() == (2, {"a": 1, "b": 2})


def test_snapshot_follows_the_loads(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    day = lambda d: f"2024-02-{d:02d}T00:00:00.000Z"
    rows = lambda ids, d, v: spark.createDataFrame([(i, day(d), v) for i in ids], "k long, event_time string, v string")
    with pytest.raises(FileNotFoundError):
        snapshot.refresh_latest(spark, path, "k")
    ft.append_features(rows(range(40), 1, "a"), path)
    ft.append_features(rows([None], 9, "nobody"), path)
    with pytest.raises(FileNotFoundError):
        snapshot.read_latest(spark, path, "k")
    assert snapshot.refresh_latest(spark, path, "k") == 1
    ft.append_features(rows([3, 5, 99], 3, "b"), path)
    ft.append_features(rows([3, 4], 2, "late"), path, load_id="late")
    read = []
    plain = snapshot.read_loads
    monkeypatch.setattr(snapshot, "read_loads", lambda s, p, folders, f: read.extend(folders) or plain(s, p, folders, f))
    assert snapshot.refresh_latest(spark, path, "k") == 2 and len(read) == 2  # what was there before is not read again
    assert snapshot.refresh_latest(spark, path, "k") == 2 and len(read) == 2
    same_as_all = lambda: same(snapshot.read_latest(spark, path, "k"), ft.latest_per_key(ft.read_features(spark, path).where("k IS NOT NULL"), "k"))
    assert same_as_all()
    for k, v in ((3, "b"), (4, "late"), (7, "a"), (99, "b")):
        assert snapshot.get_latest(spark, path, "k", k).first()["v"] == v
    assert snapshot.get_latest(spark, path, "k", 1000).isEmpty() and snapshot.get_latest(spark, path, "k", None).isEmpty()
    plan = executed(snapshot.get_latest(spark, path, "k", 3))
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan
    ft.append_features(rows(range(30), 5, "c"), path)  # as many as half of the first generation: merged
    assert snapshot.refresh_latest(spark, path, "k") == 1 and same_as_all()
    assert "Exchange" not in executed(snapshot.read_latest(spark, path, "k"))
    ft.append_features(rows([4], 1, "mended"), path, load_id="late")
    assert snapshot.refresh_latest(spark, path, "k") == 1 and same_as_all()
    assert snapshot.drop_old_generations(spark, path, "k") == 4 and same_as_all()
    with pytest.raises(ValueError, match="ordered"):
        snapshot.refresh_latest(spark, path, "k", then=["v"])


def test_newest_equals_the_ranked_form_on_ties_and_nulls(spark):
    rows = [(1, None, "x"), (1, "2024", "a"), (1, "2024", "b"), (2, None, None), (None, "1", "n"), (2, None, "q")]
    df = spark.createDataFrame(rows, "k int, event_time string, v string")
    for then in ([], ["v"]):
        assert same(snapshot.newest(df, "k", then=then), ft.latest_per_key(df, "k", then=then))
    hidden = df.withColumn("_rank", F.lit(1))
    assert ft.latest_per_key(hidden, "k").columns == hidden.columns


def test_date_range_prunes_partitions(spark, rows_of, tmp_path):
    path = str(tmp_path / "t")
    df = rows_of({}).select("user_id")
    for day in ("2024-02-01", "2024-02-02", "2024-02-03"):
        ft.append_features(df.withColumn("event_time", F.lit(f"{day}T10:00:00.000Z")), path)
    assert ft.read_features(spark, path).count() == 3
    some = ft.read_features(spark, path, since="2024-02-02", until="2024-02-02")
    assert [str(r.event_date) for r in some.collect()] == ["2024-02-02"]
    assert "PartitionFilters: [isnotnull(event_date" in executed(some)


def test_latest_per_key_and_lookup(spark):
    rows = [(1, "a", "2024-01-01", 3), (1, "b", "2024-01-02", 4), (2, "c", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "user_id long, note string, event_time string, code int")
    latest = ft.latest_per_key(df, "user_id")
    assert table(latest.select("user_id", "note"), "user_id") == [(1, "b"), (2, "c")]
    assert table(ft.get_record(df, "user_id", 1).select("note")) == [("b",)]
    assert ft.get_record(df, "user_id", 9).isEmpty()
    asked = spark.createDataFrame([(1,), (2,), (3,), (None,)], "user_id long")
    assert table(ft.lookup_default(asked, latest, "user_id", "code"), "user_id") == [(None, -1.0), (1, 4.0), (2, -1.0), (3, -1.0)]


def test_latest_thins_out_each_partition_before_the_shuffle(clean):
    text = executed(ft.latest_per_key(skewed(clean), "user_id", "DateTime", ["session_id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_profile_takes_first_known_and_largest(rows_of):
    df = rows_of(
        {"DateTime": 1, "webpage_id": 9, "product_category_1": 5}, {"DateTime": 0, "webpage_id": None, "product_category_1": 6},
        {"DateTime": 2, "webpage_id": 8, "product_category_1": 4}, {"user_id": 2, "webpage_id": None},
    )
    out = customers.customer_profile(df, first=["webpage_id"], largest=["product_category_1"])
    assert table(out, "user_id") == [(1, 9, 6), (2, None, 1)]


def test_attached_features_do_not_multiply_rows(rows_of, clean):
    df = rows_of({}, {"session_id": 2})
    features = rows_of({}, {"session_id": 1}, {"session_id": 3}).select("user_id", "session_id", F.lit("x").alias("f"))
    assert table(customers.attach_features(df.select("user_id", "session_id"), features), "session_id") == [(1, 1, "x"), (1, 2, None)]
    name = {"product": "top"}
    whole = rolling_top(clean, name)
    assert same(customers.attach_features(clean, whole.select("user_id", "session_id", "top")), whole)


def test_gate_in_both_directions(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "f1 double")
    assert table(registry.quality_gate(df), "f1") == [(0.2,), (0.3,)]
    assert table(registry.quality_gate(df, comparison="<="), "f1") == [(0.1,), (0.2,)]


def test_latest_approved_version(spark, tmp_path):
    path = str(tmp_path / "reg")
    rows = [
        ("g", 1, "m/1", "Approved", "2024-01-01", 0.3), ("g", 2, "m/2", "Approved", "2024-01-02", 0.4),
        ("g", 3, "m/3", "PendingManualApproval", "2024-01-03", 0.5), ("h", 1, "h/1", "Rejected", "2024-01-01", 0.1),
    ]
    df = spark.createDataFrame(rows, "model_group string, version int, model_path string, status string, t string, f1 double")
    registry.register_models(df.withColumn("created", F.col("t").cast("timestamp_ntz")), path)
    table_ = registry.read_registry(spark, path)
    assert registry.approved_path(table_, "g") == "m/2"
    assert table(registry.latest_approved(table_).select("model_group", "version")) == [("g", 2)]
    with pytest.raises(registry.NoApprovedModel, match="h"):
        registry.approved_path(table_, "h")
    registry.register_models(table_.where("model_group = 'h'").drop("status").limit(1), path)
    assert registry.read_registry(spark, path).where("status = 'PendingManualApproval'").count() == 2


def test_log_sample_is_about_the_asked_share_and_repeatable(clean):
    out = prediction_log.sample_log(clean)
    assert 0.7 < out.count() / clean.count() < 0.9
    assert same(out, prediction_log.sample_log(clean.repartition(5)))
    assert prediction_log.sample_log(clean, 100).count() == clean.count()
    assert prediction_log.sample_log(clean, 0).isEmpty()


def test_staging_uses_the_shared_folder(spark, clean):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")
    staged = stage(clean.select("user_id", "product"))
    assert same(staged, clean.select("user_id", "product"))
    assert "ReadSchema: struct<user_id:bigint>" in executed(staged.select("user_id"))
    assert small_or_staged(clean, "t", 10**6).isLocal() and not small_or_staged(clean, "t", 5).isLocal()


def test_a_cluster_has_to_name_its_shared_folder():
    from types import SimpleNamespace as Fake

    cluster = Fake(conf=Fake(get=lambda *_: None), sparkContext=Fake(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")


def test_checking_a_typed_frame_looks_at_the_key_only(spark, clean, tmp_path):
    clean.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("event_time", F.lit(LOAD))
    _, bad = conform.split_valid(df, schema.infer_definitions(df), "session_id")
    text = executed(bad.groupBy().count())
    assert "PushedFilters: [IsNull(session_id)]" in text and "ReadSchema: struct<session_id:bigint>" in text
