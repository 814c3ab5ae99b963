import json
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks import analysis, fixtures as fx
from ctrflow import schema
from ctrflow.operators import encode, model
from ctrflow.operators.customers import customer_profile
from ctrflow.plans import jobs, scoring
from ctrflow.sources import feature_table as ft, registry
from ctrflow.sources.requests import parse_requests
from tests.conftest import SMALL, executed, same, table

SMALL_MODEL = lambda df: model.fit_boosted(df, rounds=2, max_depth=3)


@pytest.fixture(scope="module")
def prepared(raw):
    return jobs.preprocess(raw, fx.CUTS, engineered=True)


def test_preprocess_writes_three_files(spark, raw, tmp_path):
    out = str(tmp_path / "p")
    prepared = jobs.preprocess_to_files(raw, out, fx.CUTS)
    counts = {}
    for name in ("train", "validation", "test"):
        df = spark.read.csv(f"{out}/{name}")
        counts[name] = df.count()
        assert len(df.columns) == len(schema.FEATURES)
    clicks = prepared.train.where("is_click = 1").count()
    assert counts == {"train": 2 * clicks, "validation": prepared.validation.count(), "test": prepared.test.count()}


def test_split_of_encoded_rows_reaches_the_staged_table(prepared):
    text = executed(prepared.validation)
    assert "GreaterThanOrEqual(DateTime,2024-01-21T00:00), LessThan(DateTime,2024-01-26T00:00)" in text
    assert "hashpartitioning" not in text


def test_options_are_checked(raw):
    with pytest.raises(ValueError, match="encoding"):
        jobs.preprocess(raw, fx.CUTS, encoding="one-hot")
    with pytest.raises(ValueError, match="fit_on"):
        jobs.prepare(raw, fit_on="test")


def test_fill_values_can_come_from_the_training_rows(rows_of):
    df = rows_of({"DateTime": 0, "age_level": 1.0}, {"DateTime": 9, "age_level": 5.0}, {"DateTime": 9, "age_level": 6.0}, {"DateTime": 9, "age_level": None, "gender": "Female"})
    cuts = ("2024-01-01 00:05:00", "2024-01-01 00:08:00")
    assert jobs.prepare(df, cuts).where("gender = 'Female'").first().age_level == 5.0
    assert jobs.prepare(df, cuts, fit_on="train").where("gender = 'Female'").first().age_level == 1.0


def test_target_encoding_has_no_fixed_gender_code(raw):
    train, validation, _ = jobs.preprocess(raw, fx.CUTS, encoding="target")
    assert dict(train.dtypes)["gender_encoding"] == dict(validation.dtypes)["gender_encoding"] == "double"


def test_ingest_keeps_the_codes_of_a_saved_encoder(spark, raw, tmp_path):
    encoder = encode.fit_label(fx.clean(spark, "/root/testdata/sf0.001"), schema.ENCODED)
    shifted = encode.Encoder(encoder.mapping.withColumn("code", F.col("code") + 100))
    used = jobs.ingest_features(raw, str(tmp_path / "t"), str(tmp_path / "c"), fx.LOAD_1, shifted)
    assert used is shifted
    customers = ft.read_features(spark, str(tmp_path / "c"))
    assert customers.where("most_recent_clicked_product_encoding < 100 OR age_level_encoding < 100").isEmpty()
    assert customers.count() == raw.select("user_id").na.drop().distinct().count()
    assert ft.read_features(spark, str(tmp_path / "t")).where("product_encoding < 100").isEmpty()


def test_feature_store_frames_hold_training_rows_and_text_ids(raw):
    rows, customers = jobs.feature_store_frames(raw, fx.LOAD_1, fx.CUTS)
    types = dict(rows.dtypes)
    assert all(types[c] == "string" for c in ("user_id", "session_id", "event_time", "DateTime"))
    assert rows.where("DateTime >= '2024-01-21'").isEmpty()
    assert customers.columns[-1] == "event_time"


@pytest.mark.parametrize("comparison, registered", [(">=", 0), ("<=", 1)])
def test_gate_decides_about_registration(spark, raw, tmp_path, comparison, registered):
    out = str(tmp_path / "m")
    report = jobs.train_evaluate(raw, out, fx.CUTS, fit=SMALL_MODEL, comparison=comparison, threshold=2.0)
    assert 0 <= report.first().f1_score <= 1
    assert registry.read_registry(spark, f"{out}/registry").count() == registered
    names = [n for n in os.listdir(f"{out}/reports/ctr/1") if n.endswith(".json")]
    text = "".join(open(f"{out}/reports/ctr/1/{n}").read() for n in names)
    assert json.loads(text)["classification_metrics"]["f1_score"]["value"] == pytest.approx(report.first().f1_score)
    assert os.path.isdir(f"{out}/models/ctr/1")


def test_approved_model_can_be_loaded_and_scores(spark, raw, tmp_path, prepared):
    out = str(tmp_path / "m")
    jobs.train_evaluate(raw, out, fx.CUTS, fit=SMALL_MODEL, threshold=-1.0, status=registry.APPROVED)
    jobs.train_evaluate(raw, out, fx.CUTS, fit=SMALL_MODEL, threshold=-1.0, version=2, created="2024-02-01 00:00:00")
    loaded = jobs.approved_model(spark, out)
    scored = model.score(loaded, schema.project(prepared.test, schema.FEATURES))
    assert scored.count() == prepared.test.count() and scored.where("probability IS NULL").isEmpty()
    with pytest.raises(registry.NoApprovedModel):
        jobs.approved_model(spark, out, "other")


def test_versions_are_given_and_nothing_is_overwritten(spark, raw, tmp_path):
    out = str(tmp_path / "m")
    for _ in range(2):
        jobs.train_evaluate(raw, out, fx.CUTS, fit=model.fit_logistic, threshold=0.0)
    rows = registry.read_registry(spark, f"{out}/registry")
    assert sorted(r.version for r in rows.collect()) == [1, 2]
    with pytest.raises(registry.VersionTaken):
        jobs.train_evaluate(raw, out, fx.CUTS, fit=model.fit_logistic, threshold=0.0, version=2)
    assert registry.claim_version(spark, f"{out}/registry", "a/b") == 1 and registry.claim_version(spark, f"{out}/registry", "ctr") == 3
    with pytest.raises(registry.UnknownVersion):
        registry.set_status(rows, f"{out}/registry", "ctr", 12, registry.REJECTED, F.lit("2024-03-01"))
    with pytest.raises(registry.NoApprovedModel):
        jobs.approved_model(spark, out)


def test_requests_are_scored_from_disk_alone(spark, raw, clean, tmp_path):
    out = str(tmp_path / "m")
    jobs.train_evaluate(raw, out, fx.CUTS, fit=model.fit_logistic, threshold=0.0, status=registry.APPROVED, engineered=True)
    customers = spark.createDataFrame([(1, 3)], "user_id long, most_recent_clicked_product_encoding int")
    requests = fx.request_batches(spark, SMALL)
    loaded = jobs.approved_model(spark, out)
    scored = jobs.score_approved(requests, customers, out, threshold=0.2)
    prepared = jobs.preprocess(raw, fx.CUTS, engineered=True)
    features = scoring.request_features(requests, prepared.encoder, customers)
    plain = PipelineModel(stages=loaded.stages[1:])
    assert same(scored, scoring.score_requests(features, plain, 0.2))
    assert not scored.where("probability IS NOT NULL").isEmpty() and not scored.where("probability IS NULL").isEmpty()
    # The whole model takes raw rows, and rows that have their codes.
    rows = prepared.test.select("session_id", *schema.ENCODED, "gender", F.lit(2).alias("most_recent_clicked_product_encoding"))
    coded = prepared.test.select("session_id", *schema.FEATURES_ENGINEERED).withColumn("most_recent_clicked_product_encoding", F.lit(2))
    columns = ["session_id", F.round("probability", 9).alias("p")]
    assert same(model.score(loaded, rows).select(*columns), model.score(plain, coded).select(*columns))


def test_new_labels_get_the_next_codes(spark, rows_of):
    old = rows_of(*[{"product": p, "campaign_id": c} for p, c in (("B", 100), ("D", 9))])
    new = rows_of(*[{"product": p, "campaign_id": c} for p, c in (("A", 20), ("D", 100), ("C", 3), (None, 9))])
    first = encode.fit_label(old, ["product", "campaign_id"])
    codes = lambda e: {(r.column, r.label): r.code for r in e.mapping.collect()}
    want = {("product", "B"): 0, ("product", "D"): 1, ("campaign_id", "9"): 0, ("campaign_id", "100"): 1}
    assert codes(first) == want
    more = want | {("product", "A"): 2, ("product", "C"): 3, ("campaign_id", "3"): 2, ("campaign_id", "20"): 3}
    assert codes(first.extended(new)) == more and codes(first.extended(old)) == want
    assert codes(first.extended(new, max_labels=1)) == more
    assert codes(first.extended(new).extended(new)) == more


def test_rows_with_unseen_labels_raise_or_are_put_aside(spark, raw, tmp_path):
    known = encode.fit_label(jobs.prepare(raw).where("product <> 'C'"), schema.ENCODED)
    t, c = str(tmp_path / "t"), str(tmp_path / "c")
    with pytest.raises(Exception, match="unseen label"):
        jobs.ingest_features(raw, t, c, "2024-02-01T00:00:00.000Z", known)
    with pytest.raises(ValueError, match="on_unseen"):
        jobs.ingest_features(raw, t, c, "2024-02-01T00:00:00.000Z", known, on_unseen="ignore")
    for _ in range(2):
        jobs.ingest_features(raw, t, c, "2024-02-01T00:00:00.000Z", known, on_unseen="reject")
    kept, aside = ft.read_features(spark, t), ft.read_features(spark, f"{t}_unseen")
    all_ = jobs.prepare(raw)
    assert kept.where("product = 'C' OR most_recent_clicked_product = 'C'").isEmpty() and not aside.where("product = 'C'").isEmpty()
    assert kept.count() + aside.count() == all_.count()


def body(*rows):
    return json.dumps({"data": rows})


def test_requests_are_parsed_by_position(spark):
    df = spark.createDataFrame([
        (1, body([421860, "Male", 3, "C", 405490, 2.0, 60305, 14], [7, "FEMALE", None, "Z", "x", 1, 5])),
        (2, body()), (3, "no json"),
    ], "batch_id int, body string")
    assert table(parse_requests(df), "batch_id", "position") == [
        (1, 0, 421860, "Male", 3, "C", 405490, 2.0, 60305, 14),
        (1, 1, 7, "FEMALE", None, "Z", None, 1.0, 5, None),
    ]


def test_request_features_row_by_row(spark, rows_of):
    rows = rows_of({"product": "A", "age_level": 1.0}, {"product": "B", "age_level": 2.0}).withColumn("time_of_day", F.lit("afternoon"))
    encoder = encode.fit_label(rows, schema.ENCODED)
    customers = spark.createDataFrame([(7, 1), (8, None)], "user_id long, most_recent_clicked_product_encoding int")
    df = spark.createDataFrame([
        (body([7, "MALE", 1, "B", 1, 2.0, 1, 14], [8, "female", 1, "Z", 1, 1.0, 1, 0], [9, "x", 1, "A", 1, 1.0, 1, 17]),)
    ], "body string")
    out = scoring.request_features(df, encoder, customers)
    assert out.columns == ["position", "user_id", *scoring.MATRIX]
    got = table(out.select("user_id", "gender_encoding", "product_encoding", "time_of_day_encoding", scoring.RECENT), "user_id")
    assert got == [(7, 1, 1, 0, 1.0), (8, 0, None, None, -1.0), (9, None, 0, 0, -1.0)]


def test_scored_requests_have_a_label(spark, prepared):
    fitted = model.fit_logistic(schema.project(prepared.train, schema.FEATURES_ENGINEERED))
    features = scoring.request_features(
        fx.request_batches(spark, "/root/testdata/sf0.001"), prepared.encoder, customer_profile(prepared.train))
    out = scoring.score_requests(features, fitted, threshold=0.2).cache()
    known = F.lit(True)
    for c in scoring.MATRIX:
        known = known & F.col(c).isNotNull()
    # Every request row is answered; the ones with an unknown code have no score.
    assert same(out.select(features.columns), features)
    assert 0 < out.where(~known).count() == out.where("probability IS NULL AND prediction IS NULL AND label IS NULL").count()
    labels = {tuple(r) for r in out.where(known).select("prediction", "label").distinct().collect()}
    assert labels <= {(1, "Clicked"), (0, "Not Clicked")}
    assert out.where("(probability > 0.2) <> (prediction = 1)").isEmpty()


def test_matrix_does_not_depend_on_partitioning(raw):
    a, b = (jobs.matrices(jobs.preprocess(raw.repartition(n), fx.CUTS))[0] for n in (1, 9))
    assert same(a, b)


def test_jobs_over_one_log_share_its_clean_and_rolling_rows(spark, monkeypatch):
    called = []
    for place, name in ((jobs, "clean_rows"), (jobs, "rolling_top"), (fx, "clean_rows")):
        step = getattr(place, name)
        monkeypatch.setattr(place, name, lambda *a, step=step, name=name, **k: called.append(name) or step(*a, **k))
    assert analysis.score_approved(spark, SMALL).count() == jobs.prepare(fx.impressions(spark, SMALL)).count()
    assert called == ["clean_rows", "rolling_top", "clean_rows"]  # the last one is that of the line above


def test_shared_rows_give_what_a_job_makes_itself(spark, raw, prepared):
    clean = jobs.staged_clean(raw)
    rolling = jobs.staged_rolling(raw, clean=clean)
    assert all(same(a, b) for a, b in zip(jobs.preprocess(raw, fx.CUTS, engineered=True, rolling=rolling), prepared))
    assert same(jobs.transactions(raw, rolling=rolling)[0], jobs.transactions(raw)[0])
    assert same(fx.request_batches(spark, SMALL, clean), fx.request_batches(spark, SMALL))
    with pytest.raises(ValueError, match="engineered"):
        jobs.preprocess(raw, fx.CUTS, rolling=rolling)
