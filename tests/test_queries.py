"""Registered queries against their SQL. ``ALL_QUERIES=1`` runs all of them, not only those below."""

import os

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import connect, differences
from tests.conftest import SMALL

SOME = [
    "ingest_rejects", "request_batch", "impute_mode", "impute_stats", "conform_schema", "lookup_default",
    "rolling_top_webpage", "upsample", "target_encode_crossfit", "classification_report", "preprocess_train",
    "ingest_transactions",
]
NAMES = list(registry.ORACLES) if os.environ.get("ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "user_id", "gender_encoding", "age_level_encoding", "most_recent_clicked_product_encoding",
        "most_recent_clicked_webpage_encoding", "event_time", "event_date"]
    assert not df.isEmpty()


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) - set(registry.ORACLES) == {
        "lr_predict", "rf_predict", "gbt_predict", "batch_score", "score_requests", "train_evaluate"}
