import datetime

import pytest
from pyspark.sql import functions as F

from ctrflow.functions import codes, time
from ctrflow.operators import explore
from tests.conftest import executed, table

# ---- fixed values: part of the day by hour -----------------------------------------------------
PARTS = (
    ["evening"] + ["night"] * 4 + ["early-morning"] * 5 + ["morning"] * 4 + ["afternoon"] * 4
    + ["evening"] * 5 + ["night"]
)
# ---- end of fixed values ----------------------------------------------------------------------


def test_time_of_day_for_every_hour(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h")).withColumn("part", time.time_of_day(F.col("h")))
    assert [r.part for r in df.orderBy("h").collect()] == PARTS
    none = spark.range(1).select(time.time_of_day(F.lit(None).cast("int")).alias("part"))
    assert none.first().part == "evening"


def test_iso_timestamp_truncates_to_milliseconds(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678999' AS t")
    assert df.select(time.iso_timestamp(F.col("t"))).first()[0] == "2024-01-02T03:04:05.678Z"


def test_parse_datetime(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02 03:04:05.000001",), (None,)], "t string")
    got = [r[0] for r in df.select(time.parse_datetime(F.col("t"))).collect()]
    assert got == [datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2, 3, 4, 5, 1), None]


def test_threshold_is_strict_unless_told(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "p double")
    p = F.col("p")
    assert [tuple(r) for r in df.select(codes.threshold_label(p), codes.threshold_label(p, inclusive=True)).collect()] == [
        (0, 0), (0, 1), (1, 1)]


def test_rows_as_text_keep_positions(spark):
    df = spark.createDataFrame([(1, None, "x", 2.0)], "a int, b int, c string, d double")
    assert df.select(codes.as_csv_row(df.columns)).first()[0] == "1,,x,2.0"


def test_value_counts(rows_of):
    df = rows_of({"product": "B"}, {"product": "A"}, {"product": "C"}, {"product": "C"}, {"product": None})
    assert table(explore.value_counts(df, "product")) == [("C", 2), ("A", 1), ("B", 1)]


def test_clicks_count_zero_for_unknown_targets(rows_of):
    df = rows_of({"is_click": None}, {"is_click": 1, "DateTime": 1}, {"is_click": 1, "DateTime": 1}, {"DateTime": None, "is_click": 1})
    assert [r.number_of_clicks for r in explore.clicks_by(df, "DateTime").collect()] == [0, 2]


def test_rate_counts_known_targets_only(rows_of):
    row = explore.overall_ctr(rows_of({"is_click": 1}, {"is_click": 0}, {"is_click": None})).first()
    assert (row.clicks, row.ctr) == (1, 0.5)
    row = explore.category_ctr(rows_of({"is_click": 1}, {"is_click": None}, {"product": None}), "product").first()
    assert (row["product"], row.no_of_sessions, row.no_of_clicks, row.ctr) == ("A", 2, 1, 0.5)


def test_top_per_group_ties_to_the_lowest(rows_of):
    df = rows_of({"product": "B"}, {"product": "A"}, {"user_id": 2, "product": "C"}, {"user_id": 2, "product": "C"}, {"user_id": 2, "product": "A"})
    assert table(explore.top_per_group(df, "user_id", "product"), "user_id") == [(1, "A", 1), (2, "C", 2)]


def test_sorts(raw):
    out = explore.sort_impressions(raw.na.drop(subset=["user_id", "DateTime", "session_id"]))
    keys = [(r.user_id, r.DateTime, r.session_id) for r in out.collect()]
    assert keys == sorted(keys)
    out = explore.newest_first(raw.where("DateTime IS NOT NULL"), "DateTime", ["session_id"])
    times = [r.DateTime for r in out.collect()]
    assert times == sorted(times, reverse=True)
    assert len(explore.head(raw, 3, ["session_id"]).collect()) == 3


def test_profile_is_one_pass(raw):
    profile = explore.profile_columns(raw)
    assert {r["column"]: r.non_null for r in profile.collect()} == {c: raw.where(F.col(c).isNotNull()).count() for c in raw.columns}
    assert executed(profile).split("Initial Plan")[0].count("Exchange") == 1


def test_distinct_and_bounds(rows_of):
    df = rows_of({"user_id": 1}, {"user_id": 1, "DateTime": 5}, {"user_id": 2}, {"user_id": None})
    assert explore.distinct_users(df).first().users == 2
    row = explore.time_bounds(df).first()
    assert row.latest - row.earliest == datetime.timedelta(minutes=5)


@pytest.mark.parametrize("n", [0, 3])
def test_summary(rows_of, n):
    row = explore.summary(rows_of(*[{"is_click": 1}] * n, {"is_click": 0})).first()
    assert (row.users, row.clicks, row.ctr) == (1, n, n / (n + 1))
