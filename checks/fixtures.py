"""Frames derived from the test tables, for the queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ctrflow.functions.time import iso_timestamp, with_time_parts
from ctrflow.operators.clean import clean_rows
from ctrflow.operators.explore import category_ctr, overall_ctr
from ctrflow.operators.metrics import f1_by
from ctrflow.plans.jobs import prepare
from ctrflow.sources.requests import POSITIONS, as_request, request_row

CUTS = ("2024-01-21", "2024-01-26")
LOAD_1, LOAD_2 = "2024-02-01T00:00:00.000Z", "2024-02-02T00:00:00.000Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The impression log: every event once, every 20th twice, with planted nulls."""
    copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", F.explode(copies).alias("dup"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    e, k, u = F.col("event_id"), F.col("k"), F.col("user_id")

    def unless(divisor: int, value):
        return F.when(e % divisor != 0, value)

    letter = F.substring(F.lit("ABCDEFGHIJ"), (k % 10 + 1), F.lit(1))
    return events.select(
        unless(211, e + F.col("dup") * F.lit(1_000_000_000).cast("bigint")).alias("session_id"),
        unless(229, F.col("ts")).alias("DateTime"),
        unless(223, u).alias("user_id"),
        F.when(k % 23 != 0, letter).alias("product"),
        (F.lit(80000) + ((e * 7) % 10) * 30000).cast("bigint").alias("campaign_id"),
        (F.lit(1000) + (e % 9) * 7000).cast("bigint").alias("webpage_id"),
        (F.lit(1) + k % 5).cast("bigint").alias("product_category_1"),
        F.when(e % 4 == 0, (F.lit(10000) + k * 100).cast("double")).alias("product_category_2"),
        unless(29, (u % 13).cast("double")).alias("user_group_id"),
        unless(31, F.when(u % 3 == 0, "Female").otherwise("Male")).alias("gender"),
        unless(37, (u % 7).cast("double")).alias("age_level"),
        unless(41, (F.lit(1) + u % 3).cast("double")).alias("user_depth"),
        unless(3, (F.lit(1) + u % 4).cast("double")).alias("city_development_index"),
        unless(227, F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("is_click"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(impressions(spark, sf_dir))


def with_rate(rows: DataFrame) -> DataFrame:
    """A probability without a model: the click rate of the row's product."""
    rates = category_ctr(rows, "product").select(
        F.col("product").alias("_p"), F.col("ctr").alias("probability")
    )
    return rows.join(rates, F.col("product") == F.col("_p"), "left").drop("_p")


def predictions(rows: DataFrame) -> DataFrame:
    """1 when the product's click rate is above the overall rate."""
    overall = overall_ctr(rows).first()["ctr"]
    return with_rate(rows).select(
        "session_id", "DateTime", "user_id", "product", "is_click", "probability",
        F.when(F.col("probability") > overall, 1).otherwise(0).alias("prediction"),
    )


def reports(rows: DataFrame) -> DataFrame:
    """F1 of the rule per product, as ``f1_score``."""
    return f1_by(predictions(rows), ["product"])


def registry_rows(rows: DataFrame) -> DataFrame:
    """A model version per product and day with the day's F1 of the rule; every third is approved,
    product A never."""
    daily = predictions(rows).withColumn("day", F.to_date("DateTime"))
    version = F.dayofmonth("day")
    status = (
        F.when((version % 3 == 0) & (F.col("product") != "A"), "Approved")
        .when(version % 3 == 1, "PendingManualApproval")
        .otherwise("Rejected")
    )
    return f1_by(daily, ["product", "day"]).select(
        F.concat(F.lit("ctr-"), "product").alias("model_group"),
        version.alias("version"),
        F.concat_ws("/", F.lit("models"), "product", version).alias("model_path"),
        status.alias("status"),
        F.col("day").cast("timestamp_ntz").alias("created"),
        F.col("f1_score").alias("f1"),
    )


def request_rows(spark: SparkSession, sf_dir: str, cleaned: DataFrame | None = None) -> DataFrame:
    """Every clean impression as a request row of a batch; some genders in capitals, some unknown
    products, some unknown users. ``cleaned`` are the clean rows, where the query has them."""
    rows = with_time_parts(clean_rows(impressions(spark, sf_dir)) if cleaned is None else cleaned)
    s = F.col("session_id")
    planted = rows.withColumns({
        "gender": F.when(s % 3 == 0, F.upper("gender")).otherwise(F.col("gender")),
        "product": F.when(s % 17 == 0, "Z").otherwise(F.col("product")),
        "user_id": F.when(s % 19 == 0, F.col("user_id") + 1_000_000).otherwise(F.col("user_id")),
    })
    return planted.select(F.floor(s / 16).alias("batch_id"), s, *POSITIONS)


def request_batches(spark: SparkSession, sf_dir: str, cleaned: DataFrame | None = None) -> DataFrame:
    """JSON bodies of at most 16 rows, in session order."""
    pair = F.struct("session_id", request_row().alias("row"))
    batches = request_rows(spark, sf_dir, cleaned).groupBy("batch_id").agg(
        F.sort_array(F.collect_list(pair)).alias("pairs")
    )
    return batches.select("batch_id", as_request(F.col("pairs.row")).alias("body"))


def events_with_time(rows: DataFrame) -> DataFrame:
    """Clean rows with their own time as event time."""
    return rows.withColumn("event_time", iso_timestamp(F.col("DateTime")))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for the comparison."""
    return df.select(*[
        F.round(c, places).alias(c) if dtype == "double" else F.col(c) for c, dtype in df.dtypes
    ])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
