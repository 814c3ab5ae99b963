"""Queries: sources, sinks, projections, cleaning, joins, feature tables, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import FEATURES, ISO, TIME_OF_DAY, sql
from ctrflow import schema
from ctrflow.functions.codes import as_csv_row, gender_code, threshold_label
from ctrflow.functions.time import iso_timestamp, parse_datetime, stamp, time_of_day
from ctrflow.operators import clean as cl, customers, encode, explore, impute, split
from ctrflow.operators.conform import conform
from ctrflow.operators.rolling import rolling_top
from ctrflow.plans import jobs, scoring
from ctrflow.session import scratch_path
from ctrflow.sources import feature_table as ft, files, prediction_log, registry, requests, snapshot
from ctrflow.streaming import jobs as streams

REQUIRED_ROWS = "SELECT * FROM required"
TARGET_FIRST = ", ".join(["is_click", *FEATURES])


def _required(spark, sf_dir):
    return cl.drop_null_required(fx.impressions(spark, sf_dir))


def _prepared(spark, sf_dir, **options):
    return jobs.preprocess(fx.impressions(spark, sf_dir), fx.CUTS, **options)


# ---- sources and sinks ----------------------------------------------------------------------

@query("csv_scan", sql("SELECT * FROM impressions"))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(fx.impressions(spark, sf_dir), path)
    return files.read_csv(spark, path)


@query("headerless_csv_scan", sql(f"SELECT {TARGET_FIRST} FROM encoded", "encoded"))
def headerless_csv_scan(spark, sf_dir):
    rows, path = fx.union_all(list(_prepared(spark, sf_dir))), scratch_path(spark, "matrix")
    schema.project(rows, schema.FEATURES).write.csv(path)
    return files.read_matrix(spark, path, schema.FEATURES[1:])


@query("headerless_csv_sink", sql(f"SELECT {TARGET_FIRST} FROM encoded WHERE split = 'train'", "encoded"))
def headerless_csv_sink(spark, sf_dir):
    train, path = _prepared(spark, sf_dir).train, scratch_path(spark, "matrix")
    files.write_matrix(train.select(*reversed(schema.FEATURES)), path)
    return files.read_matrix(spark, path, schema.FEATURES[:0:-1]).select(*schema.FEATURES)


def _loads(spark, sf_dir) -> str:
    """Feature table with two loads of customer profiles: training rows, then the later rows."""
    prepared, path = _prepared(spark, sf_dir, engineered=True), scratch_path(spark, "customers")
    later = prepared.validation.unionByName(prepared.test)
    for rows, load_time in ((prepared.train, fx.LOAD_1), (later, fx.LOAD_2)):
        ft.append_features(stamp(customers.customer_profile(rows), load_time), path, load_id=load_time)
    return path


def _snapshot(spark, sf_dir) -> str:
    """The same table with a snapshot that was refreshed after each of its loads."""
    prepared, path = _prepared(spark, sf_dir, engineered=True), scratch_path(spark, "customers")
    later = prepared.validation.unionByName(prepared.test)
    for rows, load_time in ((prepared.train, fx.LOAD_1), (later, fx.LOAD_2)):
        ft.append_features(stamp(customers.customer_profile(rows), load_time), path)
        snapshot.refresh_latest(spark, path, schema.USER)
    return path


def _latest(spark, sf_dir):
    return snapshot.read_latest(spark, _snapshot(spark, sf_dir), schema.USER)


@query("feature_append", sql("SELECT * FROM loads", "loads"))
def feature_append(spark, sf_dir):
    return ft.read_features(spark, _loads(spark, sf_dir))


@query("offline_scan", sql(
    "SELECT * FROM loads UNION ALL BY NAME SELECT user_id, gender_encoding, event_time, event_date FROM loads "
    "WHERE event_time = (SELECT min(event_time) FROM loads)", "loads"
))
def offline_scan(spark, sf_dir):
    """The whole table of two batch loads, the second given twice, and of a stream with fewer columns."""
    path = _loads(spark, sf_dir)
    some = ft.read_features(spark, path).where(F.col("event_time") == fx.LOAD_1).select("user_id", "gender_encoding", "event_time")
    again = ft.read_features(spark, path).where(F.col("event_time") == fx.LOAD_2).drop("event_date")
    ft.append_features(again, path, load_id=fx.LOAD_2)
    source = scratch_path(spark, "stream-in")
    some.write.parquet(source)
    streams.stream_ingest(
        streams.read_stream(spark, source, some.schema), path, scratch_path(spark, "checkpoint")).awaitTermination()
    return ft.read_features(spark, path)


def _raw_text(spark, sf_dir):
    """Impressions as text, some with a category that is no number."""
    rows = schema.to_string(fx.impressions(spark, sf_dir), ["session_id", "product_category_1"])
    bad = F.col("session_id").cast("bigint") % 97 == 0
    return rows.withColumn(
        "product_category_1", F.when(bad, "n/a").otherwise(F.col("product_category_1"))
    )


@query("ingest_rejects", sql(
    "SELECT CAST(session_id AS VARCHAR) AS session_id, user_id, product, "
    "CASE WHEN session_id % 97 = 0 THEN 'n/a' ELSE CAST(product_category_1 AS VARCHAR) END AS product_category_1, "
    f"'{fx.LOAD_1}' AS event_time FROM impressions WHERE session_id IS NULL OR session_id % 97 = 0"
))
def ingest_rejects(spark, sf_dir):
    path = scratch_path(spark, "ingest")
    columns = ["session_id", "user_id", "product", "product_category_1"]
    raw = _raw_text(spark, sf_dir).select(*columns)
    definitions = schema.infer_definitions(fx.impressions(spark, sf_dir).select(*columns))
    ft.ingest(
        raw, f"{path}/good", definitions, schema.ID, fx.LOAD_1, f"{path}/rejects", fail=False
    )
    return ft.read_features(spark, f"{path}/rejects").drop("event_date")


@query("report_json", sql("SELECT product, round(f1_score, 6) AS f1_score FROM reports", "predictions"))
def report_json(spark, sf_dir):
    path = scratch_path(spark, "reports")
    files.write_report(files.as_report(fx.reports(fx.clean(spark, sf_dir))), path)
    read = files.read_report(spark, path, "product string")
    return read.select(
        "product", F.round("classification_metrics.f1_score.value", 6).alias("f1_score")
    )


@query("request_batch", sql("SELECT * FROM requests", "requests"))
def request_batch(spark, sf_dir):
    return requests.parse_requests(fx.request_batches(spark, sf_dir))


LOGGED = (
    "SELECT session_id, user_id, product, round(probability, 6) AS probability, prediction FROM predictions "
    "WHERE CAST('0x' || substr(md5(CAST(session_id AS VARCHAR) || ':42'), 1, 15) AS BIGINT) % 100 < 80"
)


@query("prediction_log_sample", sql(LOGGED, "predictions"))
def prediction_log_sample(spark, sf_dir):
    path = scratch_path(spark, "log")
    prediction_log.append_log(fx.predictions(fx.clean(spark, sf_dir)), path)
    return fx.rounded(
        spark.read.parquet(path).select("session_id", "user_id", "product", "probability", "prediction")
    )


@query("serialize_rows", sql(
    "SELECT session_id, concat_ws(',', {}) AS payload FROM encoded".format(
        ", ".join(f"CAST({c} AS VARCHAR)" for c in FEATURES)
    ), "encoded",
))
def serialize_rows(spark, sf_dir):
    rows = fx.union_all(list(_prepared(spark, sf_dir)))
    return rows.select("session_id", as_csv_row(schema.FEATURES[1:]).alias("payload"))


# ---- projections, filters, cleaning ---------------------------------------------------------

@query("feature_matrix", sql(f"SELECT {TARGET_FIRST} FROM encoded", "encoded"))
def feature_matrix(spark, sf_dir):
    return schema.project(fx.union_all(list(_prepared(spark, sf_dir))), schema.FEATURES)


@query("drop_columns", sql("SELECT * EXCLUDE (is_click, user_depth) FROM impressions"))
def drop_columns(spark, sf_dir):
    return schema.drop_columns(fx.impressions(spark, sf_dir), "is_click", "user_depth")


@query("drop_null_required", sql(REQUIRED_ROWS, "required"))
def drop_null_required(spark, sf_dir):
    return _required(spark, sf_dir)


@query("dedup_impressions", sql("SELECT * FROM dedup", "dedup"))
def dedup_impressions(spark, sf_dir):
    return cl.dedup_impressions(_required(spark, sf_dir))


@query("time_split", sql("SELECT session_id, DateTime, split FROM parts", "parts"))
def time_split(spark, sf_dir):
    parts = split.time_split(cl.clean_rows(fx.impressions(spark, sf_dir)), *fx.CUTS)
    return fx.union_all([
        part.select("session_id", "DateTime", F.lit(name).alias("split"))
        for name, part in zip(split.PARTS, parts)
    ])


@query("class_split", sql(
    "SELECT session_id, is_click, CASE is_click WHEN 0 THEN 'majority' ELSE 'minority' END AS class "
    "FROM impressions WHERE is_click IN (0, 1)"
))
def class_split(spark, sf_dir):
    zero, one = split.class_split(fx.impressions(spark, sf_dir).select("session_id", "is_click"))
    return split.union_rows(
        zero.withColumn("class", F.lit("majority")), one.withColumn("class", F.lit("minority"))
    )


def _imputed(table, modes=(), medians=()):
    fills = [
        f"coalesce({c}, (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}"
        for c in modes
    ] + [f"coalesce({c}, (SELECT median({c}) FROM {table})) AS {c}" for c in medians]
    return f"SELECT * REPLACE ({', '.join(fills)}) FROM {table}"


MEDIANS = ("product_category_2", "user_group_id", "age_level", "user_depth", "city_development_index")


@query("impute_mode", sql(_imputed("required", ("product", "gender")), "required"))
def impute_mode(spark, sf_dir):
    return impute.impute(_required(spark, sf_dir), medians=[])


@query("impute_median", sql(_imputed("required", medians=MEDIANS), "required"))
def impute_median(spark, sf_dir):
    return impute.impute(_required(spark, sf_dir), modes=[])


@query("impute_mode_named", sql(_imputed("impressions", ("age_level", "gender"))))
def impute_mode_named(spark, sf_dir):
    return impute.impute(fx.impressions(spark, sf_dir), modes=["age_level", "gender"], medians=[])


@query("select_by_dtype", sql(
    "SELECT session_id, user_id, campaign_id, webpage_id, product_category_1, product_category_2, user_group_id, "
    "age_level, user_depth, city_development_index, is_click FROM impressions"
))
def select_by_dtype(spark, sf_dir):
    return schema.select_by_kind(fx.impressions(spark, sf_dir), "Integral", "Fractional")


@query("conform_schema", sql(
    "SELECT session_id, CAST(user_id AS DOUBLE) AS user_id, product, "
    "CASE WHEN session_id % 97 = 0 THEN NULL ELSE product_category_1 END AS product_category_1, "
    f"CAST(is_click AS VARCHAR) AS is_click, '{fx.LOAD_1}' AS event_time FROM impressions"
))
def conform_schema(spark, sf_dir):
    definitions = {
        "session_id": "Integral", "user_id": "Fractional", "product": "String",
        "product_category_1": "Integral", "is_click": "Boolean", "event_time": "String",
    }
    return conform(_raw_text(spark, sf_dir), definitions, fx.LOAD_1)


@query("ids_to_string", sql(
    "SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id, product, is_click FROM impressions"
))
def ids_to_string(spark, sf_dir):
    rows = schema.to_string(fx.impressions(spark, sf_dir), ["session_id", "user_id"])
    return rows.select("session_id", "user_id", "product", "is_click")


@query("stamp_load_time", sql(f"SELECT *, '{fx.LOAD_1}' AS event_time FROM impressions"))
def stamp_load_time(spark, sf_dir):
    return stamp(fx.impressions(spark, sf_dir), fx.LOAD_1)


@query("rename_columns", sql(
    "SELECT DateTime AS clicked_at, number_of_clicks AS \"number of clicks\" FROM ("
    "SELECT DateTime, CAST(coalesce(sum(is_click), 0) AS BIGINT) AS number_of_clicks FROM impressions "
    "WHERE DateTime IS NOT NULL GROUP BY 1)"
))
def rename_columns(spark, sf_dir):
    clicks = explore.clicks_by(fx.impressions(spark, sf_dir), "DateTime")
    return schema.rename(clicks, {"DateTime": "clicked_at", "number_of_clicks": "number of clicks"})


DEFINITIONS = {
    "session_id": "Integral", "DateTime": "String", "user_id": "Integral", "product": "String",
    "campaign_id": "Integral", "webpage_id": "Integral", "product_category_1": "Integral",
    "product_category_2": "Fractional", "user_group_id": "Fractional", "gender": "String",
    "age_level": "Fractional", "user_depth": "Fractional", "city_development_index": "Fractional",
    "is_click": "Integral",
}


@query("feature_definitions", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{kind}' AS kind, count({c}) AS n_values FROM impressions"
    for c, kind in DEFINITIONS.items()
)))
def feature_definitions(spark, sf_dir):
    rows = fx.impressions(spark, sf_dir)
    definitions = schema.infer_definitions(rows)
    kind = F.coalesce(*[F.when(F.col("column") == c, k) for c, k in definitions.items()])
    return explore.profile_columns(rows).select(
        F.col("column").alias("feature"), kind.alias("kind"), F.col("non_null").alias("n_values")
    )


# ---- joins ----------------------------------------------------------------------------------

@query("attach_features", sql(
    "SELECT c.user_id, c.session_id, c.is_click, most_recent_clicked_product FROM clean c "
    "LEFT JOIN most_recent_clicked_product USING (session_id)", "rolling"
))
def attach_features(spark, sf_dir):
    rows = fx.clean(spark, sf_dir)
    name = schema.ENGINEERED["product"]
    features = rolling_top(rows, {"product": name}).select("user_id", "session_id", name)
    base = rows.select("user_id", "session_id", "is_click")
    return customers.attach_features(base, features)


@query("dict_lookup", sql(
    "SELECT session_id, product, (SELECT code FROM t_product m WHERE m.v = d.product) AS product_encoding FROM dedup d",
    "encoded",
))
def dict_lookup(spark, sf_dir):
    rows = cl.clean_rows(fx.impressions(spark, sf_dir))
    mapping = _prepared(spark, sf_dir).encoder.mapping
    return encode.lookup(rows.select("session_id", "product"), mapping, {"product": "product"})


@query("lookup_default", sql(
    "SELECT batch_id, position, r.user_id, coalesce(CAST(most_recent_clicked_product_encoding AS DOUBLE), -1) "
    "AS most_recent_clicked_product_encoding FROM requests r LEFT JOIN latest l ON r.user_id = l.user_id", "requests",
))
def lookup_default(spark, sf_dir):
    rows = requests.parse_requests(fx.request_batches(spark, sf_dir))
    return ft.lookup_default(
        rows.select("batch_id", "position", "user_id"), _latest(spark, sf_dir), schema.USER, scoring.RECENT
    )


@query("get_record", sql(
    "SELECT * FROM latest WHERE user_id = (SELECT max(user_id) FROM loads)", "loads"
))
def get_record(spark, sf_dir):
    path = _snapshot(spark, sf_dir)
    newest_user = ft.read_features(spark, path).agg(F.max("user_id")).first()[0]
    return snapshot.get_latest(spark, path, schema.USER, newest_user)


@query("latest_per_key", sql("SELECT * FROM latest", "loads"))
def latest_per_key(spark, sf_dir):
    return _latest(spark, sf_dir)


@query("latest_loads", sql("SELECT * FROM loads", "loads"))
def latest_loads(spark, sf_dir):
    return explore.newest_first(ft.read_features(spark, _loads(spark, sf_dir)), then=[schema.USER])


# ---- scalar functions -----------------------------------------------------------------------

@query("parse_datetime", sql(
    "SELECT session_id, DateTime, date_trunc('second', DateTime) AS to_second FROM impressions"
))
def parse_datetime_(spark, sf_dir):
    rows = fx.impressions(spark, sf_dir)
    text = F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    short = F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        "session_id", parse_datetime(text).alias("DateTime"), parse_datetime(short).alias("to_second")
    )


@query("date_parts", sql(
    "SELECT session_id, CAST(hour(DateTime) AS INT) AS hour, CAST(DateTime AS DATE) AS Date FROM impressions"
))
def date_parts(spark, sf_dir):
    return fx.impressions(spark, sf_dir).select(
        "session_id", F.hour("DateTime").alias("hour"), F.to_date("DateTime").alias("Date")
    )


@query("time_of_day", sql(
    f"SELECT session_id, CAST(hour(DateTime) AS INT) AS hour, {TIME_OF_DAY.format(h='hour(DateTime)')} AS time_of_day FROM impressions"
))
def time_of_day_(spark, sf_dir):
    hour = F.hour("DateTime")
    return fx.impressions(spark, sf_dir).select(
        "session_id", hour.alias("hour"), time_of_day(hour).alias("time_of_day")
    )


@query("gender_code", sql(
    "SELECT batch_id, position, gender, CASE lower(gender) WHEN 'female' THEN 0 WHEN 'male' THEN 1 END AS gender_encoding FROM requests",
    "requests",
))
def gender_code_(spark, sf_dir):
    rows = requests.parse_requests(fx.request_batches(spark, sf_dir))
    return rows.select(
        "batch_id", "position", "gender", gender_code(F.col("gender")).alias("gender_encoding")
    )


@query("iso_timestamp", sql(f"SELECT session_id, {ISO.format(t='DateTime')} AS event_time FROM impressions"))
def iso_timestamp_(spark, sf_dir):
    return fx.impressions(spark, sf_dir).select(
        "session_id", iso_timestamp(F.col("DateTime")).alias("event_time")
    )


@query("threshold_label", sql(
    "SELECT session_id, CASE WHEN probability > t THEN 1 ELSE 0 END AS strict, "
    "CASE WHEN probability >= t THEN 1 ELSE 0 END AS inclusive FROM predictions, "
    "(SELECT median(ctr) AS t FROM rates WHERE ctr IN (SELECT ctr FROM rates ORDER BY ctr LIMIT 3))", "predictions",
))
def threshold_label_(spark, sf_dir):
    rows = fx.with_rate(fx.clean(spark, sf_dir))
    # The second lowest of the ten product rates: a threshold that some rows meet exactly.
    rates = explore.category_ctr(rows, "product").orderBy("ctr").limit(3).collect()
    p, t = F.col("probability"), rates[1]["ctr"]
    return rows.select(
        "session_id",
        threshold_label(p, t).alias("strict"),
        threshold_label(p, t, inclusive=True).alias("inclusive"),
    )


@query("json_metric", sql("SELECT product, round(f1_score, 6) AS f1 FROM reports", "predictions"))
def json_metric(spark, sf_dir):
    report = files.as_report(fx.reports(fx.clean(spark, sf_dir)))
    text = F.to_json(F.struct("classification_metrics"))
    return report.select("product", F.round(files.json_metric(text), 6).alias("f1"))


# ---- registry -------------------------------------------------------------------------------

REGISTRY = "model_group, version, model_path, {status}, created, round(f1, 6) AS f1"


@query("quality_gate", sql(
    f"SELECT {REGISTRY.format(status='status')} FROM registry WHERE f1 >= 0.2", "predictions"
))
def quality_gate(spark, sf_dir):
    return fx.rounded(registry.quality_gate(fx.registry_rows(fx.clean(spark, sf_dir))))


@query("register_model", sql(
    "SELECT {} FROM registry WHERE f1 >= 0.2".format(
        REGISTRY.format(status="'PendingManualApproval' AS status")
    ), "predictions",
))
def register_model(spark, sf_dir):
    path = scratch_path(spark, "registry")
    candidates = fx.registry_rows(fx.clean(spark, sf_dir)).drop("status")
    registry.register_models(registry.quality_gate(candidates), path)
    return fx.rounded(registry.read_registry(spark, path)).drop("changed")


@query("latest_approved", sql(
    "SELECT model_group, version, model_path, created, round(f1, 6) AS f1 FROM (SELECT *, row_number() OVER "
    "(PARTITION BY model_group ORDER BY created DESC, version DESC) AS rn FROM registry WHERE status = 'Approved') WHERE rn = 1",
    "predictions",
))
def latest_approved(spark, sf_dir):
    path = scratch_path(spark, "registry")
    registry.register_models(fx.registry_rows(fx.clean(spark, sf_dir)), path)
    return fx.rounded(registry.latest_approved(registry.read_registry(spark, path)))
