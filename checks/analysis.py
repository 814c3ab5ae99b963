"""Queries: aggregates, windows, sampling, encoders, models, metrics, streams, jobs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import ENCODED, FEATURES, ISO, sql
from ctrflow import schema
from ctrflow.operators import encode, explore, impute, metrics, model, rolling, sample
from ctrflow.operators.boosting import boosting_at
from ctrflow.operators.clean import drop_null_required
from ctrflow.operators.customers import customer_profile
from ctrflow.operators.split import union_rows
from ctrflow.plans import jobs, scoring
from ctrflow.session import scratch_path, stage
from ctrflow.sources import feature_table as ft, registry, snapshot
from ctrflow.sources.files import read_matrix
from ctrflow.sources.prediction_log import CAPTURE_PERCENT
from ctrflow.streaming import jobs as streams

# ---- aggregates -----------------------------------------------------------------------------


@query("time_bounds", sql("SELECT min(DateTime) AS earliest, max(DateTime) AS latest FROM impressions"))
def time_bounds(spark, sf_dir):
    return explore.time_bounds(fx.impressions(spark, sf_dir))


@query("distinct_users", sql("SELECT count(DISTINCT user_id) AS users FROM impressions"))
def distinct_users(spark, sf_dir):
    return explore.distinct_users(fx.impressions(spark, sf_dir))


@query("overall_ctr", sql(
    "SELECT CAST(sum(is_click) AS BIGINT) AS clicks, round(sum(is_click) / count(is_click), 6) AS ctr FROM impressions"
))
def overall_ctr(spark, sf_dir):
    return fx.rounded(explore.overall_ctr(fx.impressions(spark, sf_dir)))


@query("value_counts", sql(
    "SELECT is_click, count(*) AS count FROM impressions WHERE is_click IS NOT NULL GROUP BY 1"
))
def value_counts(spark, sf_dir):
    return explore.value_counts(fx.impressions(spark, sf_dir), "is_click")


@query("clicks_by_time", sql(
    "SELECT DateTime, CAST(coalesce(sum(is_click), 0) AS BIGINT) AS number_of_clicks FROM impressions "
    "WHERE DateTime IS NOT NULL GROUP BY 1"
))
def clicks_by_time(spark, sf_dir):
    return explore.clicks_by(fx.impressions(spark, sf_dir), "DateTime")


@query("clicks_by_hour", sql(
    "SELECT CAST(hour(DateTime) AS INT) AS hour, CAST(coalesce(sum(is_click), 0) AS BIGINT) AS number_of_clicks "
    "FROM impressions WHERE DateTime IS NOT NULL GROUP BY 1"
))
def clicks_by_hour(spark, sf_dir):
    rows = fx.impressions(spark, sf_dir).withColumn("hour", F.hour("DateTime"))
    return explore.clicks_by(rows, "hour")


@query("category_ctr", sql(
    "SELECT product, count(session_id) AS no_of_sessions, CAST(sum(is_click) AS BIGINT) AS no_of_clicks, "
    "round(sum(is_click) / count(session_id), 6) AS ctr FROM clean GROUP BY 1", "clean",
))
def category_ctr(spark, sf_dir):
    return fx.rounded(explore.category_ctr(fx.clean(spark, sf_dir), "product"))


@query("customer_profile", sql("SELECT * FROM customers", "encoded_all"))
def customer_profile_(spark, sf_dir):
    return customer_profile(jobs.transactions(fx.impressions(spark, sf_dir))[0])


STATS = {
    **{c: ("mode", c) for c in ("product", "gender")},
    **{c: ("median", c) for c in (
        "user_id", "campaign_id", "webpage_id", "product_category_1", "product_category_2", "user_group_id",
        "age_level", "user_depth", "city_development_index",
    )},
}


def _stat(kind, c):
    if kind == "median":
        return f"(SELECT median({c}) FROM impressions)"
    return f"(SELECT {c} FROM impressions WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("impute_stats", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{kind}' AS statistic, CAST({_stat(kind, c)} AS VARCHAR) AS value "
    for c, (kind, _) in STATS.items()
)))
def impute_stats(spark, sf_dir):
    rows = fx.impressions(spark, sf_dir)
    modes = impute.column_modes(rows, [c for c, (kind, _) in STATS.items() if kind == "mode"])
    medians = impute.column_medians(rows, [c for c, (kind, _) in STATS.items() if kind == "median"])
    found = [
        *[(c, "mode", v) for c, v in modes.items()],
        *[(c, "median", str(v)) for c, v in medians.items()],
    ]
    return spark.createDataFrame(found, "column string, statistic string, value string")


TYPES = [
    ("session_id", "bigint"), ("DateTime", "timestamp_ntz"), ("user_id", "bigint"), ("product", "string"),
    ("campaign_id", "bigint"), ("webpage_id", "bigint"), ("product_category_1", "bigint"),
    ("product_category_2", "double"), ("user_group_id", "double"), ("gender", "string"), ("age_level", "double"),
    ("user_depth", "double"), ("city_development_index", "double"), ("is_click", "int"),
]


@query("profile_columns", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, '{t}' AS dtype FROM impressions" for c, t in TYPES
)))
def profile_columns(spark, sf_dir):
    return explore.profile_columns(fx.impressions(spark, sf_dir))


# ---- windows --------------------------------------------------------------------------------

def _rolling(spark, sf_dir, column, clicked="is_click"):
    name = schema.ENGINEERED[column]
    rows = rolling.rolling_top(fx.clean(spark, sf_dir), {column: name}, clicked=clicked)
    return rows.select("session_id", name)


@query("rolling_top_product", sql(
    "SELECT session_id, most_recent_clicked_product FROM most_recent_clicked_product", "rolling"
))
def rolling_top_product(spark, sf_dir):
    return _rolling(spark, sf_dir, "product")


@query("rolling_top_webpage", sql(
    "SELECT session_id, most_recent_clicked_webpage FROM most_recent_clicked_webpage", "rolling"
))
def rolling_top_webpage(spark, sf_dir):
    return _rolling(spark, sf_dir, "webpage_id")


@query("rolling_mode_product", sql(
    "SELECT session_id, modal AS most_recent_clicked_product FROM most_recent_clicked_product", "rolling"
))
def rolling_mode_product(spark, sf_dir):
    return _rolling(spark, sf_dir, "product", clicked=None)


@query("top_product_per_user", sql(
    "SELECT user_id, product, count FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY count DESC, product) AS rn "
    "FROM (SELECT user_id, product, count(*) AS count FROM impressions WHERE user_id IS NOT NULL AND product IS NOT NULL "
    "GROUP BY 1, 2)) WHERE rn = 1"
))
def top_product_per_user(spark, sf_dir):
    return explore.top_per_group(fx.impressions(spark, sf_dir), "user_id", "product")


# ---- sort, limit, union, sampling -----------------------------------------------------------

@query("sorted_impressions", sql("SELECT * FROM impressions"))
def sorted_impressions(spark, sf_dir):
    return explore.sort_impressions(fx.impressions(spark, sf_dir))


@query("head_rows", sql("SELECT * FROM required ORDER BY DateTime, session_id LIMIT 5", "required"))
def head_rows(spark, sf_dir):
    return explore.head(drop_null_required(fx.impressions(spark, sf_dir)), 5, ["DateTime", "session_id"])


@query("union_rows", sql("SELECT * FROM impressions UNION ALL SELECT * FROM required", "required"))
def union_rows_(spark, sf_dir):
    rows = fx.impressions(spark, sf_dir)
    return union_rows(rows, drop_null_required(rows))


HASH = "md5(CAST(session_id AS VARCHAR) || ':42')"


@query("downsample", sql(
    f"""SELECT session_id, is_click FROM (SELECT *, row_number() OVER (PARTITION BY is_click ORDER BY {HASH}) AS rn FROM dedup)
WHERE is_click = 1 OR rn <= (SELECT count(*) FROM dedup WHERE is_click = 1)""", "dedup",
))
def downsample(spark, sf_dir):
    return sample.downsample(fx.clean(spark, sf_dir)).select("session_id", "is_click")


@query("upsample", sql(
    f"""SELECT session_id, is_click FROM dedup WHERE is_click = 0 UNION ALL
SELECT session_id, is_click FROM (SELECT *, row_number() OVER (ORDER BY {HASH}) - 1 AS pick FROM dedup WHERE is_click = 1) m
JOIN (SELECT CAST('0x' || substr(md5(CAST(i AS VARCHAR) || ':42'), 1, 15) AS BIGINT)
        % (SELECT count(*) FROM dedup WHERE is_click = 1) AS pick
      FROM (SELECT unnest(range((SELECT count(*) FROM dedup WHERE is_click = 0))) AS i)) d ON m.pick = d.pick""", "dedup",
))
def upsample(spark, sf_dir):
    return sample.upsample(fx.clean(spark, sf_dir)).select("session_id", "is_click")


@query("shuffle_rows", sql("SELECT * FROM required", "required"))
def shuffle_rows(spark, sf_dir):
    return sample.shuffle_rows(drop_null_required(fx.impressions(spark, sf_dir)))


@query("sample_rows", sql(f"SELECT * FROM required ORDER BY {HASH}, session_id LIMIT 10", "required"))
def sample_rows(spark, sf_dir):
    return sample.sample_rows(drop_null_required(fx.impressions(spark, sf_dir)), 10)


# ---- encoders -------------------------------------------------------------------------------

CODED = [f"{c}_encoding" for c in ENCODED]


def _prepared(spark, sf_dir, **options):
    return jobs.preprocess(fx.impressions(spark, sf_dir), fx.CUTS, **options)


@query("label_encode", sql(f"SELECT session_id, {', '.join(CODED)} FROM encoded", "encoded"))
def label_encode(spark, sf_dir):
    return fx.union_all(list(_prepared(spark, sf_dir))).select("session_id", *CODED)


@query("label_encode_full", sql(f"SELECT session_id, {', '.join(CODED)} FROM encoded_all", "encoded_all"))
def label_encode_full(spark, sf_dir):
    return jobs.encode_all(fx.clean(spark, sf_dir))[0].select("session_id", *CODED)


@query("encode_engineered", sql(
    "SELECT session_id, most_recent_clicked_product_encoding, most_recent_clicked_webpage_encoding FROM encoded", "encoded"
))
def encode_engineered(spark, sf_dir):
    rows = fx.union_all(list(_prepared(spark, sf_dir, engineered=True)))
    return rows.select(
        "session_id", *[f"{c}_encoding" for c in schema.ENGINEERED.values()]
    )


def _mapping(c, dtype):
    return f"SELECT '{c}' AS \"column\", '{dtype}' AS dtype, CAST(v AS VARCHAR) AS label, code FROM t_{c}"


@query("encoder_mapping", sql(" UNION ALL ".join(
    _mapping(c, {"product": "string", "time_of_day": "string", "age_level": "double"}.get(c, "bigint")) for c in ENCODED
), "encoded"))
def encoder_mapping(spark, sf_dir):
    path = scratch_path(spark, "mapping")
    _prepared(spark, sf_dir).encoder.save(path)
    return encode.Encoder.load(spark, path).mapping


@query("ordinal_ctr_encode", sql(
    "SELECT session_id, {} FROM parts".format(", ".join(
        f"(SELECT code FROM (SELECT v, CAST(row_number() OVER (ORDER BY ctr, v) - 1 AS INT) AS code FROM "
        f"(SELECT {c} AS v, sum(is_click) / count(session_id) AS ctr FROM train GROUP BY 1)) m WHERE m.v = parts.{c}) AS {c}_encoding"
        for c in ENCODED
    )), "parts",
))
def ordinal_ctr_encode(spark, sf_dir):
    return fx.union_all(list(_prepared(spark, sf_dir, encoding="ordinal"))).select("session_id", *CODED)


ALL_CODED = [*ENCODED, "gender"]


def _smooth(n, s, q, g, v):
    weight = f"({v} * {n} / ({v} * {n} + ({q} - {s} * {s} / {n}) / {n}))"
    return f"coalesce({weight} * {s} / {n} + (1 - {weight}) * {g}, {g})"


def _target_full():
    rows = []
    for c in ALL_CODED:
        rows.append(
            f"(SELECT round({_smooth('n', 's', 'q', 'g', 'v')}, 6) FROM (SELECT {c} AS label, "
            f"CAST(count(*) AS DOUBLE) AS n, CAST(sum(is_click) AS DOUBLE) AS s, CAST(sum(is_click * is_click) AS DOUBLE) AS q "
            f"FROM train GROUP BY 1), (SELECT avg(is_click) AS g, var_pop(is_click) AS v FROM train) "
            f"WHERE label = parts.{c}) AS {c}_encoding"
        )
    return f"SELECT session_id, {', '.join(rows)} FROM parts WHERE split <> 'train'"


@query("target_encode", sql(_target_full(), "parts"))
def target_encode(spark, sf_dir):
    _, validation, test = _prepared(spark, sf_dir, encoding="target")
    rows = validation.unionByName(test).select("session_id", *[f"{c}_encoding" for c in ALL_CODED])
    return fx.rounded(rows)


def _target_folds():
    tables, joins, picks = [], [], []
    for i, c in enumerate(ALL_CODED):
        tables.append(
            f"f{i} AS (SELECT f.fold, t.{c} AS label, CAST(count(*) AS DOUBLE) AS n, CAST(sum(is_click) AS DOUBLE) AS s, "
            f"CAST(sum(is_click * is_click) AS DOUBLE) AS q FROM folds f JOIN train t ON t.session_id % 5 <> f.fold GROUP BY 1, 2)"
        )
        joins.append(f"LEFT JOIN f{i} ON f{i}.fold = x.session_id % 5 AND f{i}.label = x.{c}")
        code = _smooth(f"f{i}.n", f"f{i}.s", f"f{i}.q", "g.g", "g.v")
        picks.append(f"round({code}, 6) AS {c}_encoding")
    return (
        "SELECT * FROM (WITH folds AS (SELECT unnest(range(5)) AS fold), " + ", ".join(tables)
        + ", g AS (SELECT f.fold, avg(is_click) AS g, var_pop(is_click) AS v FROM folds f JOIN train t ON t.session_id % 5 <> f.fold GROUP BY 1) "
        + f"SELECT x.session_id, {', '.join(picks)} FROM train x JOIN g ON g.fold = x.session_id % 5 {' '.join(joins)})"
    )


@query("target_encode_crossfit", sql(_target_folds(), "parts"))
def target_encode_crossfit(spark, sf_dir):
    train = _prepared(spark, sf_dir, encoding="target").train
    return fx.rounded(train.select("session_id", *[f"{c}_encoding" for c in ALL_CODED]))


# ---- models, scoring, metrics ---------------------------------------------------------------

def _model_prediction(spark, sf_dir, fit):
    prepared = _prepared(spark, sf_dir)
    train, _, _ = jobs.matrices(prepared)
    rows = prepared.validation.select("session_id", *schema.FEATURES)
    fitted = fit(stage(train, "train"))
    return model.predict(fitted, rows).select("session_id", "is_click", "probability", "prediction")


@query("lr_predict")
def lr_predict(spark, sf_dir):
    return _model_prediction_for(spark, sf_dir, model.fit_logistic)


@query("rf_predict")
def rf_predict(spark, sf_dir):
    return _model_prediction_for(spark, sf_dir, partial(model.fit_forest, trees=20, max_depth=6))


SMALL_BOOSTING = partial(model.fit_boosted, rounds=5, max_depth=4, step=0.1)


@query("gbt_predict")
def gbt_predict(spark, sf_dir):
    return _model_prediction_for(spark, sf_dir, SMALL_BOOSTING)


def _model_prediction_for(spark, sf_dir, fit):
    return fx.rounded(_model_prediction(spark, sf_dir, fit))


@query("batch_score")
def batch_score(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    train, validation, test = jobs.matrices(prepared)
    fitted = model.fit_logistic(stage(train, "train"))
    return fx.rounded(model.score(fitted, validation.unionByName(test)))


REQUEST_MATRIX = "batch_id, position, user_id, {}, most_recent_clicked_product_encoding".format(
    ", ".join(FEATURES)
)


def _scoring_inputs(spark, sf_dir, **options):
    rows, encoder = jobs.transactions(fx.impressions(spark, sf_dir), **options)
    return rows, encoder, customer_profile(rows)


@query("score_requests_features", sql(f"SELECT {REQUEST_MATRIX} FROM request_features", "request_features"))
def score_requests_features(spark, sf_dir):
    _, encoder, customers = _scoring_inputs(spark, sf_dir)
    return scoring.request_features(fx.request_batches(spark, sf_dir), encoder, customers)


@query("score_requests")
def score_requests(spark, sf_dir):
    rows, encoder, customers = _scoring_inputs(spark, sf_dir)
    fitted = model.fit_logistic(schema.project(rows, schema.FEATURES_ENGINEERED))
    features = scoring.request_features(fx.request_batches(spark, sf_dir), encoder, customers)
    scored = scoring.score_requests(features, fitted, threshold=0.2)
    return fx.rounded(scored).select("batch_id", "position", "user_id", "probability", "prediction", "label")


# Models of one column have a closed form in SQL: boosting a recursion per label, since trees that are deep enough give each label a leaf of
# its own, logistic regression Newton's steps for two numbers. Classification trees join neighbouring leaves of the same class: a forest
# without bootstrap predicts the class of the label's mean, and its probability is that mean where a split in two is all there is.

def group_matrix(df, column="product_encoding"):
    return df.select("is_click", column)


def _boosting_sql(groups, rounds, step):
    """Probability ``p`` per ``g`` after boosting; ``groups`` has g and the mean m of is_click."""
    pull = "m * 4 / (1 + exp(2 * f)) - (1 - m) * 4 / (1 + exp(-2 * f))"
    return (f"WITH RECURSIVE groups AS ({groups}), margins AS (SELECT g, m, 2 * m - 1 AS f, 1 AS i FROM groups UNION ALL "
            f"SELECT g, m, f + {step} * ({pull}), i + 1 FROM margins WHERE i < {rounds}) "
            f"SELECT g, 1 / (1 + exp(-2 * f)) AS p FROM margins WHERE i = {rounds}")


def _logistic_sql(groups, steps=30):
    """Probability ``p`` per ``g`` of a penalised logistic regression on g; ``groups`` has g, rows n and clicks k."""
    p, x = "1 / (1 + exp(-(b + w * g)))", "n * p * (1 - p)"
    return f"""WITH RECURSIVE groups AS ({groups}), newton AS (SELECT 0 AS i, 0.0::DOUBLE AS b, 0.0::DOUBLE AS w UNION ALL
  SELECT i + 1, b - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), w - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT i, b, w, sum(n * p - k) AS g1, sum((n * p - k) * g) + w AS g2, sum({x}) AS h11, sum({x} * g) AS h12, sum({x} * g * g) + 1 AS h22
    FROM (SELECT *, {p} AS p FROM newton, groups WHERE i < {steps}) GROUP BY i, b, w))
SELECT g, {p} AS p FROM newton, groups WHERE i = {steps}"""


_BALANCED = (f"(SELECT *, row_number() OVER (PARTITION BY is_click ORDER BY {HASH}) AS rn FROM encoded WHERE split = 'train') "
             "WHERE is_click = 1 OR rn <= (SELECT count(*) FROM train WHERE is_click = 1) GROUP BY 1")
_TRAIN_MEANS = f"SELECT product_encoding AS g, avg(is_click) AS m FROM {_BALANCED}"
_TRAIN_COUNTS = f"SELECT product_encoding AS g, count(*)::DOUBLE AS n, sum(is_click)::DOUBLE AS k FROM {_BALANCED}"


def _group_oracle(model_sql, split="= 'validation'"):
    return sql(
        f"SELECT session_id, is_click, round(p, 6) AS probability, CAST(p > 0.5 AS INT) AS prediction FROM encoded JOIN ({model_sql}) "
        f"ON g = product_encoding WHERE split {split}", "encoded")


def _group_prediction(spark, sf_dir, fit):
    return fx.rounded(_model_prediction(spark, sf_dir, lambda train: fit(group_matrix(train))))


@query("lr_predict_groups", _group_oracle(_logistic_sql(_TRAIN_COUNTS)))
def lr_predict_groups(spark, sf_dir):
    return _group_prediction(spark, sf_dir, partial(model.fit_logistic, tol=1e-13, max_iter=500))


@query("rf_predict_groups", sql(
    "SELECT session_id, is_click, round(s.m, 6) AS probability, CAST(t.m > 0.5 AS INT) AS prediction FROM encoded e "
    f"JOIN ({_TRAIN_MEANS}) t ON t.g = e.product_encoding JOIN ({_TRAIN_MEANS.replace('product_encoding', 'gender_encoding')}) s "
    "ON s.g = e.gender_encoding WHERE split = 'validation'", "encoded",
))
def rf_predict_groups(spark, sf_dir):
    """The whole forest of 500 trees of depth 10: classes by product, probabilities by gender (balanced rows split into both classes)."""
    prepared = _prepared(spark, sf_dir)
    train = stage(jobs.matrices(prepared)[0], "train")
    fits = [model.fit_forest(group_matrix(train, c), bootstrap=False) for c in ("product_encoding", "gender_encoding")]
    rows = prepared.validation.select("session_id", *schema.FEATURES)
    classes = model.predict(fits[0], rows).drop("probability")
    return fx.rounded(model.score(fits[1], classes).select("session_id", "is_click", "probability", "prediction"))


GROUP_ROUNDS = 12
SHORT_BOOSTING = partial(model.fit_boosted, rounds=3, step=0.1, subsample=1.0, min_rows=1)


@query("gbt_predict_groups", _group_oracle(_boosting_sql(_TRAIN_MEANS, GROUP_ROUNDS, 0.1)))
def gbt_predict_groups(spark, sf_dir):
    """Trees of depth 10, in two blocks, of which the second goes on from the saved model of the first."""
    fit = boosting_at(scratch_path(spark, "boosting"), rounds=GROUP_ROUNDS, block=7, step=0.1, subsample=1.0, min_rows=1)
    return _group_prediction(spark, sf_dir, fit)


@query("batch_score_groups", sql(
    f"SELECT {', '.join(['is_click', *FEATURES])}, round(p, 6) AS probability FROM encoded "
    f"JOIN ({_boosting_sql(_TRAIN_MEANS, 3, 0.1)}) ON g = product_encoding WHERE split <> 'train'", "encoded",
))
def batch_score_groups(spark, sf_dir):
    train, validation, test = jobs.matrices(_prepared(spark, sf_dir))
    fitted = SHORT_BOOSTING(group_matrix(stage(train, "train")))
    return fx.rounded(model.score(fitted, validation.unionByName(test)))


_KNOWN = " AND ".join(f"r.{c} IS NOT NULL" for c in [*FEATURES, "most_recent_clicked_product_encoding"])


@query("score_requests_groups", sql(
    f"SELECT batch_id, position, user_id, CASE WHEN {_KNOWN} THEN round(p, 6) END AS probability, "
    f"CASE WHEN {_KNOWN} THEN CAST(p > 0.2 AS INT) END AS prediction, "
    f"CASE WHEN {_KNOWN} THEN CASE WHEN p > 0.2 THEN 'Clicked' ELSE 'Not Clicked' END END AS label FROM request_features r LEFT JOIN "
    f"({_boosting_sql('SELECT product_encoding AS g, avg(is_click) AS m FROM encoded_all GROUP BY 1', 3, 0.1)}) ON g = r.product_encoding", "request_features",
))
def score_requests_groups(spark, sf_dir):
    rows, encoder, customers = _scoring_inputs(spark, sf_dir)
    fitted = SHORT_BOOSTING(group_matrix(stage(rows, "rows")))
    features = scoring.request_features(fx.request_batches(spark, sf_dir), encoder, customers)
    scored = fx.rounded(scoring.score_requests(features, fitted, threshold=0.2))
    return scored.select("batch_id", "position", "user_id", "probability", "prediction", "label")


@query("score_approved", sql(
    f"SELECT {REQUEST_MATRIX}, {' AND '.join(c + ' IS NOT NULL' for c in REQUEST_MATRIX.split(', ')[3:])} AS scored FROM request_features",
    "request_features",
))
def score_approved(spark, sf_dir):
    """Trained, gated, registered and approved; then scored with what is on disk. A row is scored if all its codes are known."""
    out, log = scratch_path(spark, "train"), fx.impressions(spark, sf_dir)
    clean = jobs.staged_clean(log)
    rolling = jobs.staged_rolling(log, clean=clean)
    jobs.train_evaluate(log, out, fx.CUTS, fit=model.fit_logistic, threshold=0.0, engineered=True, rolling=rolling)
    known = registry.read_registry(spark, f"{out}/registry")
    registry.set_status(known, f"{out}/registry", "ctr", 1, registry.APPROVED, F.lit("2999-01-01"))
    _, _, customers = _scoring_inputs(spark, sf_dir, rolling=rolling)
    scored = jobs.score_approved(fx.request_batches(spark, sf_dir, clean), customers, out)
    return scored.select(*REQUEST_MATRIX.split(", "), F.col("probability").isNotNull().alias("scored"))


@query("confusion_matrix", sql(
    "SELECT 0 AS actual, CAST(tn AS BIGINT) AS predicted_0, CAST(fp AS BIGINT) AS predicted_1 FROM cells UNION ALL "
    "SELECT 1, CAST(fn AS BIGINT), CAST(tp AS BIGINT) FROM cells", "predictions",
))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(fx.predictions(fx.clean(spark, sf_dir)))


def _report():
    def ratio(a, b):
        return f"coalesce(({a}) / nullif({b}, 0), 0)"

    inner = ", ".join([
        "tn + fp AS s0", "fn + tp AS s1", "tn + fp + fn + tp AS s", f"{ratio('tn', 'tn + fn')} AS p0",
        f"{ratio('tn', 'tn + fp')} AS r0", f"{ratio('2 * tn', '2 * tn + fn + fp')} AS f0",
        f"{ratio('tp', 'tp + fp')} AS p1", f"{ratio('tp', 'tp + fn')} AS r1",
        f"{ratio('2 * tp', '2 * tp + fp + fn')} AS f1", f"{ratio('tp + tn', 'tn + fp + fn + tp')} AS acc",
    ])
    lines = [
        ("0", "p0", "r0", "f0", "s0"), ("1", "p1", "r1", "f1", "s1"),
        ("accuracy", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "acc", "s"),
        ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s"),
        ("weighted avg", *[f"coalesce(({x}0 * s0 + {x}1 * s1) / nullif(s, 0), 0)" for x in "prf"], "s"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1_score, "
        f"CAST({s} AS BIGINT) AS support FROM (SELECT *, {inner} FROM cells)" for n, p, r, f, s in lines
    )


@query("classification_report", sql(_report(), "predictions"))
def classification_report(spark, sf_dir):
    return fx.rounded(metrics.classification_report(fx.predictions(fx.clean(spark, sf_dir))))


@query("f1_score", sql(
    "SELECT round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score FROM cells", "predictions"
))
def f1_score(spark, sf_dir):
    return fx.rounded(metrics.f1_score(fx.predictions(fx.clean(spark, sf_dir))))


# ---- streams --------------------------------------------------------------------------------

def _stream_of(df, spark, *by, files=8, per_trigger=4):
    """The frame as a stream of micro-batches; rows arrive in no particular time order."""
    path = scratch_path(spark, "stream-in")
    df.repartition(files, *by).write.parquet(path)
    return streams.read_stream(spark, path, df.schema, per_trigger)


@query("stream_feature_ingest", sql(
    f"SELECT session_id, user_id, product, is_click, {ISO.format(t='DateTime')} AS event_time, "
    "CAST(DateTime AS DATE) AS event_date FROM clean", "clean",
))
def stream_feature_ingest(spark, sf_dir):
    rows = fx.events_with_time(fx.clean(spark, sf_dir)).select(
        "session_id", "user_id", "product", "is_click", "event_time"
    )
    out = scratch_path(spark, "stream-out")
    streams.stream_ingest(_stream_of(rows, spark, "session_id"), out, f"{out}-checkpoint").awaitTermination()
    return ft.read_features(spark, out)


@query("stream_latest_per_key", sql(
    f"SELECT * EXCLUDE (rn) FROM (SELECT user_id, session_id, product, webpage_id, {ISO.format(t='DateTime')} AS event_time, "
    "row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('millisecond', DateTime) DESC, session_id DESC) AS rn FROM clean) "
    "WHERE rn = 1", "clean",
))
def stream_latest_per_key(spark, sf_dir):
    rows = fx.events_with_time(fx.clean(spark, sf_dir)).select(
        "user_id", "session_id", "product", "webpage_id", "event_time"
    )
    out = scratch_path(spark, "stream-out")
    source = _stream_of(rows, spark, "session_id")
    streams.stream_latest(source, out, f"{out}-checkpoint", "user_id", then=["session_id"], every_seconds=1)
    return snapshot.read_latest(spark, out, "user_id").drop("event_date")


@query("stream_score_features", sql(f"SELECT {REQUEST_MATRIX} FROM request_features", "request_features"))
def stream_score_features(spark, sf_dir):
    _, encoder, customers = _scoring_inputs(spark, sf_dir)
    out = scratch_path(spark, "stream-out")
    path = scratch_path(spark, "customers")
    customers.write.parquet(path)
    source = _stream_of(fx.request_batches(spark, sf_dir), spark, "batch_id")
    streams.stream_request_features(
        source, encoder, spark.read.parquet(path), out, f"{out}-checkpoint"
    ).awaitTermination()
    return spark.read.parquet(out)


@query("stream_scores", sql(
    f"SELECT {REQUEST_MATRIX}, {' AND '.join(c + ' IS NOT NULL' for c in REQUEST_MATRIX.split(', ')[3:])} AS scored, "
    "CAST('0x' || substr(md5(CAST(batch_id AS VARCHAR) || ':42'), 1, 15) AS BIGINT) % 100 < 80 AS logged FROM request_features",
    "request_features",
))
def stream_scores(spark, sf_dir):
    """All request rows scored by a stream, with the requests to log marked. A row is scored if all its codes are known."""
    rows, encoder, customers = _scoring_inputs(spark, sf_dir)
    out, path = scratch_path(spark, "stream-out"), scratch_path(spark, "customers")
    customers.write.parquet(path)
    fitted = model.fit_logistic(schema.project(rows, schema.FEATURES_ENGINEERED))
    source = _stream_of(fx.request_batches(spark, sf_dir), spark, "batch_id")
    streams.stream_scores(
        source, encoder, spark.read.parquet(path), fitted, out, f"{out}-checkpoint", log_percent=CAPTURE_PERCENT["prod"]
    ).awaitTermination()
    scored = F.col("probability").isNotNull()
    return spark.read.parquet(out).select(*REQUEST_MATRIX.split(", "), scored.alias("scored"), "logged")


UNFIT = "session_id % 23 = 0"


def _sent_twice(spark, sf_dir):
    """A verified stream of rows as texts, each sent twice; every 23rd has a click that is no number."""
    rows = fx.events_with_time(fx.clean(spark, sf_dir)).select("session_id", "user_id", "product", "is_click", "event_time")
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]).withColumn(
        "is_click", F.expr(f"IF({UNFIT}, 'yes', is_click)"))
    out = scratch_path(spark, "stream-out")
    definitions = {"session_id": "Integral", "user_id": "Integral", "product": "String", "is_click": "Integral"}
    streams.stream_verified_ingest(
        _stream_of(texts.unionAll(texts), spark), out, f"{out}-checkpoint", definitions, "session_id"
    ).awaitTermination()
    return out


@query("stream_verified_ingest", sql(
    f"SELECT session_id, user_id, product, CAST(is_click AS BIGINT) AS is_click, {ISO.format(t='DateTime')} AS event_time, "
    f"CAST(DateTime AS DATE) AS event_date FROM clean WHERE NOT ({UNFIT})", "clean",
))
def stream_verified_ingest(spark, sf_dir):
    return ft.read_features(spark, _sent_twice(spark, sf_dir))


@query("stream_rejects", sql(
    "SELECT CAST(session_id AS VARCHAR) AS session_id, 'yes' AS is_click, CAST(DateTime AS DATE) AS event_date "
    f"FROM clean WHERE {UNFIT}", "clean",
))
def stream_rejects(spark, sf_dir):
    found = ft.read_stream_rejects(spark, _sent_twice(spark, sf_dir))
    return found.select(*[F.get_json_object(ft.RECORD, f"$.{c}").alias(c) for c in ("session_id", "is_click")], "event_date")


# ---- jobs -----------------------------------------------------------------------------------

TARGET_FIRST = ", ".join(["is_click", *FEATURES])


def _part(name):
    def run(spark, sf_dir):
        out = scratch_path(spark, "preprocess")
        jobs.preprocess_to_files(fx.impressions(spark, sf_dir), out, fx.CUTS)
        return read_matrix(spark, f"{out}/{name}", schema.FEATURES[1:])

    return run


query("preprocess_train", sql(
    f"""SELECT {TARGET_FIRST} FROM (SELECT *, row_number() OVER (PARTITION BY is_click ORDER BY {HASH}) AS rn
FROM encoded WHERE split = 'train') WHERE is_click = 1 OR rn <= (SELECT count(*) FROM train WHERE is_click = 1)""", "encoded",
))(_part("train"))
query("preprocess_validation", sql(
    f"SELECT {TARGET_FIRST} FROM encoded WHERE split = 'validation'", "encoded"
))(_part("validation"))
query("preprocess_test", sql(
    f"SELECT {TARGET_FIRST} FROM encoded WHERE split = 'test'", "encoded"
))(_part("test"))


@query("feature_matrix_engineered", sql(
    f"SELECT {TARGET_FIRST}, most_recent_clicked_product_encoding FROM encoded", "encoded"
))
def feature_matrix_engineered(spark, sf_dir):
    rows = fx.union_all(list(_prepared(spark, sf_dir, engineered=True)))
    return schema.project(rows, schema.FEATURES_ENGINEERED)


def _ingested(spark, sf_dir):
    out = scratch_path(spark, "ingest")
    jobs.ingest_features(
        fx.impressions(spark, sf_dir), f"{out}/transactions", f"{out}/customers", fx.LOAD_1
    )
    return out


STORED = ", ".join([
    "session_id", "user_id", "product", "hour", "time_of_day", "is_click", "most_recent_clicked_product",
    "most_recent_clicked_webpage", "gender_encoding", *CODED, "most_recent_clicked_product_encoding",
    "most_recent_clicked_webpage_encoding",
])


def _bigint(columns, table):
    """The store keeps whole numbers as bigint."""
    whole = {"hour", "is_click"}
    return "SELECT {} FROM {}".format(", ".join(
        f"CAST({c} AS BIGINT) AS {c}" if c.endswith("_encoding") or c in whole else c
        for c in columns.split(", ")
    ), table)


@query("ingest_transactions", sql(
    f"SELECT *, '{fx.LOAD_1}' AS event_time, DATE '2024-02-01' AS event_date FROM ({_bigint(STORED, 'encoded_all')})", "encoded_all"
))
def ingest_transactions(spark, sf_dir):
    table = ft.read_features(spark, f"{_ingested(spark, sf_dir)}/transactions")
    return table.select(*STORED.split(", "), "event_time", "event_date")


def _extended(code, of):
    """The code of a column of products, where one product came after all others."""
    return (f"CAST(CASE WHEN {of} = 'C' THEN (SELECT count(DISTINCT product) - 1 FROM encoded_all) WHEN {of} > 'C' THEN {code} - 1 "
            f"ELSE {code} END AS BIGINT) AS {code}")


@query("ingest_new_labels", sql(
    "SELECT session_id, product, {}, {}, webpage_id_encoding::BIGINT AS webpage_id_encoding FROM encoded_all".format(
        _extended("product_encoding", "product"), _extended("most_recent_clicked_product_encoding", "most_recent_clicked_product")),
    "encoded_all",
))
def ingest_new_labels(spark, sf_dir):
    """A load with a product that the saved encoder has never seen: old codes stay, the new product gets the next one."""
    out, rows = scratch_path(spark, "ingest"), fx.impressions(spark, sf_dir)
    encode.fit_label(jobs.prepare(rows).where("product <> 'C'"), schema.ENCODED).save(f"{out}/codes")
    encoder = encode.Encoder.load(spark, f"{out}/codes")
    jobs.ingest_features(rows, f"{out}/transactions", f"{out}/customers", fx.LOAD_1, encoder, on_unseen="extend")
    return ft.read_features(spark, f"{out}/transactions").select(
        "session_id", "product", "product_encoding", "most_recent_clicked_product_encoding", "webpage_id_encoding")


PROFILE = "user_id, gender_encoding, age_level_encoding, most_recent_clicked_product_encoding, most_recent_clicked_webpage_encoding"


@query("ingest_customers", sql(
    f"SELECT *, '{fx.LOAD_1}' AS event_time, DATE '2024-02-01' AS event_date FROM ({_bigint(PROFILE, 'customers')})", "encoded_all"
))
def ingest_customers(spark, sf_dir):
    return ft.read_features(spark, f"{_ingested(spark, sf_dir)}/customers")


@query("fs_transactions", sql(
    "SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id, product, time_of_day, is_click, "
    "most_recent_clicked_product, most_recent_clicked_webpage, product_encoding, most_recent_clicked_product_encoding, "
    f"most_recent_clicked_webpage_encoding, '{fx.LOAD_1}' AS event_time, DATE '2024-02-01' AS event_date "
    "FROM encoded WHERE split = 'train'", "encoded",
))
def fs_transactions(spark, sf_dir):
    path = scratch_path(spark, "store")
    rows, _ = jobs.feature_store_frames(fx.impressions(spark, sf_dir), fx.LOAD_1, fx.CUTS)
    ft.append_features(rows, path)
    return ft.read_features(spark, path).select(
        "session_id", "user_id", "product", "time_of_day", "is_click", "most_recent_clicked_product",
        "most_recent_clicked_webpage", "product_encoding", "most_recent_clicked_product_encoding",
        "most_recent_clicked_webpage_encoding", "event_time", "event_date",
    )


@query("train_evaluate")
def train_evaluate(spark, sf_dir):
    out = scratch_path(spark, "train")
    return fx.rounded(jobs.train_evaluate(
        fx.impressions(spark, sf_dir), out, fx.CUTS, fit=SMALL_BOOSTING
    ))


@query("train_evaluate_groups", sql(
    f"""SELECT round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score FROM (
SELECT sum(CAST(is_click = 1 AND m >= 0.5 AS INT)) AS tp, sum(CAST(is_click = 0 AND m >= 0.5 AS INT)) AS fp,
  sum(CAST(is_click = 1 AND m < 0.5 AS INT)) AS fn
FROM encoded JOIN ({_TRAIN_MEANS})
  ON g = product_encoding WHERE split = 'test')""", "encoded",
))
def train_evaluate_groups(spark, sf_dir):
    """Training to report with a model that SQL can express; it is saved with its encoder and registered."""
    return fx.rounded(jobs.train_evaluate(
        fx.impressions(spark, sf_dir), scratch_path(spark, "train"), fx.CUTS, threshold=0.0,
        fit=lambda train: model.fit_forest(group_matrix(train), trees=3, bootstrap=False),
    ))


@query("explore_summary", sql(
    "SELECT min(DateTime) AS earliest, max(DateTime) AS latest, count(DISTINCT user_id) AS users, "
    "CAST(sum(is_click) AS BIGINT) AS clicks, round(sum(is_click) / count(is_click), 6) AS ctr FROM impressions"
))
def explore_summary(spark, sf_dir):
    return fx.rounded(explore.summary(fx.impressions(spark, sf_dir)))
