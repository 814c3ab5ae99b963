import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from ctrflow.operators import boosting, metrics, model
from tests.conftest import table


@pytest.fixture(scope="module")
def points(spark):
    """A noisy rule on two small codes."""
    x, z = F.col("id") % 7, F.floor(F.col("id") / 7) % 3
    y = ((x > 3) | ((z == 2) & (F.col("id") % 5 == 0))).cast("int")
    return spark.range(2_000).select(y.alias("is_click"), x.alias("x"), z.alias("z")).cache()


def accuracy(df):
    return df.agg(F.avg((F.col("is_click") == F.col("prediction")).cast("double"))).first()[0]


@pytest.mark.parametrize("fit", [
    model.fit_logistic, lambda df: model.fit_forest(df, trees=5), lambda df: model.fit_boosted(df, rounds=3, max_depth=3, step=0.3),
])
def test_models_learn_and_score(points, fit):
    out = model.predict(fit(points), points)
    assert out.columns == ["is_click", "x", "z", "probability", "prediction"]
    assert out.where("probability < 0 OR probability > 1").isEmpty()
    assert accuracy(out) > 0.9


def test_logistic_penalty_is_that_of_a_summed_loss(points):
    # Gradient of sum(log loss) + |w|^2 / 2 vanishes at the solution (no penalty on the intercept).
    fitted = model.fit_logistic(points.select("is_click", "x"), max_iter=500, tol=1e-12)
    weight = fitted.stages[-1].coefficients[0]
    scored = model.score(fitted, points.select("is_click", "x"))
    gradient = scored.agg(F.sum((F.col("probability") - F.col("is_click")) * F.col("x"))).first()[0]
    assert gradient + weight == pytest.approx(0, abs=1e-4)


def predictions(spark, *pairs):
    return spark.createDataFrame([p for p in pairs] or [], "is_click int, prediction int")


def test_confusion_matrix_is_always_two_by_two(spark):
    df = predictions(spark, (1, 1), (1, 0), (0, 1), (0, 1))
    assert table(metrics.confusion_matrix(df), "actual") == [(0, 0, 2), (1, 1, 1)]
    assert table(metrics.confusion_matrix(predictions(spark)), "actual") == [(0, 0, 0), (1, 0, 0)]


def test_report_by_hand(spark):
    df = predictions(spark, (1, 1), (1, 1), (1, 0), (0, 1), (0, 0), (0, 0), (0, 0))
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support) for r in metrics.classification_report(df).collect()}
    assert got["0"] == pytest.approx((3 / 4, 3 / 4, 3 / 4, 4))
    assert got["1"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert got["accuracy"] == (None, None, pytest.approx(5 / 7), 7)
    assert got["macro avg"] == pytest.approx(((3 / 4 + 2 / 3) / 2,) * 3 + (7,))
    assert got["weighted avg"] == pytest.approx((5 / 7,) * 3 + (7,))
    assert metrics.f1_score(df).first().f1_score == pytest.approx(2 / 3)


def test_nothing_predicted_scores_zero(spark):
    df = predictions(spark, (1, 0), (0, 0))
    got = {r["class"]: (r.precision, r.recall, r.f1_score) for r in metrics.classification_report(df).collect()}
    assert got["1"] == (0.0, 0.0, 0.0)
    assert metrics.f1_score(df).first().f1_score == 0.0
    assert metrics.f1_score(predictions(spark)).first().f1_score == 0.0


BOOSTING = dict(max_depth=3, step=0.3, min_rows=1, subsample=1.0)


def probabilities(fitted, df):
    return [r.probability for r in model.score(fitted, df).orderBy("x", "z", "is_click").collect()]


def test_blocks_give_the_model_of_one_run(points, tmp_path):
    whole = probabilities(model.fit_boosted(points, rounds=5, **BOOSTING), points)
    blocks = boosting.fit_boosted_blocks(points, str(tmp_path / "a"), rounds=5, block=2, **BOOSTING)
    assert probabilities(blocks, points) == pytest.approx(whole, abs=1e-9)


def test_an_ended_job_goes_on_from_its_last_block(points, tmp_path, monkeypatch):
    options = BOOSTING | {"subsample": 0.6}
    whole = boosting.fit_boosted_blocks(points, str(tmp_path / "a"), rounds=6, block=6, **options)
    path, fitted, fit = str(tmp_path / "b"), [], boosting.DecisionTreeRegressor.fit

    def failing(self, df):
        fitted.append(self.getSeed())
        if len(fitted) == 4:
            raise RuntimeError("lost")
        return fit(self, df)

    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", failing)
    with pytest.raises(RuntimeError, match="lost"):
        boosting.fit_boosted_blocks(points, path, rounds=6, block=2, **options)
    again = boosting.fit_boosted_blocks(points, path, rounds=6, block=2, **options)
    # Rounds 0 to 2 and the start of 3, then only what its last saved block lacks.
    assert [s - 42 for s in fitted] == [0, 1, 2, 3, 2, 3, 4, 5]
    assert probabilities(again, points) == pytest.approx(probabilities(whole, points), abs=1e-9)


def test_more_rounds_continue_a_saved_model_and_other_parameters_raise(points, tmp_path):
    path = str(tmp_path / "a")
    boosting.fit_boosted_blocks(points, path, rounds=2, **BOOSTING)
    more = boosting.fit_boosted_blocks(points, path, rounds=4, **BOOSTING)
    once = boosting.fit_boosted_blocks(points, str(tmp_path / "b"), rounds=4, **BOOSTING)
    assert probabilities(more, points) == pytest.approx(probabilities(once, points), abs=1e-9)
    with pytest.raises(ValueError, match="begun with"):
        boosting.fit_boosted_blocks(points, path, rounds=4, **BOOSTING | {"step": 0.1})
    with pytest.raises(ValueError, match="more than"):
        boosting.fit_boosted_blocks(points, path, rounds=3, **BOOSTING)


def test_blocks_are_saved_as_an_ordinary_model(points, tmp_path):
    fitted = boosting.fit_boosted_blocks(points, str(tmp_path / "a"), rounds=2, **BOOSTING)
    fitted.write().save(str(tmp_path / "saved"))
    again = type(fitted).load(str(tmp_path / "saved"))
    assert isinstance(again.stages[-1], GBTClassificationModel)
    assert probabilities(again, points) == pytest.approx(probabilities(fitted, points), abs=0)


def test_a_forest_without_bootstrap_gives_the_mean_of_each_side(points):
    rows = points.select("is_click", (F.col("x") > 3).cast("int").alias("side"))
    scored = model.score(model.fit_forest(rows, trees=3, bootstrap=False), rows)
    means = scored.groupBy("side").agg(F.avg("is_click").alias("mean"), F.max("probability").alias("p"), F.min("probability").alias("q"))
    assert all(r.p == pytest.approx(r["mean"]) and r.q == pytest.approx(r["mean"]) for r in means.collect())


def test_a_forest_without_bootstrap_takes_equal_rows_once_and_gives_the_trees_of_all(points, monkeypatch):
    df = points.withColumnRenamed("z", "_weight")
    plain = model._fit(df, model.RandomForestClassifier(
        **model._roles("is_click"), numTrees=7, maxDepth=4, seed=42, bootstrap=False), "is_click")
    given, fit = [], model.RandomForestClassifier.fit

    def counted(self, rows):
        given.append(rows.count())
        return fit(self, rows)

    monkeypatch.setattr(model.RandomForestClassifier, "fit", counted)
    fitted = model.fit_forest(df, trees=7, max_depth=4, bootstrap=False)
    assert given == [df.distinct().count()]
    texts = [[t.toDebugString.partition("\n")[2] for t in m.stages[-1].trees] for m in (fitted, plain)]
    assert texts[0] == texts[1] and len(texts[0]) == 7
    scores = [[r.probability for r in model.score(m, df).orderBy("x", "_weight", "is_click").collect()] for m in (fitted, plain)]
    assert scores[0] == scores[1]
    # Each row of a bootstrap is drawn for itself.
    model.fit_forest(df, trees=2, max_depth=2)
    assert given[1:] == [2_000]
