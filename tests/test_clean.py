import math

import pytest
from pyspark.sql import functions as F

from ctrflow.operators import clean, impute
from tests.conftest import executed, plan, same, table


def test_rows_without_a_required_field_drop(rows_of):
    df = rows_of({}, {"session_id": None}, {"DateTime": None}, {"user_id": None}, {"is_click": None}, {"gender": None})
    assert table(clean.drop_null_required(df).select("gender"), "gender") == [(None,), ("Male",)]


def test_required_filter_reaches_the_scan(raw, spark, tmp_path):
    raw.write.parquet(str(tmp_path / "t"))
    df = clean.drop_null_required(spark.read.parquet(str(tmp_path / "t"))).select("session_id")
    assert "PushedFilters: [IsNotNull(session_id), IsNotNull(DateTime), IsNotNull(user_id), IsNotNull(is_click)]" in plan(df)
    assert "ReadSchema: struct<session_id:bigint,DateTime:timestamp_ntz,user_id:bigint,is_click:int>" in plan(df)


def test_lowest_session_survives_and_nulls_are_equal(rows_of):
    df = rows_of(
        {"session_id": 7, "product": None}, {"session_id": 3, "product": None},
        {"session_id": 9, "product": "A"}, {"session_id": 4, "product": "A", "age_level": None},
        {"session_id": 2, "product": "A", "age_level": None},
    )
    assert table(clean.dedup_impressions(df).select("session_id", "product"), "session_id") == [
        (2, "A"), (3, None), (9, "A")]


def test_dedup_keeps_further_columns_of_the_survivor(rows_of):
    df = rows_of({"session_id": 5}, {"session_id": 4}).withColumn("note", F.concat(F.lit("s"), "session_id"))
    out = clean.dedup_impressions(df)
    assert out.columns == df.columns
    assert table(out.select("session_id", "note")) == [(4, "s4")]


def test_dedup_combines_copies_before_the_shuffle(raw):
    text = executed(clean.dedup_impressions(clean.drop_null_required(raw)))
    assert "partial_min(session_id" in text and "Window" not in text


def test_nan_counts_as_missing(rows_of):
    df = rows_of({"age_level": math.nan}, {"age_level": 2.0, "DateTime": 1}, {"age_level": 4.0, "DateTime": 2})
    out = impute.impute(clean.clean_rows(df)).orderBy("session_id")
    assert [r.age_level for r in out.collect()] == [3.0, 2.0, 4.0]


def test_mode_ties_go_to_the_lowest_value(rows_of):
    df = rows_of({"product": "B"}, {"product": "A"}, {"product": None}, {"product": "B"}, {"product": "A"}, {"product": "C"})
    assert impute.column_modes(df, ["product"]) == {"product": "A"}
    assert impute.fit_imputer(df).fills == {"product": "A"}


def test_median_of_an_even_number_is_the_midpoint(rows_of):
    df = rows_of(*[{"user_depth": v} for v in (4.0, 1.0, None, 2.0, 10.0)])
    assert impute.fit_imputer(df).fills == {"user_depth": 3.0}
    assert impute.column_medians(df, ["user_depth"]) == {"user_depth": 3.0}


def test_whole_column_with_a_fractional_median_becomes_fractional(rows_of):
    df = rows_of({"webpage_id": 1}, {"webpage_id": 2}, {"webpage_id": None})
    out = impute.impute(df)
    assert dict(out.dtypes)["webpage_id"] == "double"
    assert table(out.select("webpage_id"), "webpage_id") == [(1.0,), (1.5,), (2.0,)]
    whole = impute.impute(rows_of({"webpage_id": 1}, {"webpage_id": 3}, {"webpage_id": None}))
    assert dict(whole.dtypes)["webpage_id"] == "bigint"


def test_columns_without_values_or_nulls_are_left_alone(rows_of):
    df = rows_of({"gender": None, "age_level": None}, {"gender": None, "age_level": None})
    assert impute.fit_imputer(df).fills == {}
    assert impute.column_modes(df, ["gender"]) == {"gender": None}
    assert impute.column_medians(df, ["age_level"]) == {"age_level": None}


def test_named_columns_take_their_mode(rows_of):
    df = rows_of({"age_level": 2.0}, {"age_level": 2.0}, {"age_level": 9.0}, {"age_level": None})
    fills = impute.fit_imputer(df, modes=["age_level", "gender"], medians=[]).fills
    assert fills == {"age_level": 2.0}


@pytest.mark.parametrize("n", [1, 2, 1001, 20_000])
def test_median_of_many_values_is_narrowed_exactly(spark, n):
    # Distinct, skewed values in no order; only 50 may be ranked at once.
    df = spark.range(n).select(
        (F.pow((F.col("id") * 7919) % n, 2) / 3).alias("x"),
        F.when(F.col("id") % 3 == 0, -1).otherwise((F.col("id") * 31) % n).alias("y"),
    )
    values = df.toPandas()
    assert impute.column_medians(df, ["x", "y"], max_values=50) == {
        "x": values.x.median(), "y": values.y.median()}


@pytest.mark.parametrize("n", [999, 1000])
def test_median_is_exact_where_no_interval_narrows(spark, monkeypatch, n):
    def stuck(df, intervals, totals, columns):
        for c in columns:
            intervals[c].final = True

    monkeypatch.setattr(impute, "_narrow", stuck)
    x = F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % n).cast("double"))
    df = spark.range(n).repartition(5).select(x.alias("x"), (F.col("id") % 3).alias("value"), F.lit(1).alias("range"))
    values = sorted(float(i * 7919 % n) for i in range(n) if i % 10)
    middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    assert impute.column_medians(df, ["x", "value"], max_values=2) == {"x": middle, "value": 1.0}


def test_median_of_a_value_that_dominates(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5_000).alias("x"))
    assert impute.column_medians(df, ["x"], max_values=10) == {"x": 5_000.0}


def test_imputation_does_not_depend_on_partitioning(raw):
    rows = clean.drop_null_required(raw)
    assert impute.fit_imputer(rows.repartition(3)).fills == impute.fit_imputer(rows.coalesce(1)).fills


def test_cleaning_is_the_same_for_any_partitioning(raw):
    assert same(clean.clean_rows(raw.repartition(13)), clean.clean_rows(raw.coalesce(1)))
