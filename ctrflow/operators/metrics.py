"""Binary classification metrics from one aggregate over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ctrflow.schema import TARGET


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: true/false negatives and positives."""
    y, p = F.col(label), F.col(prediction)

    def cell(actual: int, predicted: int) -> Column:
        return F.count(F.when((y == actual) & (p == predicted), 1))

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"), cell(1, 1).alias("tp"),
    )


def _ratio(a: Column, b: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_matrix(
    df: DataFrame, label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """Rows: actual class; columns: predicted class."""
    rows = F.array(
        F.struct(F.lit(0).alias("actual"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("actual"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    )
    return _cells(df, label, prediction).select(F.inline(rows))


def classification_report(
    df: DataFrame, label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted average.

    The accuracy row carries the accuracy in ``f1_score`` and no precision or recall.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    scores = _cells(df, label, prediction).select(
        "*",
        (tn + fp).alias("s0"), (fn + tp).alias("s1"), (tn + fp + fn + tp).alias("s"),
        _ratio(tn, tn + fn).alias("p0"), _ratio(tn, tn + fp).alias("r0"),
        _ratio(2 * tn, 2 * tn + fn + fp).alias("f0"),
        _ratio(tp, tp + fp).alias("p1"), _ratio(tp, tp + fn).alias("r1"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )

    def line(name: str, precision, recall, f1, support) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), support.alias("support"),
        )

    def macro(x: str) -> Column:
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str) -> Column:
        return _ratio(F.col(f"{x}0") * F.col("s0") + F.col(f"{x}1") * F.col("s1"), F.col("s"))

    none = F.lit(None).cast("double")
    c = F.col
    rows = F.array(
        line("0", c("p0"), c("r0"), c("f0"), c("s0")),
        line("1", c("p1"), c("r1"), c("f1"), c("s1")),
        line("accuracy", none, none, _ratio(tn + tp, c("s")), c("s")),
        line("macro avg", macro("p"), macro("r"), macro("f"), c("s")),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), c("s")),
    )
    return scores.select(F.inline(rows))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def f1_score(df: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """F1 of class 1."""
    cells = _cells(df, label, prediction)
    return cells.select(f1_of(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1_score"))


def f1_by(
    df: DataFrame, keys: list[str], label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """F1 of class 1 per group."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*keys).agg(
        f1_of(
            F.count(F.when((y == 1) & (p == 1), 1)),
            F.count(F.when((y == 0) & (p == 1), 1)),
            F.count(F.when((y == 1) & (p == 0), 1)),
        ).alias("f1_score")
    )
