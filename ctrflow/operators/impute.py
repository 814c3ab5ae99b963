"""Mode and median imputation, exact at any number of distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from ctrflow.operators.tally import value_tally
from ctrflow.schema import columns_of
from ctrflow.session import MAX_LOCAL_ROWS, stage

#: percentile_approx guarantees a rank error of at most 1 / accuracy.
ACCURACY = 10_000


@dataclass
class _Interval:
    """Where the middle of a column lies: the values from ``lo`` to ``hi``."""

    lo: object
    hi: object
    below: int      # values under lo
    inside: int     # values from lo to hi
    distinct: int   # estimate of distinct values inside
    final: bool = False  # passes narrow it no further

    def within(self, column: str) -> Column:
        value = F.col(column)
        if self.lo is None:
            return value.isNotNull()
        return (value >= F.lit(self.lo)) & (value <= F.lit(self.hi))

    def too_wide(self, max_values: int) -> bool:
        return self.many(max_values) and not self.final

    def many(self, max_values: int) -> bool:
        return self.distinct > max_values and (self.lo is None or self.lo != self.hi)


def column_facts(df: DataFrame, columns: Sequence[str], distinct: Sequence[str] = ()) -> Row:
    """Rows (``n``), values per column (``n_<column>``) and estimates of distinct ones (``d_``)."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.approx_count_distinct(c).alias(f"d_{c}") for c in distinct],
    ).first()


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the lowest one when several are; None without values."""
    return _statistics(df, columns, {}, {}, MAX_LOCAL_ROWS)


def column_medians(
    df: DataFrame, columns: Sequence[str], max_values: int = MAX_LOCAL_ROWS
) -> dict[str, float | None]:
    """Exact medians, the midpoint of the two middle values when their number is even."""
    facts = column_facts(df, columns, columns) if columns else None
    intervals, totals = _intervals(df, columns, facts, max_values)
    return {c: None for c in columns} | _statistics(df, [], intervals, totals, max_values)


def _intervals(
    df: DataFrame, columns: Sequence[str], facts: Row, max_values: int
) -> tuple[dict[str, _Interval], dict[str, int]]:
    """An interval around the middle of each column that holds few enough distinct values.

    Columns with few distinct values keep all of them. For the others each pass narrows the
    interval about 2,500-fold with ``percentile_approx``, whose buffers are bounded. An interval that a
    pass cannot narrow stays as it is, and is left to :func:`_ranked`.
    """
    totals = {c: facts[f"n_{c}"] for c in columns if facts[f"n_{c}"]}
    intervals = {c: _Interval(None, None, 0, n, facts[f"d_{c}"]) for c, n in totals.items()}
    while wide := [c for c, s in intervals.items() if s.too_wide(max_values)]:
        _narrow(df, intervals, totals, wide)
    return intervals, totals


def _middle(n: int) -> tuple[int, int]:
    """0-based ranks of the two middle values, equal when n is odd."""
    return (n - 1) // 2, n // 2


def _narrow(
    df: DataFrame, intervals: dict[str, _Interval], totals: dict[str, int], columns: list[str]
) -> None:
    margin = 2 / ACCURACY
    asked = []
    for c in columns:
        s, (low, high) = intervals[c], _middle(totals[c])
        p = max(0.0, (low - s.below) / s.inside - margin)
        q = min(1.0, (high - s.below + 1) / s.inside + margin)
        value = F.when(s.within(c), F.col(c))
        asked.append(F.percentile_approx(value, [p, q], ACCURACY).alias(c))
    ends = df.agg(*asked).first()
    tried = {c: _Interval(*ends[c], 0, 0, 0) for c in columns}
    counts = df.agg(*[
        measure for c in columns for measure in (
            F.count(F.when(F.col(c) < F.lit(tried[c].lo), 1)).alias(f"b_{c}"),
            F.count(F.when(tried[c].within(c), 1)).alias(f"i_{c}"),
            F.approx_count_distinct(F.when(tried[c].within(c), F.col(c))).alias(f"d_{c}"),
        )
    ]).first()
    for c in columns:
        old, (low, high) = intervals[c], _middle(totals[c])
        new = _Interval(*ends[c], counts[f"b_{c}"], counts[f"i_{c}"], counts[f"d_{c}"])
        holds = new.below <= low and high < new.below + new.inside
        if holds and new.inside < old.inside:
            intervals[c] = new
        else:
            old.final = True


def _ranked(values: DataFrame, column: str, ranks: Sequence[int]) -> list[float]:
    """The values at 0-based ``ranks`` of a column with any number of distinct values.

    Values and their counts are dealt to ranges once; the sums of the ranges tell which of them hold
    the ranks, and only those are sorted, each in a task of its own.
    """
    tally = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    dealt = stage(tally.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "ranges")
    before, asked = 0, {}
    for r in dealt.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():  # a row per shuffle partition
        for rank in ranks:
            if before <= rank < before + r["n"]:
                asked[rank] = (r["range"], rank - before)
        before += r["n"]
    order = Window.partitionBy("range").orderBy("value")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    held = dealt.where(F.col("range").isin({at for at, _ in asked.values()})).withColumn("upto", upto)
    picks = [(F.col("range") == at) & (F.col("upto") > k) & (F.col("upto") - F.col("n") <= k) for at, k in asked.values()]
    return [float(r["value"]) for r in held.where(reduce(Column.__or__, picks)).collect()]


def _statistics(
    df: DataFrame, modes: Sequence[str], intervals: dict[str, _Interval], totals: dict[str, int], max_values: int
) -> dict[str, object]:
    """Modes of some columns and medians of others, in one job over value counts.

    Only columns whose interval still holds more than ``max_values`` values get jobs of their own.
    """
    large = [c for c, s in intervals.items() if s.many(max_values)]
    modes, medians = list(modes), [c for c in intervals if c not in large]
    answers = []
    if modes:
        # Smallest (-n, value): the highest count, then the lowest value.
        best = F.min(F.struct("_neg", *modes)).alias("_best")
        tally = value_tally(df, modes, (-F.count(F.lit(1))).alias("_neg"))
        answers.append(tally.groupBy("column").agg(best).select("column", "_best.*").drop("_neg"))
    if medians:
        inside = df.select(*[F.when(s.within(c), F.col(c)).alias(c) for c, s in intervals.items()])
        order = Window.partitionBy("column").orderBy(*medians)
        upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
        ranked = value_tally(inside, medians, F.count(F.lit(1)).alias("n")).withColumn("_upto", upto)
        picks = [
            (F.col("column") == c) & (F.col("_upto") > at) & (F.col("_upto") - F.col("n") <= at)
            for c in medians for at in {r - intervals[c].below for r in _middle(totals[c])}
        ]
        answers.append(ranked.where(reduce(Column.__or__, picks)).drop("n", "_upto"))
    found: dict[str, object] = {c: None for c in modes}
    middles: dict[str, list[float]] = {c: [] for c in medians}
    ranks = {c: [r - intervals[c].below for r in _middle(totals[c])] for c in large}
    if answers:
        joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), answers)
        for row in joined.collect():  # one or two rows per column
            c = row["column"]
            if c in middles:
                middles[c].append(float(row[c]))
            else:
                found[c] = row[c]
    for c in large:
        middles[c] = _ranked(df.select(F.when(intervals[c].within(c), F.col(c)).alias(c)), c, ranks[c])
    return found | {c: sum(values) / len(values) for c, values in middles.items()}


@dataclass
class Imputer:
    """Fitted fill values by column."""

    fills: dict[str, object]

    def transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        filled = {}
        for c, value in self.fills.items():
            source = F.col(c)
            if kinds[c] in ("tinyint", "smallint", "int", "bigint"):
                if float(value).is_integer():
                    value = int(value)
                else:  # the midpoint of two whole numbers: the column becomes fractional
                    source = source.cast("double")
            filled[c] = F.coalesce(source, F.lit(value))
        return df.withColumns(filled) if filled else df


def fit_imputer(
    df: DataFrame,
    modes: Sequence[str] | None = None,
    medians: Sequence[str] | None = None,
    max_values: int = MAX_LOCAL_ROWS,
    applied_to: DataFrame | None = None,
) -> Imputer:
    """Modes of string columns and medians of number columns, for the columns that have nulls.

    Pass column lists to choose other columns, such as the mode of a number column. When the fill
    values come from other rows than they are ``applied_to``, such as the training rows, it is the
    latter whose nulls decide about the columns.
    """
    modes = columns_of(df, "String") if modes is None else list(modes)
    if medians is None:
        medians = [c for c in columns_of(df, "Integral", "Fractional") if c not in modes]
    if not [*modes, *medians]:
        return Imputer({})
    facts = column_facts(df, [*modes, *medians], medians)
    target = facts if applied_to is None else column_facts(applied_to, [*modes, *medians])
    modes, medians = (
        [c for c in columns if target[f"n_{c}"] < target["n"]] for columns in (modes, medians)
    )
    intervals, totals = _intervals(df, medians, facts, max_values)
    fills = _statistics(df, modes, intervals, totals, max_values)
    return Imputer({c: value for c, value in fills.items() if value is not None})


def impute(df: DataFrame, **choice) -> DataFrame:
    """Fit and apply on the same rows."""
    return fit_imputer(df, **choice).transform(df)
