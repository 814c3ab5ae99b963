"""Category encoders: fitted on one frame, applied to others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ctrflow.operators.tally import value_tally
from ctrflow.schema import ID, TARGET
from ctrflow.session import MAX_LOCAL_ROWS, small_or_staged, stage

UNSEEN = ("error", "null", "value")
FOLDS = 5


@dataclass
class Encoder:
    """A fitted mapping table: ``column, dtype, label, code`` and, if cross-fitted, ``fold``.

    Small mappings are local relations and get broadcast; larger ones are tables and get joined by
    shuffle (AQE splits the frequent labels). Labels are kept as text and compared in the type of
    their column.
    """

    mapping: DataFrame
    default: float | None = None  # code of an unseen label where the method defines one

    def transform(
        self,
        df: DataFrame,
        columns: Mapping[str, str] | Sequence[str] | None = None,
        on_unseen: str = "error",
        unseen_value: float = -1,
        suffix: str = "_encoding",
    ) -> DataFrame:
        """Adds ``<column>_encoding`` for each column.

        ``columns`` may map a frame column to the column it was fitted as, which encodes an
        engineered column with the codes of its base column. A label without a code raises,
        becomes null, or becomes ``unseen_value``; an encoder with a default uses that instead.
        """
        if on_unseen not in UNSEEN:
            raise ValueError(f"on_unseen must be one of {UNSEEN}")
        if not isinstance(columns, Mapping):
            columns = {c: c for c in (self.columns() if columns is None else columns)}
        dtypes = dict(df.dtypes)
        added = {}
        joined = df
        for i, (source, fitted) in enumerate(columns.items()):
            codes = self.mapping.where(F.col("column") == fitted).select(
                F.col("label").cast(dtypes[source]).alias(f"_label_{i}"),
                F.col("code").alias(f"_code_{i}"),
            )
            joined = joined.join(codes, F.col(source) == F.col(f"_label_{i}"), "left")
            added[f"{source}{suffix}"] = self._settle(
                F.col(f"_code_{i}"), source, on_unseen, unseen_value
            )
        kept = [c for c in df.columns if c not in added]
        return joined.select(*kept, *[code.alias(name) for name, code in added.items()])

    def _settle(self, code: Column, source: str, on_unseen: str, unseen_value: float) -> Column:
        if self.default is not None:
            return F.coalesce(code, F.lit(self.default))
        if on_unseen == "null":
            return code
        if on_unseen == "value":
            return F.coalesce(code, F.lit(unseen_value))
        text = F.coalesce(F.col(source).cast("string"), F.lit("null"))
        unseen = F.raise_error(F.concat(F.lit(f"unseen label in {source}: "), text))
        return F.when(code.isNull(), unseen).otherwise(code)

    def extended(self, df: DataFrame, columns: Sequence[str] | None = None, max_labels: int = MAX_LOCAL_ROWS) -> Encoder:
        """An encoder that also knows the labels of ``df``: old labels keep their codes, new ones of a column get the numbers after its
        largest code, in the order of the typed values."""
        columns = list(columns or self.columns())
        label = F.coalesce(*[F.col(c).cast("string") for c in columns])
        tally = value_tally(df, columns, F.lit(1).alias("_one")).drop("_one").withColumn("_known", label)
        known = self.mapping.select("column", F.col("label").alias("_known"))
        fresh = _numbered_mapping(df, columns, tally.join(known, ["column", "_known"], "left_anti").drop("_known"), columns, max_labels)
        first = self.mapping.groupBy("column").agg((F.max("code") + 1).alias("_first"))
        numbered = fresh.join(first, "column", "left").withColumn("code", (F.coalesce("_first", F.lit(0)) + F.col("code")).cast("int"))
        both = self.mapping.unionByName(numbered.select(*self.mapping.columns))
        return Encoder(small_or_staged(both, "mapping", max_labels), self.default)

    def columns(self) -> list[str]:
        return sorted(r[0] for r in self.mapping.select("column").distinct().collect())

    def save(self, path: str) -> None:
        """Writes the mapping; the default is a row without a column."""
        rows = self.mapping
        if self.default is not None:
            default = rows.sparkSession.range(1).select(F.lit(float(self.default)).alias("code"))
            rows = rows.unionByName(default, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoder:
        rows = spark.read.parquet(path)
        default = rows.where(F.col("column").isNull()).select("code").first()
        return Encoder(rows.where(F.col("column").isNotNull()), default and default["code"])


def _as_mapping(df: DataFrame, columns: Sequence[str], tally: DataFrame, code: Column, *more) -> DataFrame:
    """Long form of a tally: the typed value as text, with the type to compare it in."""
    dtypes = dict(df.dtypes)
    label = F.coalesce(*[F.col(c).cast("string") for c in columns])
    dtype = F.coalesce(*[F.when(F.col("column") == c, dtypes[c]) for c in columns])
    return tally.select(
        "column", dtype.alias("dtype"), label.alias("label"), *more, code.alias("code")
    )


def _numbered_mapping(
    df: DataFrame, columns: Sequence[str], tally: DataFrame, order: Sequence[str], max_labels: int
) -> DataFrame:
    """Mapping with a 0-based number per column in the given order of the tally."""
    code = F.col("_code").cast("int")
    rank = F.row_number().over(Window.partitionBy("column").orderBy(*order)) - 1
    # One more row than allowed tells whether all of them have been seen.
    head = tally.limit(max_labels + 1).withColumn("_code", rank)
    local = _as_mapping(df, columns, head, code).toArrow()
    if local.num_rows <= max_labels:
        return df.sparkSession.createDataFrame(local)
    return stage(_as_mapping(df, columns, _number_at_size(tally, order), code), "mapping")


def _number_at_size(tally: DataFrame, order: Sequence[str]) -> DataFrame:
    """The same numbering for any number of labels: a sorted table whose parts are counted.

    The sort is by range, the position inside a part is a running id, and the parts before it are
    added from a table with one row per part and column.
    """
    placed = stage(
        tally.orderBy("column", *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    before = Window.partitionBy("column").orderBy("_part")
    parts = (
        placed.groupBy("column", "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
        .withColumn("_offset", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    return (
        placed.join(F.broadcast(parts), ["column", "_part"])
        .withColumn("_code", (F.col("_at") - F.col("_from") + F.col("_offset")).cast("int"))
        .drop("_part", "_at", "_from", "_offset")
    )


def fit_label(
    df: DataFrame, columns: Sequence[str], max_labels: int = MAX_LOCAL_ROWS
) -> Encoder:
    """Codes 0..n-1 in the order of the typed values (numbers as numbers)."""
    columns = list(columns)
    values = value_tally(df, columns, F.lit(1).alias("_one")).drop("_one")
    return Encoder(_numbered_mapping(df, columns, values, columns, max_labels))


def fit_ordinal_ctr(
    df: DataFrame,
    columns: Sequence[str],
    target: str = TARGET,
    row_id: str = ID,
    max_labels: int = MAX_LOCAL_ROWS,
) -> Encoder:
    """Codes 0..n-1 by ascending click rate, equal rates by value."""
    columns = list(columns)
    rates = value_tally(df, columns, F.try_divide(F.sum(target), F.count(row_id)).alias("_ctr"))
    return Encoder(_numbered_mapping(df, columns, rates, ["_ctr", *columns], max_labels))


@dataclass
class TargetEncoder:
    """Smoothed mean click rate per label: one encoder from all training rows, one without each
    row's own fold for the training rows themselves."""

    full: Encoder
    folds: DataFrame      # column, dtype, label, fold, code
    fold_means: DataFrame  # fold, code of an unseen label
    fold_of: Column

    def save(self, path: str) -> None:
        self.full.save(f"{path}/full")
        self.folds.write.mode("overwrite").parquet(f"{path}/folds")
        self.fold_means.write.mode("overwrite").parquet(f"{path}/fold_means")

    @staticmethod
    def load(spark: SparkSession, path: str, row_id: str = ID, folds: int = FOLDS) -> TargetEncoder:
        """A saved encoder; ``row_id`` and ``folds`` as it was fitted with."""
        return TargetEncoder(
            Encoder.load(spark, f"{path}/full"), spark.read.parquet(f"{path}/folds"),
            spark.read.parquet(f"{path}/fold_means"), F.pmod(F.col(row_id), F.lit(folds)).cast("int"),
        )

    def transform(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """For validation, test and scoring rows."""
        return self.full.transform(df, columns)

    def transform_train(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """For the rows it was fitted on: each is encoded without the clicks of its own fold."""
        columns = self.full.columns() if columns is None else list(columns)
        dtypes = dict(df.dtypes)
        added = {}
        joined = df.withColumn("_fold", self.fold_of).join(self.fold_means, "_fold", "left")
        for i, c in enumerate(columns):
            codes = self.folds.where(F.col("column") == c).select(
                F.col("label").cast(dtypes[c]).alias(f"_label_{i}"),
                F.col("fold").alias(f"_fold_{i}"), F.col("code").alias(f"_code_{i}"),
            )
            match = (F.col(c) == F.col(f"_label_{i}")) & (F.col("_fold") == F.col(f"_fold_{i}"))
            joined = joined.join(codes, match, "left")
            added[f"{c}_encoding"] = F.coalesce(f"_code_{i}", "_mean")
        kept = [c for c in df.columns if c not in added]
        return joined.select(*kept, *[code.alias(name) for name, code in added.items()])


def _smoothed(n: Column, s: Column, q: Column, mean: Column, variance: Column) -> Column:
    """Shrinks a label's mean towards the global mean, more so the less the label tells.

    n, s and q are the label's number of rows, sum and sum of squares of the target. Without rows, or where neither the
    label nor all rows vary, the code is the global mean.
    """
    own = F.try_divide(s, n)
    spread = F.try_divide(q - s * own, n)
    weight = F.coalesce(F.try_divide(variance * n, variance * n + spread), F.lit(0.0))
    return F.coalesce(weight * own + (1 - weight) * mean, mean)


def fit_target(
    df: DataFrame,
    columns: Sequence[str],
    target: str = TARGET,
    row_id: str = ID,
    folds: int = FOLDS,
    max_labels: int = MAX_LOCAL_ROWS,
) -> TargetEncoder:
    """Target encoding with empirical-Bayes smoothing; fold of a row: ``pmod(row id, folds)``."""
    columns = list(columns)
    fold_of = F.pmod(F.col(row_id), F.lit(folds)).cast("int")
    y = F.col(target).cast("double")
    moments = [F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")]
    per_fold = small_or_staged(
        value_tally(df.withColumn("_fold", fold_of), columns, *moments, by=["_fold"]),
        "folds", max_labels,
    )
    whole = df.withColumn("_fold", fold_of).groupBy("_fold").agg(*moments).toArrow()
    total = {k: sum(v or 0 for v in whole.column(k).to_pylist()) for k in ("n", "s", "q")}
    if not total["n"]:
        raise ValueError("no rows to fit on")
    mean = total["s"] / total["n"]
    variance = total["q"] / total["n"] - mean**2

    # All rows of a label.
    by_label = per_fold.groupBy("column", *columns).agg(
        *[F.sum(k).alias(k) for k in ("n", "s", "q")]
    )
    code = _smoothed(F.col("n"), F.col("s"), F.col("q"), F.lit(mean), F.lit(variance))
    full = Encoder(
        small_or_staged(_as_mapping(df, columns, by_label, code), "mapping", max_labels), mean
    )

    # The rows of a label outside each fold.
    fold_totals = df.sparkSession.createDataFrame(whole).select(
        "_fold",
        *[(F.lit(total[k]) - F.col(k)).alias(f"_{k}") for k in ("n", "s", "q")],
    )
    fold_stats = fold_totals.select(
        "_fold",
        # A fold without others takes the mean of all rows.
        F.coalesce(F.try_divide("_s", "_n"), F.lit(mean)).alias("_mean"),
        F.coalesce(F.try_divide("_q", "_n") - F.pow(F.try_divide("_s", "_n"), 2), F.lit(variance)).alias("_variance"),
    )
    label = Window.partitionBy("column", *columns)
    others = per_fold.select(
        "column", *columns, "_fold", *[(F.sum(k).over(label) - F.col(k)).alias(k) for k in "nsq"]
    ).join(fold_stats, "_fold")
    code = _smoothed(F.col("n"), F.col("s"), F.col("q"), F.col("_mean"), F.col("_variance"))
    folded = _as_mapping(df, columns, others, code, F.col("_fold").alias("fold"))
    return TargetEncoder(
        full,
        small_or_staged(folded, "mapping", max_labels),
        fold_stats.select("_fold", "_mean"),
        fold_of,
    )


def lookup(
    df: DataFrame, mapping: DataFrame, columns: Mapping[str, str], on_unseen: str = "null"
) -> DataFrame:
    """Dictionary lookup with a mapping table, whatever fitted it."""
    return Encoder(mapping).transform(df, columns, on_unseen=on_unseen)
