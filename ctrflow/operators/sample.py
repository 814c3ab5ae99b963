"""Exact, seeded class balancing and sampling.

All of it follows one pseudo-random order, ``md5(key:seed)``, so the result does not depend on the
partitioning. No step brings the rows into a single partition: hash prefixes split them evenly into
65,536 buckets, and only bucket counts and one bounded bucket are looked at as a whole.

``key`` has to identify a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ctrflow.functions.hashing import BUCKET_DIGITS, bucket, draw_hash, hash_number
from ctrflow.schema import ID, TARGET

SEED = 42
#: Rows that one task may rank; a larger bucket is split by further digits of the hash.
RANKED_ROWS = 100_000
HASH_DIGITS = 32


def _class_buckets(df: DataFrame, target: str, key: str, seed: int) -> DataFrame:
    """Rows per class and hash bucket with a running count: at most 2 x 65,536 rows."""
    running = Window.partitionBy(target).orderBy("_bucket")
    return (
        df.where(F.col(target).isin(0, 1))
        .groupBy(target, bucket(draw_hash(F.col(key), seed)).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running))
    )


def downsample(
    df: DataFrame, target: str = TARGET, key: str = ID, seed: int = SEED
) -> DataFrame:
    """All rows of class 1 and equally many of class 0, drawn without replacement.

    The draw is the first n rows of class 0 in hash order. Light jobs find the n-th of them: counts by
    leading digits of the hash tell in which bucket it lies, further digits split that bucket while it is large, and the
    rest is ranked. The result is a plain filter against it: no sort or shuffle of the rows themselves.
    """
    sizes = _class_buckets(df, target, key, seed)
    whole = Window.partitionBy(F.lit(0))
    cut = (
        sizes.withColumn("_wanted", F.sum(F.when(F.col(target) == 1, F.col("_n"))).over(whole))
        .withColumn("_have", F.sum(F.when(F.col(target) == 0, F.col("_n"))).over(whole))
        .where((F.col(target) == 0) & (F.col("_upto") >= F.coalesce("_wanted", F.lit(0))))
        .orderBy("_bucket")
        .first()
    )
    if not df.where(F.col(key).isNull() & (F.col(target) == 0)).isEmpty():
        raise ValueError(f"{key} is null in rows of class 0")
    minority = F.col(target) == 1
    if cut is None:
        n_one = df.where(minority).limit(1).count()
        if n_one:
            raise ValueError("class 0 has fewer rows than class 1: cannot downsample it")
        return df.where(F.lit(False))
    if not cut["_wanted"]:
        return df.where(minority)
    rank = cut["_wanted"] - (cut["_upto"] - cut["_n"])
    hashed = draw_hash(F.col(key), seed)
    prefix, rank = _narrowed(df.where(F.col(target) == 0), hashed, cut["_bucket"], cut["_n"], rank)
    boundary = (
        df.where((F.col(target) == 0) & hashed.startswith(prefix))
        .select(hashed.alias("_hash"))
        .groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_hash")))
        .where((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank + 1))
        .orderBy("_hash")
        .collect()
    )
    # More than one row with the hash of the n-th: the draw would take too many.
    if boundary[0]["_upto"] > rank:
        raise ValueError(f"{key} does not identify the rows of class 0")
    drawn = (F.col(target) == 0) & (hashed <= F.lit(boundary[0]["_hash"]))
    return df.where(minority | drawn)


def _narrowed(df: DataFrame, hashed: Column, prefix: str, rows: int, rank: int) -> tuple[str, int]:
    """A longer prefix that still holds the ``rank``-th row (from 1) of ``prefix``, and its rank there.

    Each pass counts rows by the next digits, at most 65,536 counts. Equal hashes are one key, so the passes end.
    """
    while rows > RANKED_ROWS and len(prefix) < HASH_DIGITS:
        longer = F.substring(hashed, 1, len(prefix) + BUCKET_DIGITS)
        counts = df.where(hashed.startswith(prefix)).groupBy(longer.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_prefix"))
        held = counts.withColumn("_upto", upto).where(F.col("_upto") >= rank).orderBy("_prefix").first()
        prefix, rows, rank = held["_prefix"], held["_n"], rank - (held["_upto"] - held["_n"])
    return prefix, rank


def number_in_hash_order(
    df: DataFrame, name: str, key: str = ID, seed: int = SEED
) -> DataFrame:
    """Adds a dense 0-based row number in hash order.

    Rows are ranked inside their hash bucket and shifted by the number of rows in the buckets
    before it; that offset table never exceeds 65,536 rows.
    """
    hashed = df.withColumn("_hash", draw_hash(F.col(key), seed)).withColumn(
        "_bucket", bucket(F.col("_hash"))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket")
    offsets = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_offset"))
    )
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash"))
    return (
        hashed.withColumn("_in_bucket", in_bucket)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_in_bucket") - 1)
        .drop("_hash", "_bucket", "_in_bucket", "_offset")
    )


def draws(spark, n: int, m: int, seed: int) -> DataFrame:
    """``n`` draws with replacement from 0..m-1, as column ``_pick``."""
    picked = hash_number(draw_hash(F.col("id"), seed)) % F.lit(m)
    return spark.range(n).select(picked.alias("_pick"))


def upsample(df: DataFrame, target: str = TARGET, key: str = ID, seed: int = SEED) -> DataFrame:
    """All rows of class 0 and equally many of class 1, drawn with replacement."""
    sizes = dict(
        df.where(F.col(target).isin(0, 1)).groupBy(target).agg(F.count(F.lit(1))).collect()
    )
    majority = df.where(F.col(target) == 0)
    if not sizes.get(0):
        return majority
    if not sizes.get(1):
        raise ValueError("class 1 has no rows to draw from")
    numbered = number_in_hash_order(df.where(F.col(target) == 1), "_pick", key, seed)
    drawn = draws(df.sparkSession, sizes[0], sizes[1], seed).join(numbered, "_pick").drop("_pick")
    return drawn.unionByName(majority)


def balance(df: DataFrame, how: str = "downsample", **options) -> DataFrame:
    if how not in ("downsample", "upsample"):
        raise ValueError(f"unknown resampling type {how!r}")
    return (downsample if how == "downsample" else upsample)(df, **options)


def shuffle_rows(df: DataFrame, key: str = ID, seed: int = SEED) -> DataFrame:
    """All rows in seeded random order."""
    return df.orderBy(draw_hash(F.col(key), seed), key)


def sample_rows(df: DataFrame, k: int, key: str = ID, seed: int = SEED) -> DataFrame:
    """``k`` random rows: the first of the seeded order."""
    return shuffle_rows(df, key, seed).limit(k)
