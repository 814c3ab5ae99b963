"""Repeatable pseudo-random order: the same for every partitioning, and expressible in any SQL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Hash prefix that spreads rows over 16 ** 4 = 65,536 buckets, whatever the key distribution.
BUCKET_DIGITS = 4


def draw_hash(key: Column, seed: int) -> Column:
    """md5 of the key and the seed; sorting by it is a seeded shuffle."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def bucket(hashed: Column) -> Column:
    """Leading digits of a hash; buckets follow the order of the hashes."""
    return F.substring(hashed, 1, BUCKET_DIGITS)


def hash_number(hashed: Column, digits: int = 15) -> Column:
    """Leading hex digits as a non-negative bigint (15 digits are 60 bits)."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def percent_bucket(key: Column, seed: int) -> Column:
    """0-99, for sampling a percentage of keys."""
    return F.pmod(hash_number(draw_hash(key, seed)), F.lit(100))
