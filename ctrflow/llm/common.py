"""What the operators share: staged tables, words and their hashes, packed exchanges.

A packed exchange moves numpy arrays instead of single rows: a map task sorts its entries by bucket and
emits one row per bucket, each column the bytes of an array. Spark shuffles these few rows by bucket, and
the task of a bucket sees plain arrays again.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.session import scratch_path

#: Words of a text are what lies between these six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task holds as arrays at a time.
CHUNK_BYTES = 8 << 20
#: Words whose hashes a worker remembers.
MEMO_WORDS = 150_000
#: Multiplier of the rolling hashes, odd (the 64-bit golden ratio).
BASE = 0x9E3779B97F4A7C15


class Scratch:
    """Tables in the shared folder that one operator writes, reads again and drops when it needs them no more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a Parquet table; the shuffle files of its plan are free to go afterwards."""
        self.free()
        path = scratch_path(self.spark, f"{self.name}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        self.free()
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self) -> None:
        """Lets Spark's cleaner remove the shuffle files of plans that nobody holds any more.

        It works on references, so without a collection of the driver's garbage those files would stay.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)
        self.free()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_row_per_id(df: DataFrame, id_col: str, text_col: str, *flags: str) -> DataFrame:
    """(id, text) with one row per id that is not null; of several texts the smallest stays (null only if all are), of flags the
    largest.

    A first job looks for repeated ids among the ids alone, so that texts are only shuffled when there are any.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *flags).where("id IS NOT NULL")
    repeated = rows.groupBy("id").count().where("count > 1").select("id")
    if repeated.isEmpty():
        return rows
    single = rows.join(repeated, "id", "left_anti")
    return single.unionByName(rows.join(repeated, "id", "left_semi").groupBy("id").agg(
        F.min("text").alias("text"), *[F.max(c).alias(c) for c in flags]))


def row_keys(df: DataFrame, id_col: str, text_col: str, scratch: Scratch, nameless: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``df`` with ``row_key``, a number that no two rows share, and a table (row_key, id) of it.

    Keys ascend with the ids, and among rows of one id with a hash of the text. Rows without an id have none, or one of their
    own, above all others, if ``nameless``. Where ids tell all rows apart they are the keys themselves, and there is no table; else the
    rows are staged, since their numbers depend on how they are dealt out. Ids are integers.
    """
    id_ = F.col(id_col).cast("long")
    counts = df.groupBy(id_.alias("id")).count()
    if counts.where("id IS NULL" if nameless else "false").unionByName(counts.where("id IS NOT NULL AND count > 1")).isEmpty():
        return df.withColumn("row_key", id_), None
    # The place in the input keeps equal rows apart, so that many of them are no single range.
    order = [id_.asc_nulls_last(), F.xxhash64(F.col(text_col).cast("string")), F.col("row_key")]
    rows = df.withColumn("row_key", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    # These numbers ascend from one range to the next.
    key = F.monotonically_increasing_id()
    rows = scratch.stage(rows.withColumn("row_key", key), "keys")
    if not nameless:
        rows = rows.withColumn("row_key", F.when(id_.isNotNull(), F.col("row_key")))
    return rows, rows.where("row_key IS NOT NULL").select("row_key", id_.alias("id"))


def ids_of_keys(found: DataFrame, names: DataFrame | None, *columns: str) -> DataFrame:
    """``found`` with the ids instead of the keys in ``columns``; null stays null."""
    if names is None:
        return found
    order = found.columns
    for c in columns:
        # Rows without a key match nothing; numbers below all keys deal them out.
        at = F.coalesce(F.col(c), -1 - F.monotonically_increasing_id())
        found = found.withColumn("_key", at).join(names.select(F.col("row_key").alias("_key"), F.col("id").alias("_id")), "_key", "left")
        found = found.withColumn(c, F.col("_id")).select(order)
    return found


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


# ---- words


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_MEMO = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, words), np.uint64, len(words))


def release() -> None:
    """Hands free memory of this process back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def text_chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as bytes) of columns 0 and 1, about ``limit`` bytes at a time; null texts are empty.

    What a chunk needed goes back to the system before the next one, since a worker lives on through many tasks.
    """
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            ids.append(i)
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
                if len(_MEMO) > MEMO_WORDS:
                    _MEMO.clear()
                release()
    if ids:
        yield ids, texts
    release()


def tokens(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and the number of words of each text."""
    found = []
    for t in texts:
        found.append(word_hashes((t.lower() if lower else t).split()))
        if len(_MEMO) > 2 * MEMO_WORDS:
            _MEMO.clear()
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that lets every bit depend on every other (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int, base: int = BASE) -> np.ndarray:
    """Hashes of the ``n`` consecutive values from each position on; ``len(h) - n + 1`` of them."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, have, power, length = None, 0, h, 1
    while n:
        if n & 1:  # append the block of this length to what there is
            if out is None:
                out, have = power, length
            else:
                m = len(h) - have - length + 1
                out = out[:m] * np.uint64(pow(base, length, 1 << 64)) + power[have:have + m]
                have += length
        n >>= 1
        if n:
            m = len(power) - length
            power = power[:m] * np.uint64(pow(base, length, 1 << 64)) + power[length:length + m]
            length *= 2
    return mix(out)


# ---- packed exchanges


def packed_schema(*columns: str) -> str:
    return "bucket int, " + ", ".join(f"{c} binary" for c in columns)


def pack(bucket: np.ndarray, buckets: int, **columns: np.ndarray | None) -> pa.RecordBatch:
    """One row per bucket that has entries, each column the bytes of its entries in their order; null for None."""
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 65536 else bucket, kind="stable")
    counts = np.bincount(bucket.astype(np.int64), minlength=buckets)
    full = np.flatnonzero(counts)
    ends = np.concatenate([[0], np.cumsum(counts[full])])
    arrays = [pa.array(full.astype(np.int32))]
    for values in columns.values():
        if values is None:
            arrays.append(pa.nulls(len(full), pa.binary()))
            continue
        values = np.ascontiguousarray(values[order])
        offsets = (ends * values.itemsize).astype(np.int64)
        arrays.append(pa.Array.from_buffers(
            pa.large_binary(), len(full), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def unpack(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(column).to_pylist() if x), dtype)


def row_sizes(table: pa.Table, column: str, dtype) -> np.ndarray:
    """Number of entries in each row of a packed column."""
    size = np.dtype(dtype).itemsize
    return np.array([len(x) // size if x else 0 for x in table.column(column).to_pylist()], np.int64)


def by_bucket(df: DataFrame, reduce, schema: str, buckets: int) -> DataFrame:
    """``reduce`` on the packed rows of each bucket."""
    return df.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(reduce, schema)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
