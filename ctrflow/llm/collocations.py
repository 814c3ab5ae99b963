"""Collocations by stripes: each prefix keys a counter of next words.

A stripe of prefix p holds how often each word follows p, and how often none that matters does. Stripes of tasks are
merged element by element, and one merged stripe gives the counts of the extensions of p, their sum, which is the count of p
itself, and their largest, which says whether p is subsumed by a phrase to its right.

Prefixes grow by a word per level: the empty one (of a language), then those of 1, 2 and 3 words. A phrase can only be frequent
if both phrases that are a word shorter are, so a level gets the frequent keys of the level before, as a bitmap of bounded size;
keys that fall on the same bit by chance only cost work. Next words that are out of question, and ends of pieces, are
counted together.

Languages, words and phrases are told apart by 64-bit hashes; the key of a phrase is mixed from the key of its prefix and
its last word. A stripe is cut into places by the hash of the next word, so a common prefix is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.llm.common import BASE, Scratch, by_bucket, mix, pack, partitions, runs, text_chunks, unpack, word_hashes

#: A-Z as a-z, all ends of pieces as full stops, tabs as spaces.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x2E if b in b".,;:!?" or 0x0A <= b <= 0x0D else 0x20 if b == 9 else b for b in range(256))
_END = b"."
#: The next word that stands for all others; no word hashes to it but by chance.
OTHER = np.uint64(0)
#: Places of a stripe, by the number of words of its prefix.
PLACES_BITS = [16, 8, 8, 8]
#: Bytes of text whose stripes are counted at a time, and whose stripes are merged in one task.
CHUNK, BUCKET_BYTES = 5 << 20, 10 << 20
#: Largest bitmap: 16 MB.
MOST_BITS = 27
STRIPES = "prefix long, next long, key long, f long, longest long, text binary"


def _extend(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(keys * np.uint64(BASE) + words)


def _read(batches: Iterator[pa.RecordBatch]):
    """Per chunk of texts: words, their hashes, where pieces end, and the hash of the language, word by word."""
    for langs, texts in text_chunks(batches, CHUNK):
        words: list[bytes] = []
        sizes = []
        for text in texts:
            found = text.translate(_BYTES).replace(_END, b" . ").split(b" ")
            found = [w for w in found if w]
            found.append(_END)
            sizes.append(len(found))
            words += found
        words += [_END] * 4  # so that there is room after the last word
        h = word_hashes(words)
        lang = np.append(np.repeat(np.array(langs, np.int64).view(np.uint64), sizes), np.zeros(4, np.uint64))
        yield words, h, h == word_hashes([_END])[0], lang


def _hits(keys: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    at = keys >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _stripes(texts: DataFrame, level: int, buckets: int, known, bits: int) -> DataFrame:
    """Packed stripes of prefixes of ``level`` words, counted per chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(known.value, np.uint8) if known else None
        for words, h, end, lang in _read(batches):
            keys, inside = lang, np.ones(len(h), bool)
            for k in range(level):  # the prefix from each position on, while it lies in a piece
                inside = inside & ~np.concatenate([end[k:], np.ones(k, bool)])
                keys = _extend(keys, np.concatenate([h[k:], np.zeros(k, np.uint64)]))
            following = np.concatenate([h[level:], np.zeros(level, np.uint64)])
            if level:
                inside &= _hits(keys, bitmap, bits)
                # The phrase without its first word has to be frequent too, and not to reach past the end.
                on = np.concatenate([inside[1:], [False]])
                following = np.where(on, following, OTHER)
            else:
                inside = ~end
            at = np.flatnonzero(inside)
            if not len(at):
                continue
            prefix, following = keys[at], following[at]
            key, first, counts = np.unique(_extend(prefix, following), return_index=True, return_counts=True)
            prefix, following, at = prefix[first], following[first], at[first]
            place = following >> np.uint64(64 - PLACES_BITS[level])
            bucket = (mix(prefix + place * np.uint64(BASE)) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((prefix, bucket))
            prefix, following, counts, bucket = prefix[order], following[order], counts[order].astype(np.uint32), bucket[order]
            starts = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (bucket[1:] != bucket[:-1])]))
            sizes = np.diff(np.append(starts, len(prefix))).astype(np.uint32)
            stripes = pack(bucket[starts], buckets, prefix=prefix[starts], size=sizes)
            entries = pack(bucket, buckets, next=following, count=counts)
            if level:
                spelt = pa.nulls(entries.num_rows, pa.binary())
            else:
                at = at[order].tolist()
                ends = np.append(runs(bucket), len(bucket)).tolist()
                spelt = pa.array([_END.join(words[i] for i in at[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
            del prefix, following, counts, bucket, order, at
            yield pa.RecordBatch.from_arrays(
                [*stripes.columns, entries.column(1), entries.column(2), spelt], names=["bucket", "prefix", "size", "next", "count", "text"])

    return texts.mapInArrow(count, "bucket int, prefix binary, size binary, next binary, count binary, text binary")


def _merge(least: int):
    """Stripes merged: a row per frequent extension, and a row per stripe with its sum (``f``) and its largest frequent count."""

    def merge(table: pa.Table) -> pa.Table:
        prefix = np.repeat(unpack(table, "prefix", np.uint64), unpack(table, "size", np.uint32))
        following, counts = unpack(table, "next", np.uint64), unpack(table, "count", np.uint32)
        texts = [t for x in table.column("text").to_pylist() if x is not None for t in x.split(_END)]
        order = np.lexsort((following, prefix))
        prefix, following, counts = prefix[order], following[order], counts[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (following[1:] != following[:-1])]))
        f = np.add.reduceat(counts, starts)
        prefix, following, place = prefix[starts], following[starts], order[starts]
        stripe = runs(prefix)
        frequent = (f >= least) & (following != OTHER)
        sums, largest = np.add.reduceat(f, stripe), np.maximum.reduceat(np.where(frequent, f, 0), stripe)
        at = np.flatnonzero(frequent)
        n, m = len(at), len(stripe)
        longs = [
            np.concatenate([prefix[at], prefix[stripe]]).view(np.int64), following[at].view(np.int64),
            _extend(prefix[at], following[at]).view(np.int64), np.concatenate([f[at], sums]), largest]
        blank = lambda size: pa.nulls(size, pa.int64())
        spelt = pa.array([texts[i] for i in place[at].tolist()] if texts else [None] * n, pa.binary())
        return pa.Table.from_arrays([
            pa.array(longs[0]), pa.chunked_array([pa.array(longs[1]), blank(m)]), pa.chunked_array([pa.array(longs[2]), blank(m)]),
            pa.array(longs[3]), pa.chunked_array([blank(n), pa.array(longs[4])]),
            pa.chunked_array([spelt, pa.nulls(m, pa.binary())])], names=["prefix", "next", "key", "f", "longest", "text"])

    return merge


def _bitmap(extensions: DataFrame) -> tuple[bytes, int]:
    """The first bits of all keys as a bitmap, with about 16 bits a key up to the largest size; built where the keys are."""
    bits = min(MOST_BITS, max(15, (16 * extensions.count()).bit_length()))
    at = F.shiftrightunsigned("key", 64 - bits) + 1
    parts = extensions.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bitmap = bytearray((1 << bits) // 8)
    for row in parts.toLocalIterator():
        start = (row["part"] - 1) * len(row["bits"])
        bitmap[start:start + len(row["bits"])] = row["bits"]
    return bytes(bitmap), bits


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(phrase, a, m, k, first, rest): each way to cut each phrase, with the keys of both parts."""
    for batch in batches:
        lang, key, a, m, *words = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(8))
        lang, words = lang.view(np.uint64), [w.view(np.uint64) for w in words]
        out: list[list[np.ndarray]] = []
        for size in (2, 3, 4):
            at = np.flatnonzero(m == size)
            for k in range(1, size):
                first = reduce(_extend, [w[at] for w in words[:k]], lang[at])
                rest = reduce(_extend, [w[at] for w in words[k:size]], lang[at])
                out.append([key[at], a[at], np.full(len(at), size, np.int32), np.full(len(at), k, np.int32), first.view(np.int64), rest.view(np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["phrase", "a", "m", "k", "first", "rest"])


def collocations(
    documents: DataFrame, scratch: Scratch, lang_col: str = "lang", text_col: str = "text", least: int = 30, top: int = 2000,
    subsumed_percent: int = 80,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to 4 words of each language.

    Texts are taken with A-Z as a-z, cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs. ``n`` counts
    all words of a language, ``a`` all places of the phrase within pieces, overlapping ones too; phrases count from
    ``least`` on. Of all cuts of a phrase into two parts with counts l and r the one with the lowest
    floor(2000000 a / (l + r)) counts, of equal ones the shortest first part. Phrases inside a longer one that counts and has at least
    ``subsumed_percent`` of their places are left out. Order: score, a, bytes of the phrase.

    Null texts are empty; rows without a language are ``und``. An empty table, or one without frequent phrases, gives no rows.
    Other columns, ids included, are not looked at.
    """
    spark = documents.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    text = F.col(text_col).cast("string")
    langs = scratch.stage(documents.groupBy(lang.alias("lang")).agg(F.sum(F.octet_length(text)).alias("bytes")).select(
        F.xxhash64("lang").alias("prefix"), "lang", "bytes"), "langs")
    size = langs.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(partitions(spark), -(-size // BUCKET_BYTES))
    texts = documents.select(F.xxhash64(lang).alias("prefix"), text.cast("binary").alias("text"))

    levels, known, bits = [], None, 0
    for level in range(4):
        packed = _stripes(texts, level, buckets, known, bits)
        merged = scratch.stage(by_bucket(packed, _merge(least), STRIPES, buckets), f"level{level}")
        levels.append(merged)
        if level < 3:
            bitmap, bits = _bitmap(merged.where("key IS NOT NULL"))
            known = spark.sparkContext.broadcast(bitmap)

    # Phrases with the hashes of their words, by joining extensions with their prefixes.
    phrases = [levels[0].where("key IS NOT NULL").select(F.col("prefix").alias("lang"), "key", "f", F.col("next").alias("w1"), "text")]
    for level in range(1, 4):
        shorter = phrases[-1].select("lang", F.col("key").alias("prefix"), *[f"w{i + 1}" for i in range(level)])
        longer = levels[level].where("key IS NOT NULL").select("prefix", "key", "f", F.col("next").alias(f"w{level + 1}"))
        phrases.append(longer.join(shorter, "prefix").drop("prefix"))
    none = F.lit(0).cast("long")
    candidates = scratch.stage(reduce(DataFrame.unionByName, [
        p.select("lang", "key", F.col("f").alias("a"), F.lit(m + 2).alias("m"),
                 *[(F.col(f"w{i + 1}") if i < m + 2 else none).alias(f"w{i + 1}") for i in range(4)])
        for m, p in enumerate(phrases[1:])]), "candidates")
    counts = phrases[0].select("key", "f").unionByName(candidates.where("m < 4").select("key", F.col("a").alias("f")))

    cuts = candidates.mapInArrow(_cuts, "phrase long, a long, m int, k int, first long, rest long")
    parts = cuts.join(counts.select(F.col("key").alias("first"), F.col("f").alias("l")), "first").join(
        counts.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    parts = parts.withColumns({"x": exact("a") * 2_000_000, "y": exact("l") + exact("r")}).withColumn("score", F.expr("x div y"))
    best = parts.groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(F.col("phrase").alias("key"), "cut.*")

    # The largest phrase to the right of a prefix is in its stripe; to the left, phrases meet at what follows their first word.
    right = reduce(DataFrame.unionByName, levels[2:]).where("key IS NULL AND longest > 0").select(F.col("prefix").alias("key"), "longest")
    left = cuts.where("k = 1 AND m > 2").select(F.col("rest").alias("key"), F.col("a").alias("longest"))
    longest = right.unionByName(left).groupBy("key").agg(F.max("longest").alias("longest"))
    open_ = candidates.join(best, "key").join(longest, "key", "left").where(
        F.coalesce(exact("longest") * 100 < exact("a") * subsumed_percent, F.lit(True)))
    open_ = scratch.stage(open_.drop("longest", "k"), "scored")

    # What is below the last rank by score and count needs no spelling.
    by_value = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    last = open_.select("lang", "score", "a", F.row_number().over(by_value).alias("place")).where(F.col("place") <= top)
    last = last.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    listed = open_.join(last, "lang").where(F.struct("score", "a") >= F.col("last"))
    words = listed.select("key", "lang", F.posexplode(F.array(*[f"w{i + 1}" for i in range(4)])).alias("i", "w1"), "m").where("i < m")
    spelt = words.join(phrases[0].select("lang", "w1", "text"), ["lang", "w1"]).groupBy("key").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("i", F.col("text").cast("string").alias("t"))))["t"], " ").alias("phrase"))
    totals = levels[0].where("key IS NULL").groupBy("prefix").agg(F.sum("f").alias("n"))
    names = langs.select(F.col("prefix").alias("lang"), F.col("lang").alias("name")).join(totals.withColumnRenamed("prefix", "lang"), "lang")
    ranked = listed.join(spelt, "key").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(names, "lang").select(F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
