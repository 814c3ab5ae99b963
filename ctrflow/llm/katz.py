"""Bigram language model with Katz backoff and Good-Turing discounts.

P(w | v) = d(c) c(v w) / c(v) if the pair was seen, else alpha(v) P(w); P(w) = d(c) c(w) / N for known words, and
one class of unknown words takes what the discounts leave. alpha(v) makes P(. | v) sum to one exactly: it is what the
seen pairs leave, over what their second words leave of P(w).

Counts, model and scores move as packed arrays of word hashes:

1. pairs, counted per task, go to the task of their second word, which knows c(w) then and sends pairs with both
   counts on to the table of the model, stored by first word; how often each count occurs gives the discounts;
2. documents send their pairs to the same buckets by first word. A bucket holds all pairs of its first words, so
   alpha and every seen pair are there; P(w) of a token is added where the token is the first word.
   Sums per document leave the bucket. Documents take turns in waves, so that the exchange of one wave is on disk.

A frequent word would fill one bucket, so pairs of frequent words (at most 1000, from a sample that decides about nothing
but places) are spread by their other word. Sums of these few words travel through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import (
    BASE, Scratch, by_bucket, mix, one_row_per_id, pack, packed_schema, partitions, release, text_chunks, tokens, unpack,
)

#: Counts up to this are discounted.
DISCOUNTED = 5
#: Hashes of the begin and the end of a text.
BEGIN, END = np.uint64(0x51ED270B0A1F39C1), np.uint64(0xA0761D6478BD642F)
#: Share of all tokens from which a word is frequent, places it is spread over, documents looked at for it.
FREQUENT, SPREAD, LOOKED_AT = 1e-3, 16, 4000
#: Tokens of one bucket of the model on average, and least number of buckets.
BUCKET_TOKENS, LEAST_BUCKETS = 2_500_000, 24
#: Bytes of text whose pairs a task holds at a time.
PAIR_BYTES = 6 << 20
#: Parts the documents are scored in.
WAVES = 3

PAIRS = packed_schema("key", "run", "other", "count", "key_count")
USES = packed_schema("key", "run", "other", "count", "doc", "ids")


def discounts(n: dict[int, int]) -> np.ndarray:
    """Factors d(0..DISCOUNTED) of Good and Turing, after Katz; ``n`` tells how many events have each count.

    Where these are undefined (a count that does not occur, a factor outside (0, 1)) fewer counts are
    discounted; if none can be, half is taken off each small count.
    """
    for k in range(DISCOUNTED, 0, -1):
        if any(n.get(r, 0) == 0 for r in range(1, k + 2)):
            continue
        cut = (k + 1) * n[k + 1] / n[1]
        if cut >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (n[r] * r) - cut) / (1 - cut) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d, *[1.0] * (DISCOUNTED - k)])
    return np.array([1.0, *[(r - 0.5) / r for r in range(1, DISCOUNTED + 1)]])


@dataclass
class Statistics:
    """What tasks have to know of all counts: discounts of pairs and words, tokens, distinct tokens, frequent words."""

    pair: np.ndarray
    word: np.ndarray
    n: int
    v: int
    unknown: float
    counts: dict[int, int] = field(default_factory=dict)
    histories: dict[int, tuple[float, float, float]] = field(default_factory=dict)

    def discounted(self, count: np.ndarray) -> np.ndarray:
        return count * self.pair[np.where(count > DISCOUNTED, 0, count)]

    def p(self, count: np.ndarray) -> np.ndarray:
        """P(w) from c(w); 0 is an unknown word."""
        known = count * self.word[np.where(count > DISCOUNTED, 0, count)] / max(1, self.n)
        return np.where(count > 0, known * (1 - self.unknown) / self.known_mass, self.unknown)

    known_mass: float = 1.0

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.n + self.v + 1))


def history(count, discounted, seen) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, alpha) of first words from their count, the sum of discounted counts and of P(w) of seen words.

    A first word none of whose pairs is discounted leaves nothing; its denominator is one higher then.
    """
    denominator = np.where(count - discounted < 1e-9 * count, count + 1, count)
    return denominator, (1 - discounted / denominator) / np.maximum(1 - seen, 1e-12)


def pack_runs(bucket: np.ndarray, buckets: int, key: np.ndarray, **columns) -> pa.RecordBatch:
    """Like :func:`pack`, for entries sorted by ``key``, which is sent once per run of equal keys."""
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 65536 else bucket, kind="stable")
    placed, sorted_ = bucket[order], key[order]
    start = np.flatnonzero(np.concatenate([[True], (sorted_[1:] != sorted_[:-1]) | (placed[1:] != placed[:-1])])) if len(key) else np.zeros(0, int)
    length = np.diff(np.append(start, len(key))).astype(np.int32)
    left = pack(placed[start], buckets, key=sorted_[start], run=length)
    right = pack(bucket, buckets, **columns)
    return pa.RecordBatch.from_arrays([*left.columns, *right.columns[1:]], names=[*left.schema.names, *right.schema.names[1:]])


def pairs_of(texts: list[bytes]):
    """(distinct words in order, first word, second word, text) of all pairs, words by their index; a text has one pair more
    than words, since its begin and end count."""
    h, counts = tokens(texts)
    words, index = np.unique(np.concatenate([h, np.array([BEGIN, END], np.uint64)]), return_inverse=True)
    del h
    begin, end, index = index[-2], index[-1], index[:-2]
    ends = np.cumsum(counts)
    return words, np.insert(index, ends - counts, begin), np.insert(index, ends, end), np.repeat(np.arange(len(texts), dtype=np.int32), counts + 1)


def place(word: np.ndarray, other: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    at = mix(word)
    spread = np.isin(word, frequent)
    at[spread] = mix(word[spread] + mix(other[spread]) % np.uint64(SPREAD))
    return (at % np.uint64(buckets)).astype(np.int64)


def starts_of(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)


def _count_pairs(frequent: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, PAIR_BYTES):
            words, first, second, _ = pairs_of(texts)
            key = second * len(words) + first
            del first, second
            key.sort()
            start = starts_of(key)
            count, key = np.diff(np.append(start, len(key))).astype(np.int32), key[start]
            one, two = words[key % len(words)], words[key // len(words)]
            yield pack_runs(place(two, one, frequent, buckets), buckets, two, other=one, count=count, key_count=None)

    return run


def _add_counts(frequent: np.ndarray, buckets: int):
    """All pairs of some second words, with their counts, on to their first words; statistics under bucket -1, counts of
    frequent words under bucket -2."""
    def run(table: pa.Table) -> pa.Table:
        two = np.repeat(unpack(table, "key", np.uint64), unpack(table, "run", np.int32))
        one, count = unpack(table, "other", np.uint64), unpack(table, "count", np.int32).astype(np.int64)
        order = np.lexsort((one, two))
        one, two, count = one[order], two[order], count[order]
        start = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        one, two, count = one[start], two[start], np.add.reduceat(count, start)
        word = np.flatnonzero(np.concatenate([[True], two[1:] != two[:-1]]))
        total = np.add.reduceat(count, word)
        known = ~np.isin(two[word], frequent)
        two_count = np.repeat(np.where(known, total, 0), np.diff(np.append(word, len(two))))
        order = np.lexsort((two, one))
        one_, two_ = one[order], two[order]
        rows = pack_runs(place(one_, two_, frequent, buckets), buckets, one_, other=two_, count=count[order], key_count=two_count[order])
        codes = [*range(1, DISCOUNTED + 2), *range(101, 100 + DISCOUNTED + 2), 200, 201]
        values = [np.count_nonzero(count == r) for r in range(1, DISCOUNTED + 2)]
        values += [np.count_nonzero(total[known] == r) for r in range(1, DISCOUNTED + 2)] + [total[known].sum(), np.count_nonzero(known)]
        extra = pa.RecordBatch.from_arrays([
            pa.array([-1, -2], pa.int32()), pa.array([np.array(codes, np.uint64).tobytes(), two[word][~known].tobytes()]),
            pa.nulls(2, pa.binary()), pa.nulls(2, pa.binary()),
            pa.array([np.array(values, np.int64).tobytes(), total[~known].tobytes()]), pa.nulls(2, pa.binary())], names=rows.schema.names)
        return pa.Table.from_batches([rows, extra])

    return run


def _entries(table: pa.Table, stats: Statistics):
    """Pairs of a bucket: first words (one per run), run lengths, second words, counts, P of second words."""
    key, run = unpack(table, "key", np.uint64), unpack(table, "run", np.int32)
    other, count, other_count = unpack(table, "other", np.uint64), unpack(table, "count", np.int64), unpack(table, "key_count", np.int64).copy()
    open_ = np.flatnonzero(other_count == 0)
    other_count[open_] = [stats.counts.get(w, 0) for w in other[open_].tolist()]
    return key, run, other, count, stats.p(other_count)


def _frequent_histories(frequent: np.ndarray, stats: Statistics):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, length, _, count, p = _entries(pa.Table.from_batches([batch]), stats)
            at = np.cumsum(length) - length
            mine = np.flatnonzero(np.isin(key, frequent))
            sums = [np.add.reduceat(x, at)[mine] if len(x) else np.zeros(0) for x in (count.astype(float), stats.discounted(count), p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[mine].view(np.int64)), *map(pa.array, sums)], names=["word", "count", "discounted", "seen"])

    return run


def _send_uses(frequent: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, PAIR_BYTES):
            words, first, second, text = pairs_of(texts)
            key = first * len(words) + second
            del first, second
            order = np.argsort(key, kind="stable")
            key, text = key[order], text[order]
            start = starts_of(key)
            count, key = np.diff(np.append(start, len(key))).astype(np.int32), key[start]
            one, two = words[key // len(words)], words[key % len(words)]
            bucket = place(one, two, frequent, buckets)
            # Both packings keep the order inside a bucket, so the uses of a pair stay where its count says.
            rows = pack_runs(bucket, buckets, one, other=two, count=count)
            docs = pack(np.repeat(bucket, count), buckets, doc=text.astype(np.uint16 if len(ids) <= 65536 else np.int32))
            named = pa.array([np.asarray(ids, np.int64).tobytes()] * len(rows), pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, docs.column(1), named], names=[*rows.schema.names, "doc", "ids"])

    return run


def _score(stats: Statistics):
    def run(uses: pa.Table, model: pa.Table) -> pa.Table:
        key, length, other, count, p = _entries(model, stats)
        word, number = np.unique(key, return_inverse=True)
        number = np.repeat(number, length)
        n, less, seen = (np.bincount(number, x, len(word)) for x in (count, stats.discounted(count), p))
        under, alpha = history(np.maximum(n, 1), less, seen)
        for i, w in enumerate(word.tolist() if len(stats.histories) else []):
            if w in stats.histories:
                n[i], under[i], alpha[i] = stats.histories[w]
        pair = mix(np.repeat(key, length) * np.uint64(BASE) + mix(other))
        gain = np.log10(stats.discounted(count) / under[number]) - np.log10(p)
        order = np.argsort(pair)
        pair, gain = pair[order], gain[order]
        del key, length, other, count, p, number, less, seen, order
        backoff = np.log10(alpha)
        often = np.array(sorted(stats.histories), np.uint64)
        often_sums = np.array([stats.histories[w] for w in often.tolist()]).reshape(-1, 3)
        out = []
        for i in range(len(uses)):
            row = uses.slice(i, 1)
            first, run_ = unpack(row, "key", np.uint64), unpack(row, "run", np.int32)
            second, times = unpack(row, "other", np.uint64), unpack(row, "count", np.int32)
            ids = unpack(row, "ids", np.int64)
            doc = unpack(row, "doc", np.uint16 if len(ids) <= 65536 else np.int32).astype(np.int64)
            at = np.minimum(np.searchsorted(word, first), max(0, len(word) - 1))
            known = word[at] == first if len(word) else np.zeros(len(first), bool)
            which = np.minimum(np.searchsorted(often, first), max(0, len(often) - 1))
            frequent = often[which] == first if len(often) else np.zeros(len(first), bool)
            first_count, first_backoff = np.zeros(len(first)), np.zeros(len(first))
            if len(often):  # its sums may stand in other buckets only
                first_count, first_backoff = np.where(frequent, often_sums[which, 0], 0), np.where(frequent, np.log10(often_sums[which, 2]), 0)
            if len(word):
                first_count, first_backoff = np.where(known, n[at], first_count), np.where(known, backoff[at], first_backoff)
            inner = first != BEGIN  # the begin is no token
            count_ = first_count.astype(np.int64)
            alone = np.where(inner, np.log10(stats.p(count_)), 0)
            base, is_known = np.where(inner, stats.base(count_), 0), np.where(inner, count_ > 0, False)
            asked = mix(np.repeat(first, run_) * np.uint64(BASE) + mix(second))
            found = np.minimum(np.searchsorted(pair, asked), max(0, len(pair) - 1))
            hit = pair[found] == asked if len(pair) else np.zeros(len(asked), bool)
            value = np.repeat(first_backoff, run_)
            if len(pair):
                value = np.where(hit, gain[found], value)
            value = value + np.repeat(alone, run_)
            sums = [np.bincount(doc, np.repeat(x, times), len(ids)) for x in (value, np.repeat(base, run_), np.repeat(is_known, run_))]
            pairs = np.bincount(doc, minlength=len(ids))
            full = np.flatnonzero(pairs)
            out.append(pa.table(
                [pa.array(ids[full]), pa.array(pairs[full]), pa.array(sums[2][full].astype(np.int64)), pa.array(sums[1][full]), pa.array(sums[0][full])],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        del pair, gain
        release()
        if not out:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())],
                            names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
        return pa.concat_tables(out)

    return run


def frequent_words(docs: DataFrame) -> np.ndarray:
    """Hashes of words with a share of at least FREQUENT of the tokens of about LOOKED_AT documents, begin and end included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            word, count = np.unique(tokens(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "count"])

    sample = docs.sample(min(1.0, LOOKED_AT / max(1, docs.count())), seed=7)
    counts = sample.mapInArrow(run, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    found = counts.where(F.col("count") >= max(1.0, FREQUENT * total)).orderBy(F.desc("count"), "word").limit(int(1 / FREQUENT))
    words = np.array([r[0] for r in found.collect()], np.int64).view(np.uint64)
    return np.unique(np.concatenate([words, [BEGIN, END]]))


def katz_scores(df: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The model learns from documents for which ``is_training`` (a condition on the columns of ``df``) holds. Tokens are the lower-cased
    (A-Z) words and one end; a null text is empty and has the end only. ``base_score`` is the add-one unigram score, ``score``
    the log10 probability of the text. Words are told apart by 64-bit hashes. Of rows that share an id the smallest text stands for
    all, in one row; rows without an id take no part (``row_keys`` gives ids to rows). Without training documents every token is unknown, with probability one.
    Other columns are not looked at.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "katz")
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), is_training.alias("trains"))
    rows = one_row_per_id(plain, "doc_id", "text", "trains")
    docs, training = rows.drop("trains"), rows.where("trains").drop("trains")
    frequent = frequent_words(docs)
    # About one token in six bytes of text decides on the number of buckets only.
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, math.ceil(size / 6 / BUCKET_TOKENS))
    first_buckets = max(partitions(spark), buckets) | 1

    counted_ = training.mapInArrow(_count_pairs(frequent, first_buckets), PAIRS)
    model = scratch.stage(by_bucket(counted_, _add_counts(frequent, buckets), PAIRS, first_buckets), "model")
    stats = _statistics(model)
    found = model.where("bucket >= 0").mapInArrow(
        _frequent_histories(frequent, stats), "word long, count double, discounted double, seen double")
    for r in found.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("count", "discounted", "seen")]).collect():
        under, alpha = history(np.array([r["count"]]), np.array([r["discounted"]]), np.array([r["seen"]]))
        stats.histories[r["word"] % (1 << 64)] = r["count"], float(under[0]), float(alpha[0])

    # The uses of a wave of documents are on disk at a time.
    place_ = model.where("bucket >= 0")
    waves = []
    for wave in range(WAVES):
        part = docs.where(F.pmod(F.xxhash64("id", F.lit("wave")), F.lit(WAVES)) == wave)
        uses = part.mapInArrow(_send_uses(frequent, buckets), USES)
        waves.append(scratch.stage(uses.groupBy("bucket").cogroup(place_.groupBy("bucket")).applyInArrow(
            _score(stats), "doc_id long, n_tokens long, n_known long, base_score double, score double"), f"sums-{wave}"))
        scratch.free()
    scratch.drop("model")
    sums = reduce(DataFrame.unionByName, waves)
    end = np.array([stats.counts.get(int(END), 0)])
    return sums.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"), (F.sum("n_known") + int(end[0] > 0)).alias("n_known"), F.lit(stats.n).cast("long").alias("train_tokens"),
        (F.sum("base_score") + float(stats.base(end)[0])).alias("base_score"),
        (F.sum("score") + float(np.log10(stats.p(end))[0])).alias("score"))


def _statistics(model: DataFrame) -> Statistics:
    total: dict[int, int] = {}
    counts: dict[int, int] = {}
    for row in model.where("bucket < 0").select("bucket", "key", "count").toLocalIterator():
        into = total if row["bucket"] == -1 else counts
        for k, v in zip(np.frombuffer(row["key"], np.uint64).tolist(), np.frombuffer(row["count"], np.int64).tolist()):
            into[k] = into.get(k, 0) + v
    words = {r: total.get(100 + r, 0) + sum(c == r for c in counts.values()) for r in range(1, DISCOUNTED + 2)}
    n, v = total.get(200, 0) + sum(counts.values()), total.get(201, 0) + len(counts)
    factor = discounts(words)
    left = sum(words[r] * r * (1 - factor[r]) for r in range(1, DISCOUNTED + 1))
    # Where nothing is discounted the unknown words count as one token.
    unknown = left / n if left > 0 else 1 / (n + 1)
    stats = Statistics(discounts({r: total.get(r, 0) for r in range(1, DISCOUNTED + 2)}), factor, n, v, unknown, counts)
    stats.known_mass = 1 - left / n if n else 1.0
    return stats
