"""Removal of word sequences that occur earlier in the corpus, by difference-cover anchors.

A window is ``window`` consecutive words of a document. Positions of a document whose number modulo a period lies in
a difference cover are anchor positions: for any two positions some shift below the period brings both onto
the cover. An anchor hashes window - period + 1 words, so two equal windows always share an anchor at the
same offset, while only 4 of 13 positions are hashed.

1. Anchors are exchanged by hash; those that occur more than once go back to their documents.
2. Documents extend their shared anchors to the windows around them, which are exchanged by a 128-bit hash; every
   occurrence but the first (smallest document, then position) goes back as a repeat.
3. Words that a repeated window covers are removed.

Before each exchange a task settles what it can see alone and sends one entry per hash, so that a passage of a third
of all documents is one entry per task and not one per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import (
    Scratch, by_bucket, gram_hashes, one_row_per_id, pack, packed_schema, partitions, runs, text_chunks, tokens, unpack,
)

#: A difference cover: every difference modulo PERIOD is one of two members. Fixed values.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Multiplier of the second hash of a window, odd.
OTHER_BASE = 0xD1342543DE82EF95
ENTRIES = packed_schema("first", "second", "id", "pos")
PLACES = packed_schema("id", "pos")
#: What is left of each document.
CUT = "id long, n_words long, n_removed long, removed array<struct<start: long, length: long>>, kept string"


def places(ids: list, texts: list[bytes]):
    """Word hashes of all texts, and for each word its document (index), id and position."""
    h, counts = tokens(texts, lower=False)
    row = np.repeat(np.arange(len(texts)), counts)
    starts = np.cumsum(counts) - counts
    pos = np.arange(len(h)) - np.repeat(starts, counts)
    return h, row, np.asarray(ids, np.int64), pos, counts


def _entries(buckets: int, first, second, id_, pos) -> pa.RecordBatch:
    """Hashes that occur at a place, for the task of their hash."""
    return pack((first % np.uint64(buckets)).astype(np.int64), buckets, first=first, second=second, id=id_, pos=pos.astype(np.int32))


def _found(buckets: int, id_, pos) -> pa.RecordBatch:
    """Places for the task of their document; there is no hash in these rows, and reducers hand them on."""
    order = np.lexsort((pos, id_))
    id_, pos = id_[order], pos[order].astype(np.int32)
    return pack(id_ % buckets, buckets, first=None, second=None, id=id_, pos=pos)


def _anchors(window: int, buckets: int):
    size = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches):
            h, row, ids, pos, counts = places(ids, texts)
            g = gram_hashes(h, size)
            if not len(g):
                continue
            good = (row[:len(g)] == row[size - 1:]) & np.isin(pos[:len(g)] % PERIOD, COVER) & (counts[row[:len(g)]] >= window)
            at = np.flatnonzero(good)
            at = at[np.argsort(g[at], kind="stable")]
            g = g[at]
            start = runs(g)
            length = np.diff(np.append(start, len(g)))
            shared = np.repeat(length > 1, length)
            yield _entries(buckets, g[start], None, ids[row[at[start]]], pos[at[start]])
            if shared.any():
                yield _found(buckets, ids[row[at[shared]]], pos[at[shared]])

    return run


def _repeated(buckets: int, keep_first: bool):
    """Places whose hash occurs more than once; without the first of each if ``keep_first``."""
    def run(table: pa.Table) -> pa.Table:
        sent = table.filter(pa.compute.is_valid(table.column("first")))
        first, second = unpack(sent, "first", np.uint64), unpack(sent, "second", np.uint64)
        id_, pos = unpack(sent, "id", np.int64), unpack(sent, "pos", np.int32)
        if len(second):
            order = np.lexsort((pos, id_, second, first))
            same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
        else:
            order = np.argsort(first, kind="stable")
            same = first[order][1:] == first[order][:-1]
        again = np.append(False, same) if len(order) else np.zeros(0, bool)
        if not keep_first and len(order):
            again[:-1] |= same
        at = order[again]
        passed = table.filter(pa.compute.is_null(table.column("first"))).select(["bucket", "id", "pos"])
        own = pa.Table.from_batches([_found(buckets, id_[at], pos[at])]).select(["bucket", "id", "pos"])
        return pa.concat_tables([passed, own.cast(passed.schema)])

    return run


def _windows(window: int, buckets: int):
    """Windows around shared anchors: the first of each in this task as an entry, the others as repeats."""
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        at_id, at_pos = unpack(anchors, "id", np.int64), unpack(anchors, "pos", np.int32)
        wanted = docs.filter(pa.compute.is_in(docs.column("id"), pa.array(np.unique(at_id))))
        out = []
        if len(wanted):
            for ids, texts in text_chunks(wanted.select(["id", "text"]).to_batches()):
                h, row, ids, pos, counts = places(ids, texts)
                # where each document's words start, to find the anchors' places in the row of words
                starts = np.cumsum(counts) - counts
                by_id = np.argsort(ids)
                which = np.minimum(np.searchsorted(ids[by_id], at_id), len(ids) - 1)
                mine = ids[by_id[which]] == at_id
                marks = np.zeros(len(h) + 1, np.int64)
                marks[starts[by_id[which[mine]]] + at_pos[mine]] = 1
                seen = np.concatenate([[0], np.cumsum(marks)])
                one = gram_hashes(h, window)
                if not len(one):
                    continue
                i = np.arange(len(one))
                at = np.flatnonzero((row[i] == row[i + window - 1]) & (seen[i + PERIOD] > seen[i]))
                one, two = one[at], gram_hashes(h, window, OTHER_BASE)[at]
                own, place = ids[row[at]], pos[at]
                order = np.lexsort((place, own, two, one))
                one, two, own, place = one[order], two[order], own[order], place[order]
                again = np.append(False, (one[1:] == one[:-1]) & (two[1:] == two[:-1])) if len(one) else np.zeros(0, bool)
                out.append(_entries(buckets, one[~again], two[~again], own[~again], place[~again]))
                out.append(_found(buckets, own[again], place[again]))
        if not out:
            out = [_found(buckets, np.zeros(0, np.int64), np.zeros(0, np.int64))]
        return pa.concat_tables([pa.Table.from_batches([b]) for b in out])

    return run


def _cut(window: int):
    def run(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        at_id, at_pos = unpack(repeats, "id", np.int64), unpack(repeats, "pos", np.int32)
        order = np.argsort(at_id, kind="stable")
        at_id, at_pos = at_id[order], at_pos[order]
        ids = docs.column("id").to_pylist()
        rows = []
        for id_, text in zip(ids, docs.column("text").cast(pa.binary()).to_pylist()):
            words = (text or b"").split()
            spans: list[dict] = []
            a, b = np.searchsorted(at_id, id_, "left"), np.searchsorted(at_id, id_, "right")
            if b > a:
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, at_pos[a:b], 1)
                np.add.at(steps, at_pos[a:b] + window, -1)
                gone = np.cumsum(steps[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans = [{"start": int(s), "length": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]
                words = [w for w, g in zip(words, gone) if not g]
            removed = sum(s["length"] for s in spans)
            rows.append((id_, len(words) + removed, removed, spans, b" ".join(words)))
        return pa.table(_arrays(rows), names=CUT_NAMES)

    return run


CUT_NAMES = ["id", "n_words", "n_removed", "removed", "kept"]


def _arrays(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]
    return [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(columns[4], pa.binary()).cast(pa.string())]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without an id, of which nothing is removed."""
    for batch in batches:
        words = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(_arrays([(None, len(w), 0, [], b" ".join(w)) for w in words]), names=CUT_NAMES)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept): what is left of each text without repeated windows.

    ``removed`` are the spans of removed words, ``kept`` the other words joined by one space. ``window`` is at least
    ``PERIOD``. Ids are integers. Null and empty texts have no words. Of rows that share an id the smallest text stands for
    all, in one row (``row_keys`` gives ids to rows); rows without an id are kept whole, since nothing can be earlier than they are or later. Other columns
    are not looked at.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "repeats")
    buckets = partitions(spark) | 1
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = one_row_per_id(plain, "doc_id", "text")
    anchors = docs.mapInArrow(_anchors(window, buckets), ENTRIES)
    anchors = scratch.stage(by_bucket(anchors, _repeated(buckets, False), PLACES, buckets), "anchors")
    keyed = docs.withColumn("bucket", F.pmod("id", F.lit(buckets)).cast("int"))
    windows = keyed.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(_windows(window, buckets), ENTRIES)
    repeats = scratch.stage(by_bucket(windows, _repeated(buckets, True), PLACES, buckets), "repeats")
    scratch.drop("anchors")
    cut = keyed.groupBy("bucket").cogroup(repeats.groupBy("bucket")).applyInArrow(_cut(window), CUT)
    # Rows without an id wait for nobody: they are a map beside the exchange.
    nameless = plain.where("doc_id IS NULL").mapInArrow(_whole, CUT)
    return cut.unionByName(nameless).withColumnRenamed("id", "doc_id")
