"""N-gram Jaccard join: documents whose shingle sets overlap by a given share, and what they connect to.

Sizes fall into bands, so that two sets that may link lie in the same band or in neighbouring ones. Two sets
of a band that link differ in fewer than D elements; the hash range is cut into more than D segments, so as many as there are
above D - 1 are equal in both. Each set therefore leaves out that many of its segments but one, the most common ones; segments
that no other set has are the rarest. Sets with few equal segments are left with none, such as those that only share a passage.
Documents with an equal segment that is left are candidates and their groups (connected candidates) are verified:

1. every member against the first of its group;
2. members that fail that against all members, in tiles of bounded size by size band. In a tile hashed
   bitmaps of the sets bound each overlap from above by their bit counts, and pairs that may reach the
   share are intersected exactly as sorted arrays.

Equal sets are linked by a hash of the whole set. Segments are counted by sets, and only the smallest document of a set is
verified, so copies move their text no further.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import (
    BASE, Scratch, by_bucket, gram_hashes, mix, one_row_per_id, pack, packed_schema, partitions, release, runs, text_chunks, tokens, unpack,
)
from ctrflow.llm.components import components

#: Shingles and documents on each side of a tile, on average.
TILE_SHINGLES, TILE_DOCUMENTS = 2_000_000, 4000
#: Tasks of the exchange of hashes, times those of others, and slices of the hashes that a task sorts one after the other.
FINER, SLICES = 2, 4
#: Bytes of text whose sets and signatures of two bands a task holds at a time.
SENT_BYTES = 4 << 20
#: Documents looked at for common shingles, and documents among them that make a shingle common.
LOOKED_AT, LEAST_COMMON = 4000, 3
#: Kinds of rows: hashes of a set, an equal pair, a document with its set size, hashes that a set can spare, the first document of a set.
CANDIDATE, EQUAL, SIZE, SPARE, SET = 0, 1, 2, 3, 4
#: Classes of the hashes of a set: two bands, of rare and of all elements.
CLASSES = 4
ENTRIES = packed_schema("kind", "hash", "id", "other")
SETTLED = "kind int, a long, b long, " + packed_schema("hash", "set", "often", "spare")
SETTLED_NAMES = ["kind", "a", "b", "bucket", "hash", "set", "often", "spare"]


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text; of the whole text if it has fewer words."""
    h, counts = tokens(texts)
    grams = gram_hashes(h, n)
    out, at = [], 0
    for c in counts:
        if c >= n:
            found = np.unique(grams[at:at + c - n + 1])
        elif c:
            found = mix(gram_hashes(h[at:at + c], int(c)) + np.uint64(c))
        else:
            found = np.zeros(0, np.uint64)
        out.append(found)
        at += c
    return out


@lru_cache(64)
def bands(percent: int, most: int) -> np.ndarray:
    """First sizes of all bands up to ``most`` and one beyond: sizes n <= m with 100 n >= percent m lie in the same
    band or in neighbours."""
    edges = [1]
    while len(edges) < 2 or edges[-2] <= most:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges)


def band_of(sizes: np.ndarray, percent: int) -> np.ndarray:
    most = 1 << max(8, int(max(sizes, default=1)).bit_length())
    return np.searchsorted(bands(percent, most), sizes, "right") - 1


def segments(band: int, percent: int) -> tuple[int, int]:
    """(segments of a band, segments that a set must have to be sure to share one)."""
    edges = bands(percent, 256)
    most = int(edges[band + 1] if band + 1 < len(edges) else bands(percent, 1 << 40)[band + 1]) - 1
    needed = 2 * most * (100 - percent) // (100 + percent) + 1
    return needed + (needed * (100 - percent) // 80 + 2 if needed > 1 else 0), needed


def signatures(found: np.ndarray, band: int, percent: int, kind: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the segments of one set (sorted) as a member of ``band``, which of them have elements, and by how many these
    are more than needed. ``kind`` keeps apart what must not meet; it and the band are told by the hash modulo CLASSES."""
    count, needed = segments(band, percent)
    cut = np.searchsorted(found >> np.uint64(32), np.arange(1, count, dtype=np.uint64) * np.uint64(1 << 32) // np.uint64(count))
    cut = np.concatenate([[0], cut, [len(found)]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found + np.uint64(1)), dtype=np.uint64)])
    salt = np.uint64((band << 40) + (kind << 60)) + np.uint64(BASE)
    value = mix(sums[cut[1:]] - sums[cut[:-1]] + mix(np.arange(count, dtype=np.uint64) + salt))
    value = value - value % np.uint64(CLASSES) + np.uint64(2 * kind + band % 2)
    held = np.diff(cut) > 0
    return value, held, int(np.count_nonzero(held)) - needed


def candidate_hashes(found: np.ndarray, rare: np.ndarray, band: int, percent: int) -> list[tuple[np.ndarray, int]]:
    """What two sets that link have in common at least one of, by class, and how many hashes of a class they can do without:
    that many more are in common.

    The bound on differing elements holds for the elements outside any fixed set of shingles too, so common ones are left
    out (``rare``), which keeps documents apart that only share a passage. Empty segments do not count. A set with too few
    others also sends those of all its elements, and the empty ones too if even these are too few.
    """
    value, held, more = signatures(rare, band, percent, 0)
    out = [(value[held], max(0, more))]
    if more < 0:
        value, held, more = signatures(found, band, percent, 1)
        out.append((value[held] if more >= 0 else value, max(0, more)))
    return out


def common_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """Hashes of shingles that at least LEAST_COMMON of about LOOKED_AT documents share. Any set gives the same result; this
    one decides how many candidates there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            sets = shingle_sets(texts, n)
            hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "count"])

    sample = docs.sample(min(1.0, LOOKED_AT / max(1, docs.count())), seed=7)
    counts = sample.mapInArrow(run, "hash long, count long").groupBy("hash").agg(F.sum("count").alias("count"))
    found = counts.where(f"count >= {LEAST_COMMON}").select("hash").toArrow()
    return np.sort(np.asarray(found.column("hash")).astype(np.int64).view(np.uint64))


def _send(n: int, percent: int, buckets: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, SENT_BYTES):
            ids = np.asarray(ids, np.int64)
            by_id = np.argsort(ids, kind="stable")  # the first document of a set is the smallest
            ids = ids[by_id]
            sets = shingle_sets([texts[i] for i in by_id], n)
            sizes = np.array([len(s) for s in sets], np.int64)
            whole = np.array([mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))[0] if len(s) else 0 for s in sets], np.uint64)
            full = np.flatnonzero(sizes)
            first: dict[int, int] = {}
            copy_of = np.array([first.setdefault(w, i) for i, w in zip(full, whole[full].tolist())], np.int64)
            own = full[copy_of == full]
            copies = full[copy_of != full]
            band = band_of(sizes, percent)
            hashes, spare = [], []
            known = common.value
            for i in own:
                found = np.minimum(np.searchsorted(known, sets[i]), max(0, len(known) - 1))
                rare = sets[i][known[found] != sets[i]] if len(known) else sets[i]
                for b in (int(band[i]), int(band[i]) + 1):
                    for h, more in candidate_hashes(sets[i], rare, b, percent):
                        if len(h):
                            hashes.append(h)
                            spare.append((i, len(h), more * CLASSES + int(h[0]) % CLASSES))
            row, length, spare = np.array(spare, np.int64).reshape(-1, 3).T
            h = np.concatenate([*hashes, whole[own]])
            one = np.concatenate([np.repeat(whole[row], length).view(np.int64), ids[own]])
            kind = np.repeat(np.array([CANDIDATE, EQUAL], np.int8), [len(h) - len(own), len(own)])
            yield pack((h % np.uint64(buckets)).astype(np.int64), buckets, kind=kind, hash=h, id=one, other=None)
            # the rest is settled and handed on
            kind = np.repeat(np.array([EQUAL, SIZE, SPARE], np.int8), [len(copies), len(ids), len(row)])
            one = np.concatenate([ids[copy_of[copy_of != full]], ids, whole[row].view(np.int64)])
            other = np.concatenate([ids[copies], sizes, spare])
            yield pack(one.view(np.uint64) % np.uint64(buckets), buckets, kind=kind, hash=None, id=one, other=other)

    return run


def _shared(h: np.ndarray, ids: np.ndarray, wanted: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, set, sets that have the hash) where these are several, of one slice of the hashes."""
    at = np.flatnonzero(wanted & (h >> np.uint64(32) & np.uint64(SLICES - 1) == np.uint64(part)))
    at = at[np.lexsort((ids[at], h[at]))]
    value, of = h[at], ids[at].view(np.uint64)
    new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])) if len(value) else np.zeros(0, bool)
    value, of = value[new], of[new]
    start = runs(value)
    often = np.diff(np.append(start, len(value)))
    often = np.repeat(np.minimum(often, 65535).astype(np.uint16), often)
    return value[often > 1], of[often > 1], often[often > 1]


def _settle(buckets: int):
    """Hashes that several sets have, with their number, for the task of each set; of documents with an equal set, the smallest
    with its set and with each other one. What tasks have settled is handed on."""
    def run(table: pa.Table) -> pa.Table:
        sent = table.filter(pa.compute.is_valid(table.column("hash")))
        rest = table.filter(pa.compute.is_null(table.column("hash")))
        kind, h, ids = (unpack(sent, c, t) for c, t in (("kind", np.int8), ("hash", np.uint64), ("id", np.int64)))
        del table, sent
        found = [_shared(h, ids, kind == CANDIDATE, part) for part in range(SLICES)]
        value, of, often = (np.concatenate(x) for x in zip(*found))
        shared = pack(of % np.uint64(buckets), buckets, hash=value, set=of, often=often, spare=None)

        at = np.flatnonzero(kind == EQUAL)
        value, of = h[at], ids[at]
        order = np.lexsort((of, value))
        value, of = value[order], of[order]
        start = runs(value)
        head = np.repeat(of[start], np.diff(np.append(start, len(of))))

        del h, ids
        kind, one, other = unpack(rest, "kind", np.int8), unpack(rest, "id", np.int64), unpack(rest, "other", np.int64)
        of_set, spare = one[kind == SPARE].view(np.uint64), other[kind == SPARE]
        spared = pack(of_set % np.uint64(buckets), buckets, hash=(spare % CLASSES).astype(np.uint64), set=of_set, often=None,
                      spare=(spare // CLASSES).astype(np.int32))
        plain = kind != SPARE
        again = head != of
        kind = np.concatenate([kind[plain], np.repeat(np.array([EQUAL, SET], np.int8), [np.count_nonzero(again), len(start)])])
        one = np.concatenate([one[plain], head[again], of[start]])
        other = np.concatenate([other[plain], of[again], value[start].view(np.int64)])
        nothing = pa.nulls(len(kind), pa.binary())
        numbers = pa.table([pa.array(kind, pa.int32()), pa.array(one), pa.array(other), pa.nulls(len(kind), pa.int32()), *[nothing] * 4], SETTLED_NAMES)
        packed = pa.Table.from_batches([shared, spared])
        nothing = pa.nulls(len(packed), pa.int64())
        packed = pa.table([pa.array(np.full(len(packed), CANDIDATE, np.int32)), nothing, nothing, *packed.columns], SETTLED_NAMES)
        release()
        return pa.concat_tables([numbers, packed])

    return run


def _rarest(buckets: int):
    """Of the shared hashes of each set and class, the rarest: all but as many as it can spare.

    Sets that link share all hashes of one of them but those that differing elements change. So they also share one when each
    leaves out its most common ones, by an order that is the same for all, up to the number that may be shared besides one.
    Hashes that no other set has come first in this order.
    """
    def run(table: pa.Table) -> pa.Table:
        bounds = pa.compute.is_valid(table.column("spare"))
        sent, rest = table.filter(pa.compute.invert(bounds)), table.filter(bounds)
        spare = unpack(rest, "spare", np.int32)
        h = np.concatenate([unpack(rest, "hash", np.uint64), unpack(sent, "hash", np.uint64)])
        of = np.concatenate([unpack(rest, "set", np.uint64), unpack(sent, "set", np.uint64)])
        often = np.concatenate([np.zeros(len(spare), np.uint16), unpack(sent, "often", np.uint16)])  # bounds come first
        spare = np.concatenate([spare, np.zeros(len(h) - len(spare), np.int32)])
        kind = (h % np.uint64(CLASSES)).astype(np.uint8)
        order = np.lexsort((h, often, kind, of))
        h, of, often, spare, kind = h[order], of[order], often[order], spare[order], kind[order]
        start = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (kind[1:] != kind[:-1]))) if len(h) else np.zeros(0, np.int64)
        length = np.diff(np.append(start, len(h)))
        after = np.repeat(start + length, length) - np.arange(len(h))  # 1 for the last of a class
        kept = (often > 0) & (after > np.repeat(spare[start], length))
        h, of = h[kept], of[kept]
        return pa.Table.from_batches([pack(h % np.uint64(buckets), buckets, hash=h, set=of)])

    return run


def _stars(table: pa.Table) -> pa.Table:
    """Of sets with an equal hash, the smallest with each other one."""
    h, of = unpack(table, "hash", np.uint64), unpack(table, "set", np.int64)
    order = np.lexsort((of, h))
    h, of = h[order], of[order]
    start = runs(h)
    head = np.repeat(of[start], np.diff(np.append(start, len(h))))
    head, of = head[head != of], of[head != of]
    order = np.lexsort((of, head))
    head, of = head[order], of[order]
    new = np.append(True, (head[1:] != head[:-1]) | (of[1:] != of[:-1])) if len(of) else np.zeros(0, bool)
    return pa.table([pa.array(head[new]), pa.array(of[new])], names=["a", "b"])


def _families(rows: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    """(id, family) of the smallest document of each set that is a candidate; ``family`` is the first of those that
    candidates connect."""
    shared = rows.where(f"kind = {CANDIDATE}").select("bucket", "hash", "set", "often", "spare")
    rarest = by_bucket(shared, _rarest(buckets), packed_schema("hash", "set"), buckets)
    # A table of its own, so that no task needs two Python workers at once.
    stars = scratch.stage(by_bucket(rarest, _stars, "a long, b long", buckets), "stars")
    found = components(stars, scratch, "families")
    sets = rows.where(f"kind = {SET}").select(F.col("a").alias("first"), F.col("b").alias("id"))
    found = scratch.stage(found.join(sets, "id").select(F.col("first").alias("id"), "component"), "sets")
    named = found.groupBy("component").agg(F.min("id").alias("family"))
    named = scratch.stage(found.join(named, "component").select("id", "family"), "named")
    scratch.drop("stars", "sets")
    return named


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sets as sorted arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small)
    return 100 * common >= percent * (len(a) + len(b) - common)


def bitmaps(sets: list[np.ndarray], words: int) -> np.ndarray:
    """A bit for the hash of each element, in ``words`` 64-bit words (a power of two)."""
    out = np.zeros((len(sets), words), np.uint64)
    for row, s in zip(out, sets):
        bit = s & np.uint64(64 * words - 1)
        np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def _against_first(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            ids, texts, firsts, first_texts = (batch.column(i) for i in range(4))
            firsts, first_texts = firsts.to_pylist(), first_texts.cast(pa.binary())
            result, sizes = [], []
            # The text of the first member repeats in neighbouring rows; its set is made once for them.
            for i, (first, text) in enumerate(zip(firsts, texts.cast(pa.binary()).to_pylist())):
                if known[0] != first:
                    known = first, shingle_sets([first_texts[i].as_py() or b""], n)[0]
                own = shingle_sets([text or b""], n)[0]
                result.append(linked(known[1], own, percent))
                sizes.append(len(own))
            band = band_of(np.array(sizes, np.int64), percent).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(2), pa.array(sizes, pa.int64()), pa.array(band), pa.array(result, pa.bool_())],
                names=["id", "family", "size", "band", "linked"])

    return run


def _tile(n: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        sets = shingle_sets([t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()], n)
        sizes = np.array([len(s) for s in sets])
        ids, open_ = np.asarray(table.column("id")), np.asarray(table.column("open"))
        up, low = np.flatnonzero(open_), np.flatnonzero(~open_)
        words = 1 << max(2, int(8 * max(sizes, default=1) // 64).bit_length())
        bits = bitmaps(sets, words)
        root = dict(zip(ids.tolist(), np.asarray(table.column("component")).tolist()))
        joined: dict[int, int] = {}

        def find(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        found = []
        for i in up:
            # What the first has and the second has not is at least the number of bits that only the first has set.
            alone = np.bitwise_count(bits[i] & ~bits[low]).sum(axis=1, dtype=np.int64)
            other = np.bitwise_count(bits[low] & ~bits[i]).sum(axis=1, dtype=np.int64)
            common = np.minimum(sizes[i] - alone, sizes[low] - other)
            for j in low[100 * common >= percent * (sizes[i] + sizes[low] - common)]:
                a, b = find(root[int(ids[i])]), find(root[int(ids[j])])
                if a != b and linked(sets[i], sets[j], percent):
                    found.append((int(ids[i]), int(ids[j])))
                    joined[max(a, b)] = min(a, b)
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _hash_block(column, number):
    return F.pmod(F.xxhash64(column, F.lit("block")), number).cast("int")


def _open_tiles(members: DataFrame) -> DataFrame:
    """(tile, id, component, open): members not linked to the first of their family (open) with all members of it.

    ``members`` has (id, family, size, band, linked). Blocks hold documents of a family, side and size band; a tile is a block
    of open members with a block of all members of the same band or a neighbour. Only ids are placed here; texts follow.
    """
    rows = members.withColumn("component", F.when(F.col("linked"), F.col("family")).otherwise(F.col("id")))
    rows = rows.join(rows.where("NOT linked").select("family").distinct(), "family", "left_semi")

    def side(of: DataFrame, name: str):
        number = F.greatest(F.sum("size") / TILE_SHINGLES, F.count("*") / TILE_DOCUMENTS)
        number = of.groupBy("family", "band").agg(F.ceil(number).cast("int").alias("number"))
        blocks = number.select("family", F.col("band").alias(f"{name}_band"), F.explode(F.sequence(F.lit(0), F.col("number") - 1)).alias(f"{name}_block"))
        placed = of.join(number, ["family", "band"]).select(
            "family", "id", "component", F.col("band").alias(f"{name}_band"), _hash_block("id", F.col("number")).alias(f"{name}_block"))
        return blocks, placed

    blocks_up, up = side(rows.where("NOT linked"), "up")
    blocks_low, low = side(rows, "low")
    tiles = blocks_up.join(blocks_low, "family").where("abs(up_band - low_band) <= 1").withColumn(
        "tile", F.xxhash64("family", "up_band", "up_block", "low_band", "low_block"))
    columns = ["tile", "id", "component"]
    return up.join(tiles, ["family", "up_band", "up_block"]).select(*columns, F.lit(True).alias("open")).unionByName(
        low.join(tiles, ["family", "low_band", "low_block"]).select(*columns, F.lit(False).alias("open")))


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    Words are lower-cased in A-Z; a set holds the distinct ``n``-word shingles, or the whole sequence if there are fewer
    words. Two documents link when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id that
    links lead to, the document's own included. Shingles are told apart by 64-bit hashes.

    Documents without words have no shingles and link with nothing. Ids are integers. Of rows that share an id the
    smallest text stands for all, in one row (``row_keys`` gives ids to rows); each row without an id is returned with null ids and no links. Other columns
    are not looked at.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "jaccard")
    buckets = partitions(spark) | 1
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = one_row_per_id(plain, "doc_id", "text")
    common = spark.sparkContext.broadcast(common_shingles(docs, n))
    finer = FINER * partitions(spark) | 1
    sent = docs.mapInArrow(_send(n, percent, finer, common), ENTRIES)
    rows = scratch.stage(by_bucket(sent, _settle(buckets), SETTLED, finer), "pairs")
    sizes = rows.where(f"kind = {SIZE}").select(F.col("a").alias("id"), F.col("b").alias("n"))
    families = _families(rows, buckets, scratch)

    # Both small sides grow with the documents, so neither is left to be broadcast: the plan is the same at every size.
    members = docs.join(families.hint("merge"), "id").select("id", "text", "family")
    members = scratch.stage(members, "members")
    firsts = members.where("id = family").select("family", F.col("text").alias("first_text"))
    checked = members.join(firsts.hint("merge"), "family").select("id", "text", "family", "first_text").mapInArrow(
        _against_first(n, percent), "id long, family long, size long, band int, linked boolean")
    checked = scratch.stage(checked, "checked")
    tiles = scratch.stage(_open_tiles(checked), "tiles").join(members.select("id", "text"), "id")
    more = scratch.stage(tiles.groupBy("tile").applyInArrow(_tile(n, percent), "a long, b long"), "more")
    scratch.drop("members", "tiles")
    links = rows.where(f"kind = {EQUAL}").select("a", "b").unionByName(
        checked.where("linked AND id <> family").select(F.col("family").alias("a"), F.col("id").alias("b"))).unionByName(more)
    found = components(links, scratch, "links")
    scratch.drop("checked", "more")
    named = sizes.join(found, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    nameless = plain.where("doc_id IS NULL").select("text").mapInArrow(_nameless(n), "n_shingles long")
    return named.unionByName(nameless.select(
        F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))


def _nameless(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()], n)
            yield pa.RecordBatch.from_arrays([pa.array([len(s) for s in sets], pa.int64())], names=["n_shingles"])

    return run
