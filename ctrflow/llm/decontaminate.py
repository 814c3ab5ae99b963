"""Benchmark decontamination: a generalised suffix automaton of the test items, through which training texts are streamed.

The automaton of all items accepts every run of words that some item has. Reading a text word by word keeps the state of
the longest run that ends at the word; runs of ``min_words`` words or more are hits, as are items that are shorter than
that and occur whole. A state of the automaton stands for all runs that end at the same places of the items, so the
items of a window of ``min_words`` words are kept once, at the state of the window.

Items are cut into segments that overlap by ``min_words - 1`` words, so no window is lost, and segments are dealt to
passes of a bounded number of words. The automaton of a pass is built in a task, bounded by these words, and broadcast;
texts go through it in a map, without a shuffle. Usual benchmarks are one pass; the spans of several are merged by row.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import Scratch, ids_of_keys, row_keys, text_chunks

#: Bytes of words, A-Z as a-z; all others separate.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
#: Words of a pass: its automaton has at most twice as many states, about 300 bytes each in a Python worker.
PASS_WORDS = 300_000
#: Words of a segment of a long item.
SEGMENT_WORDS = 20_000
FOUND = "key {key}, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences. State 0 is the empty run, its link -1."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, nexts: dict[bytes, int], link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _copy(self, p: int, word: bytes, q: int) -> int:
        """A state for the runs of ``q`` that are at most one word longer than those of ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # an earlier sequence has this run
                last = q if self.length[q] == self.length[last] + 1 else self._copy(last, word, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._copy(p, word, q)
            last = new

    def finish(self, min_words: int, segments: list[tuple[str | None, list[bytes], bool]]) -> None:
        """Where windows end: of each state the state of its last ``min_words`` words, the items there, and the short items."""
        n, self.min_words = len(self.next), min_words
        self.base, self.tail = [0] * n, [0] * n
        self.items: dict[int, set] = {}
        self.whole: dict[int, set] = {}
        order = sorted(range(1, n), key=self.length.__getitem__)
        for v in order:
            if self.length[v] >= min_words:
                self.base[v] = v if self.length[self.link[v]] < min_words else self.base[self.link[v]]
        for item, words, short in segments:
            v = 0
            for i, word in enumerate(words):
                v = self.next[v][word]
                if i + 1 >= min_words:
                    v = self.base[v]
                    self.items.setdefault(v, set()).add(item)
            if short:
                self.whole.setdefault(v, set()).add((len(words), item))
        for v in order:  # the nearest state with short items, itself or up its links
            self.tail[v] = v if v in self.whole else self.tail[self.link[v]]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (first word, word after the last) of all hits, apart from each other, and the items that hit."""
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set = set()
        nexts, link, length, base, tail, least = self.next, self.link, self.length, self.base, self.tail, self.min_words
        v = run = 0
        for i, word in enumerate(words):
            t = nexts[v].get(word)
            if t is not None:
                run += 1
            else:
                while v and t is None:
                    v = link[v]
                    t = nexts[v].get(word)
                if t is None:
                    run = 0
                    continue
                run = length[v] + 1
            v = t
            reach = 0
            if run >= least:
                reach = run
                states.add(base[v])
            u = tail[v]
            while u:
                for size, item in self.whole[u]:
                    if size <= run:
                        reach = max(reach, size)
                        items.add(item)
                u = tail[link[u]]
            if reach:
                start = i + 1 - reach
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for s in states:
            items |= self.items[s]
        items.discard(None)
        return spans, items

    # ---- as arrays, to be sent

    def pack(self) -> dict[str, bytes]:
        words = sorted({w for d in self.next for w in d})
        at = {w: i for i, w in enumerate(words)}
        names = sorted({x for s in self.items.values() for x in s if x} | {x for s in self.whole.values() for _, x in s if x})
        of = {x: i for i, x in enumerate(names)} | {None: -1}
        edges = [(v, at[w], t) for v, d in enumerate(self.next) for w, t in d.items()]
        ints = {
            "edges": edges, "link": self.link, "length": self.length, "base": self.base, "tail": self.tail,
            "items": [(v, of[x]) for v, s in self.items.items() for x in s],
            "whole": [(v, k, of[x]) for v, s in self.whole.items() for k, x in s],
        }
        return {"words": b"\n".join(words), "names": "\n".join(names).encode(), "min_words": str(self.min_words).encode(),
                **{c: np.array(x, np.int32).tobytes() for c, x in ints.items()}}

    @classmethod
    def unpack(cls, data: dict[str, bytes]) -> Automaton:
        self = cls()
        words, names = data["words"].split(b"\n"), [*data["names"].decode().split("\n"), None]
        ints = {c: np.frombuffer(data[c], np.int32) for c in ("edges", "link", "length", "base", "tail", "items", "whole")}
        self.link, self.length, self.base, self.tail = (ints[c].tolist() for c in ("link", "length", "base", "tail"))
        self.next = [{} for _ in self.link]
        for v, w, t in ints["edges"].reshape(-1, 3).tolist():
            self.next[v][words[w]] = t
        self.items, self.whole, self.min_words = {}, {}, int(data["min_words"])
        for v, x in ints["items"].reshape(-1, 2).tolist():
            self.items.setdefault(v, set()).add(names[x])
        for v, k, x in ints["whole"].reshape(-1, 3).tolist():
            self.whole.setdefault(v, set()).add((k, names[x]))
        return self


PACKED = ["words", "names", "min_words", "edges", "link", "length", "base", "tail", "items", "whole"]


def segments_of(benchmark: DataFrame, item_col: str, text_col: str, min_words: int) -> DataFrame:
    """(item, words, short): the words of a segment joined by spaces; ``short`` where that is a whole item below ``min_words``."""

    def cut(batches):
        for names, texts in text_chunks(batches):
            out: list[tuple] = []
            for name, text in zip(names, texts):
                words = words_of(text)
                for at in range(0, max(len(words) - min_words, 0) + 1, SEGMENT_WORDS):
                    part = words[at:at + SEGMENT_WORDS + min_words - 1]
                    if part:
                        out.append((name, b" ".join(part), len(words) < min_words, len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.binary(), pa.bool_(), pa.int64()))],
                names=["item", "words", "short", "size"])

    return benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string").cast("binary")).mapInArrow(
        cut, "item string, words binary, short boolean, size long")


def _automata(segments: DataFrame, passes: int, min_words: int) -> DataFrame:
    """(pass, packed automaton), one row per pass."""

    def build(table: pa.Table) -> pa.Table:
        automaton = Automaton()
        rows = [(x["item"], x["words"].split(), x["short"]) for x in table.to_pylist()]
        for _, words, _ in rows:
            automaton.add(words)
        automaton.finish(min_words, rows)
        packed = automaton.pack()
        return pa.table({"pass": pa.array([table.column("pass")[0].as_py()], pa.int32()),
                         **{c: pa.array([packed[c]], pa.binary()) for c in PACKED}})

    dealt = segments.withColumn("pass", F.pmod(F.xxhash64("words", "item"), F.lit(passes)).cast("int"))
    return dealt.groupBy("pass").applyInArrow(build, "pass int, " + ", ".join(f"{c} binary" for c in PACKED))


#: The automaton that this worker used last, by its mark.
_LAST: dict[str, Automaton] = {}


def _found(documents: DataFrame, key: str, text_col: str, automaton, all_rows: bool) -> DataFrame:
    """Hits of each row; with ``all_rows`` also rows without any."""
    kind = documents.schema[key].dataType.simpleString()
    schema, mark = FOUND.format(key=kind), uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _LAST.get(mark)
        if built is None:
            _LAST.clear()
            built = _LAST[mark] = Automaton.unpack(automaton.value)
        types = None
        for batch in batches:
            types = types or [batch.schema.field(0).type, pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                              pa.list_(pa.string())]
            for keys, texts in text_chunks([batch]):
                out = []
                for k, text in zip(keys, texts):
                    words = words_of(text)
                    spans, items = built.scan(words)
                    if spans or all_rows:
                        out.append((k, len(words), [{"start": a, "end": b} for a, b in spans], sorted(items)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["key", "n_words", "spans", "items"])

    return documents.select(key, F.col(text_col).cast("string").cast("binary")).mapInArrow(search, schema)


def contamination(
    documents: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", min_words: int = 10, pass_words: int = PASS_WORDS,
) -> DataFrame:
    """(id, n_words, n_hit, spans, items), one row per row of ``documents``, equal ids and nulls included.

    Words are runs of 0-9, a-z, A-Z taken as a-z, and bytes from 0x80 on. A span is a stretch of words, from ``start`` to before
    ``end``, that overlapping hits cover; ``items`` are the ids, as text and sorted, of the items with a window in the text.
    Null and empty texts have no words. Items that are null, or have no words, hit nothing; an item without an id hits but is not
    named; items that share an id are one name. An empty benchmark hits nothing.
    """
    spark = documents.sparkSession
    segments = scratch.stage(segments_of(benchmark, item_col, item_text, min_words), "segments")
    total = segments.agg(F.sum("size")).first()[0] or 0
    passes = max(1, -(-total // pass_words))
    automata = scratch.stage(_automata(segments, passes, min_words), "automata")
    names, key = None, id_col
    if passes > 1:
        documents, names = row_keys(documents.select(id_col, text_col), id_col, text_col, scratch, nameless=True)
        key = "row_key"
    found = []
    for p in range(passes):
        row = automata.where(F.col("pass") == p).first()
        if row is None:  # no segment fell into this pass
            empty = Automaton()
            empty.finish(min_words, [])
            row = empty.pack()
        sent = spark.sparkContext.broadcast({c: bytes(row[c]) for c in PACKED})
        found.append(_found(documents, key, text_col, sent, all_rows=p == 0))
    if passes == 1:
        hits = found[0]
    else:
        staged = scratch.stage(reduce(DataFrame.unionByName, found), "hits")
        hits = ids_of_keys(staged.groupBy("key").agg(
            F.max("n_words").alias("n_words"), _merged(F.sort_array(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")), names, "key")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select(F.col("key").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items")


def _merged(spans):
    """Sorted spans, overlapping ones as one."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def add(done, s):
        last = F.element_at(done, -1)
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end"] < s["start"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(both)))

    return F.aggregate(spans, F.array().cast(kind), add)


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
    min_words: int = 10, max_span: int = 0, max_coverage: float = 1.0, **names,
) -> DataFrame:
    """Rows of ``documents`` without what benchmarks contain: spans of more than ``max_span`` words are cut out of the text, and
    rows whose hits cover more than ``max_coverage`` of their words are dropped.

    All other columns stay. What lies between the first and the last word of a span goes; the rest of the text is unchanged.
    Rows without hits are kept as they are, null and empty texts included.
    """
    taken = {c.lower() for c in documents.columns}
    if taken & {"row_key", "spans_"}:
        raise ValueError("the columns row_key and spans_ are needed for the work")
    rows, known = row_keys(documents, id_col, text_col, scratch, nameless=True)
    hits = contamination(rows.select("row_key", text_col), benchmark, scratch, "row_key", text_col, min_words=min_words, **names)
    hits = hits.where("n_hit > 0").select("row_key", F.col("spans").alias("spans_"), (F.col("n_hit") > max_coverage * F.col("n_words")).alias("covered_"))
    joined = rows.join(hits, "row_key", "left").where(~F.coalesce("covered_", F.lit(False))).drop("covered_", "row_key")
    long = F.filter("spans_", lambda s: s["end"] - s["start"] > max_span)
    cut = joined.where(F.size(F.coalesce(long, F.array())) > 0).withColumn("spans_", long)
    whole = joined.where(F.size(F.coalesce(long, F.array())) <= 0).drop("spans_")
    place, kept = documents.columns.index(text_col), documents.schema

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(place).to_pylist(), batch.column(len(batch.schema) - 1).to_pylist()):
                raw = text.encode() if isinstance(text, str) else text
                at = [m.span() for m in _WORD.finditer(raw)]
                parts, done = [], 0
                for s in spans:
                    parts.append(raw[done:at[s["start"]][0]])
                    done = at[s["end"] - 1][1]
                texts.append((b"".join(parts) + raw[done:]).decode(errors="replace"))
            columns = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(batch.schema) - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return whole.unionByName(cut.mapInArrow(remove, kept))
