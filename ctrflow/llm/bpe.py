"""Byte-level BPE encoding and decoding with a given vocabulary.

A piece of text is encoded by merging neighbours in the order of their rank: a priority queue holds the
merges that are possible, the symbols form a doubly linked list, and an entry of the queue whose symbols
have changed since is skipped when it comes up. Decoding concatenates the vocabulary's strings.

Texts are cut into pieces by the pattern of the vocabulary, and pieces repeat, so each task remembers the
ids of short pieces. There is no shuffle: tasks work on their rows alone.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import text_chunks

# Fixed value: the pattern that byte-level vocabularies cut texts with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces a worker remembers, and the longest of them in bytes.
MEMO_PIECES, MEMO_BYTES = 400_000, 64


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is a visible Latin-1
    character, else the next one from 256 on."""
    out, spare = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out[chr(byte)] = byte
        else:
            out[chr(spare)] = byte
            spare += 1
    return out


class BytePairs:
    """The vocabulary file ``path`` (JSON, byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = printable_bytes()

        def raw(symbol: str) -> bytes:
            return bytes(byte_of[c] for c in symbol)

        vocab = spec["model"]["vocab"]
        self.strings = {i: raw(s) for s, i in vocab.items() if all(c in byte_of for c in s)}
        self.single = [vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        self.pairs = []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.append((vocab[a], vocab[b], vocab[a + b]))
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(self.pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.split = regex.compile(PATTERN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece. An entry of the queue is rank and place in one number: the rank names the pair."""
        ids = [self.single[b] for b in piece]
        n, ranks, pairs = len(ids), self.ranks, self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [ranks[pair] * n + at for at, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
        heapq.heapify(queue)
        while queue:
            rank, at = divmod(heapq.heappop(queue), n)
            left, right, new = pairs[rank]
            other = after[at]
            if ids[at] != left or other >= n or ids[other] != right:
                continue  # stale: one of the two has been merged meanwhile
            ids[at], ids[other] = new, -1
            after[at] = following = after[other]
            if following < n:
                before[following] = at
                rank = ranks.get((new, ids[following]))
                if rank is not None:
                    heapq.heappush(queue, rank * n + at)
            previous = before[at]
            if previous >= 0:
                rank = ranks.get((ids[previous], new))
                if rank is not None:
                    heapq.heappush(queue, rank * n + previous)
        return tuple([i for i in ids if i >= 0])

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece, remembered if it is short. What was not asked for lately is forgotten first."""
        ids = self.memo.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = self.merge(raw := piece.encode())
                if len(raw) > MEMO_BYTES:
                    return ids
            if len(self.memo) >= MEMO_PIECES:
                self.memo, self.older = {}, self.memo
            self.memo[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the strings of special tokens become their ids."""
        if self.specials is None or not (found := list(self.specials.finditer(text))):
            return list(chain.from_iterable(map(self.piece, self.split.findall(text))))
        ids, at = [], 0
        for m in found:
            ids += chain.from_iterable(map(self.piece, self.split.findall(text[at:m.start()])))
            ids.append(self.special[m[0]])
            at = m.end()
        ids += chain.from_iterable(map(self.piece, self.split.findall(text[at:])))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; unknown ids give nothing, bytes that are no UTF-8 the replacement character."""
        return b"".join(map(self.strings.get, (i for i in ids if i in self.strings))).decode("utf-8", "replace")


@lru_cache(2)
def _vocabulary(path: str) -> BytePairs:
    return BytePairs(path)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row of ``df``.

    ``path`` is the vocabulary file, at the same place on every machine. Null and empty texts have no ids;
    null or repeated row ids are kept as they are; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path)
        for rows, texts in text_chunks(batches, 2 << 20):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, id_type), pa.array([bpe.encode(t.decode()) for t in texts], pa.list_(pa.int32()))],
                names=[id_col, "ids"])

    plain = df.select(id_col, F.col(text_col).cast("string"))
    id_type = _arrow_type(plain, id_col)
    return plain.mapInArrow(run, f"`{id_col}` {plain.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for every row of ``df``; null ids give an empty text, null entries nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    plain = df.select(id_col, ids_col)
    return plain.mapInArrow(run, f"`{id_col}` {plain.schema[id_col].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_text, decoded): ids of every row as decimal numbers joined by commas, and the text
    decoded from these ids, in one pass. Rows and nulls as in :func:`encode_texts`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(path)
        number = {i: str(i) for i in bpe.strings}
        for rows, texts in text_chunks(batches, 2 << 20):
            ids = [bpe.encode(t.decode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, id_type), pa.array(map(len, ids), pa.int64()),
                 pa.array([",".join(map(number.__getitem__, x)) for x in ids], pa.string()),
                 pa.array([bpe.decode(x) for x in ids], pa.string())],
                names=[id_col, "n_tokens", "ids_text", "decoded"])

    plain = df.select(id_col, F.col(text_col).cast("string"))
    id_type = _arrow_type(plain, id_col)
    schema = f"`{id_col}` {plain.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_text string, decoded string"
    return plain.mapInArrow(run, schema)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
