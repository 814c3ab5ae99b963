"""Toxicity scores by logistic regression, trained with FTRL-proximal.

Features are hashed lower-case words, word pairs and pairs with one word between, present or not. Learning is
per coordinate: each keeps the sum of its gradients (z) and of their squares (n), which give its rate, and L1
keeps weights at zero until the evidence is strong, so that the model is a short list of coordinates.

Training runs in shards of bounded size. The features of a shard are computed once and stored as one row. In each round every
shard learns from its row, in a map, starting at the common state; the states are averaged slice by slice of the coordinates, and
one state of at most as many entries as there are coordinates comes back. A toxic row weighs as much more as such rows are rarer. Scoring is a map over
all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.bpe import _arrow_type
from ctrflow.llm.common import Scratch, mix, text_chunks, tokens

#: Coordinates; rows the model is fitted on at most (drawn evenly by a hash of the id); shards, rounds, passes per round.
DIMENSIONS, MAX_ROWS, SHARDS, ROUNDS, PASSES = 1 << 20, 16_000, 4, 4, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.01
#: Coordinates of a slice of a state.
SLICE = 1 << 16


def features(texts: list[bytes], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates of each text, one after the other, and where each text starts (with the end)."""
    h, counts = tokens(texts)
    row = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    found, rows = [mix(h)], [row]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            inside = row[:-gap] == row[gap:]
            found.append(mix(h[:-gap] * np.uint64(salt) + h[gap:])[inside])
            rows.append(row[:-gap][inside])
    keys = np.concatenate(rows) * np.uint64(dimensions) + np.concatenate(found) % np.uint64(dimensions)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    starts = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) * np.uint64(dimensions))
    return (keys % np.uint64(dimensions)).astype(np.int64), starts


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Ftrl:
    """State of all coordinates; the last one is the bias, which L1 leaves alone."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def zero(cls, dimensions: int) -> Ftrl:
        return cls(np.zeros(dimensions + 1), np.zeros(dimensions + 1))

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        bias = np.asarray(at) == len(self.z) - 1
        out = np.sign(z) * np.where(bias, 0, L1) - z
        out /= (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where((np.abs(z) <= L1) & ~bias, 0, out)

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = (sigmoid(w.sum()) - label) * weight
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


@dataclass
class ToxicityModel:
    """Coordinates that have a weight (sorted), their weights, and the bias."""

    coordinates: np.ndarray
    weights: np.ndarray
    bias: float
    dimensions: int

    def score(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, score) for every row: the probability that the text is toxic.

        Null and empty texts get the probability of the bias alone. Null and repeated ids are kept.
        """
        model = df.sparkSession.sparkContext.broadcast((self.coordinates, self.weights, self.bias))
        dimensions = self.dimensions
        plain = df.select(id_col, F.col(text_col).cast("string"))
        id_type = _arrow_type(plain, id_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coordinates, weights, bias = model.value
            table = np.zeros(dimensions, np.float32)
            table[coordinates] = weights
            for ids, texts in text_chunks(batches):
                at, starts = features(texts, dimensions)
                sums = np.concatenate([[0.0], np.cumsum(table[at], dtype=np.float64)])
                score = sigmoid(bias + sums[starts[1:]] - sums[starts[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(score)], names=[id_col, "score"])

        return plain.mapInArrow(run, f"`{id_col}` {plain.schema[id_col].dataType.simpleString()}, score double")


def _shard(dimensions: int):
    """The rows of one shard, ordered by id and text, as arrays of coordinates, starts and labels."""
    def pack(table: pa.Table) -> pa.Table:
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        order = sorted(range(len(texts)), key=list(zip(map(str, table.column("id").to_pylist()), texts)).__getitem__)
        found, starts = [], [0]
        for i in range(0, len(order), 256):
            at, ends = features([texts[k] for k in order[i:i + 256]], dimensions)
            found.append(at.astype(np.int32))
            starts += (ends[1:] + starts[-1]).tolist()
        labels = np.asarray(table.column("label"))[order].astype(np.int8)
        packed = np.concatenate(found), np.array(starts, np.int64), labels
        return pa.table([pa.array([x.tobytes()], pa.binary()) for x in packed], names=["found", "starts", "labels"])

    return pack


def _learner(start, seed: int, dimensions: int, passes: int, balance: float):
    """The function that learns from each shard, beginning at the broadcast state ``start``."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            own = Ftrl.zero(dimensions)
            at, z, n = start.value
            own.z[at], own.n[at] = z, n
            found, starts, labels = (np.frombuffer(row[c], t) for c, t in (("found", np.int32), ("starts", np.int64), ("labels", np.int8)))
            rng = np.random.default_rng(seed)
            for _ in range(passes):
                for i in rng.permutation(len(labels)):
                    own.learn(found[starts[i]:starts[i + 1]].astype(np.int64), labels[i], balance if labels[i] else 1.0)
            at = np.flatnonzero(own.n)
            ends = np.searchsorted(at, np.arange(0, dimensions + 1 + SLICE, SLICE))
            parts = [at[a:b] for a, b in zip(ends, ends[1:])]
            columns = [[x.astype(np.int32).tobytes() for x in parts], [own.z[x].tobytes() for x in parts], [own.n[x].tobytes() for x in parts]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], names=["slice", "coordinate", "z", "n"])

    return learn


def _average(table: pa.Table) -> pa.Table:
    """One slice of the states of all shards: a coordinate is averaged over the shards that know it, so rare ones are not diluted."""
    at, z, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("coordinate", np.int32), ("z", np.float64), ("n", np.float64)))
    at, place, shards = np.unique(at, return_inverse=True, return_counts=True)
    state = at, np.bincount(place, z, len(at)) / shards, np.bincount(place, n, len(at)) / shards
    return pa.table([pa.array([x.tobytes()], pa.binary()) for x in state], names=["coordinate", "z", "n"])


def fit_toxicity(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", dimensions: int = DIMENSIONS,
    max_rows: int = MAX_ROWS, shards: int = SHARDS, rounds: int = ROUNDS, passes: int = PASSES,
) -> ToxicityModel:
    """A model of ``label_col`` (0 or 1) from at most about ``max_rows`` rows, drawn by a hash of the id.

    Rows without a label or an id are left out; null texts are empty. Rows of one class or none give a model of
    the bias alone, none at all a score of one half.
    """
    scratch = Scratch(df.sparkSession, "toxicity")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"))
    rows = rows.where("id IS NOT NULL AND label IN (0, 1)")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share, balance = min(1.0, max_rows / max(1, n)), max(1.0, (n - toxic) / max(1, toxic))
    place = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30))
    rows = rows.where(place < int(share * (1 << 30)) + 1)
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int")
    dealt = rows.select("id", "text", "label", shard.alias("shard")).repartition(shards, "shard")
    packed = scratch.stage(dealt.groupBy("shard").applyInArrow(_shard(dimensions), "found binary, starts binary, labels binary"), "rows")
    state = Ftrl.zero(dimensions)
    for round_ in range(rounds):
        held = np.flatnonzero(state.n)
        start = df.sparkSession.sparkContext.broadcast((held, state.z[held], state.n[held]))
        learned = packed.mapInArrow(_learner(start, round_, dimensions, passes, balance), "slice int, coordinate binary, z binary, n binary")
        averaged = learned.groupBy("slice").applyInArrow(_average, "coordinate binary, z binary, n binary").toArrow()
        state = Ftrl.zero(dimensions)
        for coordinate, z, n in zip(*(averaged.column(c) for c in ("coordinate", "z", "n"))):
            at = np.frombuffer(coordinate.as_buffer(), np.int32)
            state.z[at], state.n[at] = np.frombuffer(z.as_buffer(), np.float64), np.frombuffer(n.as_buffer(), np.float64)
        start.destroy()
        del learned, averaged
        scratch.free()
    scratch.drop("rows")
    weights = state.weights(np.arange(dimensions + 1))
    held = np.flatnonzero(weights[:-1])
    return ToxicityModel(held, weights[held].astype(np.float32), float(weights[-1]), dimensions)
