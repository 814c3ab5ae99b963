"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import Scratch


#: Links a task joins up at a time before they are shuffled.
LINKS = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) replaced by one link of each id to the smallest it reaches, within some links at a time."""
    def flush(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        ids = [i for i in root if root[i] != i]
        return pa.RecordBatch.from_arrays([pa.array(map(find, ids), pa.int64()), pa.array(ids, pa.int64())], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
        if sum(len(a) for a, _ in held) >= LINKS:
            yield flush(*map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield flush(*map(np.concatenate, zip(*held)))


def _stars(edges: DataFrame) -> bool:
    """Whether each id has one link at most to a smaller one, and that one has none."""
    ends = edges.select(F.col("hi").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("lo", F.lit(0), F.lit(1)))
    found = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), integers; the component is its smallest id.

    Tasks join up the links they read, so that few are left for each id. The rest
    alternates two steps until nothing changes: every id links its larger neighbours to its smallest one, then
    its smaller neighbours and itself to the smallest of them. The steps are grouped minima joined back, so that an id
    with very many links is combined before the shuffle and split in the join. Each round is written as a table.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").mapInArrow(_contract, "a long, b long")
    edges = scratch.stage(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct(), f"{name}-0")
    round_ = 0
    while not _stars(edges):
        round_ += 1
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = scratch.stage(large, f"{name}-large")
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi > lo").union(
            smallest.select("hi", F.col("m").alias("lo")))
        edges = scratch.stage(small.distinct(), f"{name}-{round_}")
        scratch.drop(f"{name}-{round_ - 1}", f"{name}-large")
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
        edges.select("lo", "lo").distinct())
