"""Tiles of the query x candidate grid that both vector searches run on.

Queries and candidates are cut into blocks by a hash of their id. A tile is one block of each; candidates
are copied once per query block and queries once per candidate block, and a tile's task gives at most k
rows per query. With blocks of b queries and c candidates, n rows give (q / b) * (n / c) tiles, each of
bounded size whatever the data look like; no pair leaves its tile.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates and queries of one tile, on average, and the least number of candidate blocks.
CANDIDATES, QUERIES, LEAST_BLOCKS = 4096, 2048, 24


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) without rows whose id or vector is null, or whose vector is empty or holds a
    null, a NaN or an infinity."""
    inf = float("inf")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf))
    return rows.where(F.col("id").isNotNull() & (F.size("vec") > 0) & good)


def search_tiles(
    vectors: DataFrame, is_query: Column, k: int, tile: Callable, score_type: str,
    candidates: int = CANDIDATES, queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all tiles, ties to the smaller id.

    ``vectors`` has (id, vec). ``tile(query ids, query vectors, ids, vectors)`` gives arrays (query id, id,
    score) that contain each query's best ``k`` of the tile, the query itself left out. Rows that share an id are
    candidates each; queries that share an id are answered as one (the smallest vector).
    """
    asked = vectors.where(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    n = vectors.count()
    n_queries = asked.count()
    blocks = max(LEAST_BLOCKS, math.ceil(n / candidates))
    query_blocks = max(1, math.ceil(n_queries / queries))

    def copies(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    own = lambda number: F.pmod(F.xxhash64("id"), F.lit(number)).cast("int")
    left = asked.select("id", "vec", own(query_blocks).alias("qb"), copies(blocks).alias("cb"))
    right = vectors.select("id", "vec", own(blocks).alias("cb"), copies(query_blocks).alias("qb"))

    def matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors as rows, shorter ones filled with zeros."""
        column = table.column("vec").combine_chunks()
        sizes = np.asarray(column.value_lengths())
        out = np.zeros((len(sizes), width))
        out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes] or [[]]).astype(int)] = \
            np.asarray(column.flatten())
        return np.asarray(table.column("id")), out

    def width(table: pa.Table) -> int:
        return max(np.asarray(table.column("vec").combine_chunks().value_lengths()), default=0) if len(table) else 0

    arrow_score = pa.int64() if score_type == "long" else pa.float64()
    names = ["query_id", "vec_id", "score"]

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        if not len(q) or not len(c):
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            w = max(width(q), width(c))
            found = tile(*matrix(q, w), *matrix(c, w), k)
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], arrow_score)],
                        names=names)

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(
        run, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
