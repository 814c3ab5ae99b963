"""Exact top-k by inner product with MaxScore.

A vector component is a term. For one query and one shard the contribution of term d is shifted to start
at zero (for a positive query weight by the smallest component of the shard, for a negative one by the
largest), so that every term has postings (the vectors with a contribution above zero) and a highest
contribution. Terms are taken in the order of these bounds. The last ones that together cannot lift a vector
over the k-th best score so far are non-essential: the postings of the essential terms are traversed first,
the others are probed only for vectors that can still reach the threshold, which rises meanwhile. Shards
are merged by rank.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from ctrflow.llm.vectors import search_tiles

#: Terms taken at a time, and vectors scored in full to get a first threshold.
TERMS, SEED = 8, 64


def kth_largest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def maxscore(weights: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, skip: np.ndarray):
    """Rows of the shard that can be among the ``k`` best, with exact scores.

    ``columns`` holds a term's components in each row, ``low`` and ``high`` their range; rows in ``skip``
    take no part. Ties with the k-th best are kept.
    """
    base = np.where(weights > 0, low, high)
    bound = np.where(weights > 0, weights * (high - low), weights * (low - high))
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    rest = np.concatenate([np.cumsum(bound[::-1])[::-1], [0]])  # what the terms from here on can add
    terms, weights, base = columns[order], weights[order], base[order]
    rows = np.setdiff1d(np.arange(columns.shape[1]), skip, assume_unique=True)
    seed = weights @ (terms[:, rows[:SEED]] - base[:, None])
    threshold = kth_largest(seed, k)
    essential = max(1, int(np.searchsorted(-rest, -threshold)))  # rest[essential] < threshold or nothing is left
    essential = min(essential, len(weights))
    score = weights[:essential] @ (terms[:essential][:, rows] - base[:essential, None])
    at = essential
    while True:
        threshold = max(threshold, kth_largest(score, k))
        alive = score + rest[at] >= threshold
        rows, score = rows[alive], score[alive]
        if at >= len(weights) or not len(rows):
            break
        end = min(at + TERMS, len(weights))
        score = score + weights[at:end] @ (terms[at:end][:, rows] - base[at:end, None])
        at = end
    return rows, score + weights @ base


def _tile(query_ids, query_vectors, ids, vectors, k):
    query_vectors, vectors = (np.floor(1024 * x) for x in (query_vectors, vectors))
    most = np.abs(query_vectors).max() * np.abs(vectors).max() * 4 * vectors.shape[1]
    kind = np.float64 if most < 2 ** 53 else np.int64  # doubles hold all sums exactly, and multiply faster
    query_vectors, columns = query_vectors.astype(kind), np.ascontiguousarray(vectors.T.astype(kind))
    low, high = columns.min(axis=1), columns.max(axis=1)
    by_id = np.argsort(ids, kind="stable")
    out = [], [], []
    for i, q in zip(query_ids, query_vectors):
        own = by_id[np.searchsorted(ids, i, "left", sorter=by_id):np.searchsorted(ids, i, "right", sorter=by_id)]
        rows, score = maxscore(q, columns, low, high, k, np.sort(own))
        best = np.lexsort((ids[rows], -score))[:k]
        out[0].append(np.full(len(best), i))
        out[1].append(ids[rows[best]])
        out[2].append(score[best])
    return np.concatenate(out[0]), np.concatenate(out[1]), np.concatenate(out[2]).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, **blocks: int) -> DataFrame:
    """(query_id, rank, vec_id, score long): for each query the ``k`` highest inner products of floor(1024 * x).

    ``vectors`` has (id, vec array<double>) as from :func:`ctrflow.llm.vectors.finite_vectors`; ``is_query`` is a
    condition on ``id``. A query is no candidate of its own. Ties go to the smaller id. Vectors of different
    length are filled up with zeros. No vectors or no queries give no rows. Sums have to fit into 64 bits.
    """
    return search_tiles(vectors, is_query, k, _tile, "long", **blocks)
