"""Nearest neighbours by cosine with an int8 block matrix join.

Unit vectors are rounded to int8 with one scale per vector. A tile multiplies a block of queries with a block of
candidates in int8 (in 32-bit floats, which hold these sums exactly). With u = s q + e for both sides the
product is off by at most |e_u| |s_v q_v| + |u| |e_v|, so each pair has a lower and an upper bound. Pairs
whose upper bound reaches the k-th best lower bound of their query survive and are computed again in
double precision; heaps keep the best. The result is exact, not only near.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.vectors import search_tiles

#: Queries multiplied at a time; rounding errors of the bounds themselves.
QUERIES_AT_ONCE, SLACK = 128, 1e-5


def squares(x: np.ndarray) -> np.ndarray:
    """Sum of the squares of each row, added up from left to right."""
    out = np.zeros(len(x))
    for column in x.T:
        out += column * column
    return out


def quantised(x: np.ndarray):
    unit = x / np.sqrt(squares(x))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    kept = q * scale[:, None]
    return q, scale.astype(np.float32), np.sqrt(squares(kept)), np.sqrt(squares(unit - kept))


def _tile(query_ids, query_vectors, ids, vectors, k):
    # A power of two off each vector keeps squares in range and leaves the cosine as it is.
    scaled = [x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1))))[:, None] for x in (query_vectors, vectors)]
    (qq, qs, _, qe), (cq, cs, cn, ce) = map(quantised, scaled)
    q_norm, c_norm = (np.sqrt(squares(x)) for x in scaled)
    wide = cq.T.astype(np.float32)
    out = [], [], []
    for start in range(0, len(query_ids), QUERIES_AT_ONCE):
        part = slice(start, start + QUERIES_AT_ONCE)
        near = (qq[part].astype(np.float32) @ wide) * (qs[part, None] * cs)
        off = (qe[part, None] * cn + ce + SLACK).astype(np.float32)
        near[query_ids[part, None] == ids] = -np.inf
        lower, upper = near - off, near + off
        threshold = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(lower), -np.inf)
        qi, ci = np.nonzero((upper >= threshold[:, None]) & (near > -np.inf))
        dot = np.zeros(len(qi))
        for d in range(vectors.shape[1]):
            dot += scaled[0][start + qi, d] * scaled[1][ci, d]
        cosine = dot / (q_norm[start + qi] * c_norm[ci])
        ends = np.searchsorted(qi, np.arange(near.shape[0] + 1))
        for row in range(near.shape[0]):
            span = slice(ends[row], ends[row + 1])
            best = heapq.nsmallest(k, zip(-cosine[span], ids[ci[span]]))
            out[0].extend([query_ids[start + row]] * len(best))
            out[1].extend(i for _, i in best)
            out[2].extend(-s for s, _ in best)
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, **blocks: int) -> DataFrame:
    """(query_id, rank, vec_id, score double): for each query its ``k`` nearest by cosine in double precision.

    ``vectors`` and ``is_query`` as in :func:`ctrflow.llm.topk.top_k`. Zero vectors take no part. A query is no
    candidate of its own; ties go to the smaller id.
    """
    return search_tiles(vectors.where(F.exists("vec", lambda x: x != 0)), is_query, k, _tile, "double", **blocks)
