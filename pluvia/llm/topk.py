"""Exact top-k inner products by aggregation without random access.

A block of vectors keeps one sorted list per component. For every query all lists are read at the same
depth, from the largest value down where the query's component is positive and from the smallest up where
it is negative. What has been read of a vector gives its lower bound (the rest is at worst the far end of
the lists) and its upper bound (the rest is at best the value read last). A vector whose upper bound is
below the k-th lower bound cannot qualify. Reading stops for a query once no more than ``ENOUGH`` vectors
can, or at the end of the lists; the final scores of these are then resolved from the rest of their values.
The bounds of all queries of a group are matrix products. The k-th score found in earlier blocks of a task
counts as a bound from the start.

Scores are integers, exact while they stay below 2^53. Vectors that are null, empty or hold a null or a
non-finite component take no part, nor do rows without an id; only vectors of one length are compared.
Rows with the query's own id are not its candidates. A query that occurs in several equal rows counts once; equal
candidates count as often as they occur. Ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.vectors import search, usable

K, SCALE, ENOUGH = 20, 64, 160
DEPTHS = (0.25, 0.5, 0.7, 0.85, 1.0)


def bounds(q: np.ndarray, v: np.ndarray, rank: np.ndarray, ordered: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of every query and vector when ``depth`` places of every list have been read.

    ``rank`` is the place of every value in its list of falling values, ``ordered`` those lists.
    """
    n = len(ordered)
    above, below = np.maximum(q, 0), np.minimum(q, 0)
    falling, rising = rank < depth, rank >= n - depth
    upper = above @ np.where(falling, v, ordered[depth - 1]).T + below @ np.where(rising, v, ordered[n - depth]).T
    lower = above @ np.where(falling, v, ordered[-1]).T + below @ np.where(rising, v, ordered[0]).T
    return lower, upper


def no_random_access(
    qid: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, floor: np.ndarray, k: int = K
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, row index, score) of all that may be among the k best of a block."""
    n = len(v)
    large = float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1]
    kind = np.float32 if large < 2**24 else np.float64
    q, v = q.astype(kind), v.astype(kind)
    order = np.argsort(-v, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    ordered = np.take_along_axis(v, order, axis=0)
    open_, columns = np.arange(len(q)), np.arange(n)
    rows, found = [], []
    for share in DEPTHS:
        depth = max(1, int(n * share)) if share < 1 else n
        lower, upper = bounds(q[open_], v[columns], rank[columns], ordered, depth)
        own = qid[open_][:, None] == ids[columns][None, :]
        lower[own] = upper[own] = -np.inf
        least = floor[open_]
        if lower.shape[1] >= k:
            least = np.maximum(least, np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k])
        alive = (upper >= least[:, None]) & ~own
        done = np.ones(len(open_), bool) if depth == n else alive.sum(axis=1) <= ENOUGH
        at, column = np.nonzero(alive[done])
        rows.append(open_[done][at])
        found.append(columns[column])
        if done.all():
            break
        open_ = open_[~done]
        columns = columns[alive[~done].any(axis=0)]
    row, column = np.concatenate(rows), np.concatenate(found)
    score = np.empty(len(row), np.int64)
    for a in range(0, len(row), 1 << 16):
        part = slice(a, a + (1 << 16))
        score[part] = np.einsum("ij,ij->i", q[row[part]].astype(np.float64), v[column[part]].astype(np.float64))
    return row, column, score


def top_k(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """The k rows of largest inner product for every query; both tables are (id, vector of integers)."""

    def cell(qid, q, ids, v, floor):
        return no_random_access(qid, q, ids, v, floor, k)

    return search(queries.distinct(), rows, "f8", "i8", k, cell)


def scaled(column: str, scale: int = SCALE) -> Column:
    return F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def op2_topk(embeddings: DataFrame) -> DataFrame:
    """The 20 best rows for every row whose vec_id is divisible by 20."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("id"), scaled("embedding").alias("vector")
    )
    return top_k(rows.where(F.col("id") % 20 == 0), rows)


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q
  JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""
