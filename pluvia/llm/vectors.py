"""Tables of vectors as packed blocks, and a stated set of queries met with every block.

Vectors are dealt by hash into blocks of about ``BLOCK`` rows, queries into groups of about ``GROUP``;
each is one row of bytes. A cell is one group and one block. Cells of one group and of ``STRIPE`` blocks
follow each other in a task, so that a search keeps what it has found so far. The work is the stated
queries against all rows, in blocks; no row meets another of its own table in a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, GROUP, STRIPE = 8192, 512, 4
PACKED = "block int, width int, ids binary, body binary"


def usable(column: str) -> Column:
    """A vector without a null or a component that is no finite number."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & ~bad, F.lit(False))


def packed(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """``rows`` (id, vector) as one row of bytes per block and width of the vectors."""
    count = rows.count()
    blocks = max(1, math.ceil(count / size))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        body = np.stack(frame["vector"].to_list()).astype(kind)
        ids = frame["id"].to_numpy(np.int64)
        made = (int(frame["block"].iloc[0]), int(frame["width"].iloc[0]), ids.tobytes(), body.tobytes())
        return pd.DataFrame([made], columns=["block", "width", "ids", "body"])

    block = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    return (
        rows.where(F.size("vector") > 0)
        .select(block.alias("block"), F.size("vector").alias("width"), "id", "vector")
        .groupBy("block", "width")
        .applyInPandas(run, PACKED)
    )


def cells(queries: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """Every group of queries with every block of rows of the same width, in the order of the stripes."""
    asked = packed(queries, GROUP, kind).select(
        F.col("block").alias("group"), "width", F.col("ids").alias("query_ids"), F.col("body").alias("query_body")
    )
    stripe = F.floor(F.col("block") / STRIPE).cast("int").alias("stripe")
    held = packed(rows, BLOCK, kind).select("block", stripe, "width", "ids", "body")
    # both sides are one row per thousands of vectors
    return (
        held.join(asked, "width")
        .repartition("group", "width", "stripe")
        .sortWithinPartitions("group", "width", "stripe", "block")
    )


def search(
    queries: DataFrame,
    rows: DataFrame,
    kind: str,
    score_kind: str,
    k: int,
    cell: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, ties to the smaller id.

    ``cell(query ids, queries, ids, rows, floor)`` returns (query index, row index, score) of candidates;
    ``floor`` is the score that each query's k-th best has reached so far.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, None
        for frame in frames:
            for r in frame.itertuples(index=False):
                width = r.width
                here = (r.group, r.width, r.stripe)
                if here != at:
                    if best is not None:
                        yield found(best)
                    at, best = here, None
                qid, q = np.frombuffer(r.query_ids, np.int64), np.frombuffer(r.query_body, kind).reshape(-1, width)
                ids, v = np.frombuffer(r.ids, np.int64), np.frombuffer(r.body, kind).reshape(-1, width)
                if best is None:
                    best = (qid, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.dtype(score_kind)))
                row, column, score = cell(qid, q, ids, v, floor(best))
                best = (qid, *top(*(np.concatenate(p) for p in zip(best[1:], (row, ids[column], score)))))
        if best is not None:
            yield found(best)

    def top(row, ids, score):
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        start = np.searchsorted(row, row)
        keep = np.arange(len(row)) - start < k
        return row[keep], ids[keep], score[keep]

    def floor(best) -> np.ndarray:
        _, row, _, score = best
        out = np.full(len(best[0]), -np.inf)
        count = np.bincount(row, minlength=len(out))
        end = np.cumsum(count)
        full = count == k
        out[full] = score[end[full] - 1]
        return out

    def found(best) -> pd.DataFrame:
        qid, row, ids, score = best
        return pd.DataFrame({"query_id": qid[row], "vec_id": ids, "score": score})

    kind_of = "double" if score_kind.startswith("f") else "long"
    each = cells(queries, rows, kind).mapInPandas(run, f"query_id long, vec_id long, score {kind_of}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
