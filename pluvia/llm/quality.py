"""A quality score from gradient-boosted trees over document statistics.

``fit`` learns histogram trees: every statistic is binned at quantiles, gradients and hessians are summed
by (node, statistic, bin), and the best cut of every node of a level is read from those sums. The trees
are complete binary trees of one depth, so the whole model is three arrays (statistic, threshold, value),
and a batch of texts walks all trees at once, one level at a step.

Labels come from a bounded sample: the ``SAMPLE`` labelled documents whose hashed doc_id is smallest,
of those that may be learned from. Several labels of one document count as their mean (0.5 and above is
1). Null labels, labels other than 0 and 1, and labels without a document teach nothing. Without any
label, or with labels of one kind, every score is the share of label 1 (0.5 without any).

A null or empty text has statistics of zero and so a score like any other. Equal texts have equal scores.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, bucket, learned, text_chunks
from pluvia.llm.features import STATISTICS, statistics

SAMPLE = 20_000
CUT = 0.3
BINS, TREES, DEPTH, RATE, RIDGE, LEAST = 64, 60, 4, 0.15, 1.0, 8.0


@dataclass(frozen=True)
class Trees:
    statistic: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    value: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.statistic.shape
        tree = np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), np.int32)
        row = np.arange(len(x))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[row, self.statistic[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        margin = self.base + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for labels 0 and 1 by boosting on the logistic loss."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    if len(y) == 0 or y.min() == y.max():
        base = 0.0 if len(y) == 0 else base
        return Trees(np.zeros((1, inner), np.int32), np.full((1, inner), np.inf), np.zeros((1, leaves)), base)
    n, width = x.shape
    edges = np.quantile(x, np.arange(1, BINS) / BINS, axis=0, method="lower").T
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    cell = code + np.arange(width)[None, :] * BINS
    margin = np.full(n, base)
    made = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        statistic, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, count = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (width * BINS) + cell).ravel()
            shape = (count, width, BINS)
            g = np.bincount(at, np.repeat(slope, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(bend, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(h * 4 < LEAST) | ((all_h - h) * 4 < LEAST)] = 0
            gain[:, :, -1] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    statistic[first + k], threshold[first + k] = f, edges[f, b]
            node = 2 * node + 1 + (x[np.arange(n), statistic[node]] > threshold[node])
        leaf = node - inner
        value = -np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + RIDGE) * RATE
        margin += value[leaf]
        made.append((statistic, threshold, value))
    return Trees(*(np.stack(part) for part in zip(*made)), base)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [statistics(d, o) for _, _, d, o in text_chunks(batch.column(batch.schema.get_field_index("text")))]
        x = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
        return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))]

    return add_columns(docs, [("statistics", T.ArrayType(T.DoubleType()))], make, keep)


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` labelled documents; ``allowed`` is a condition on doc_id."""
    usable = F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
    chosen = (
        labels.select("doc_id", "quality")
        .where(usable if allowed is None else usable & allowed)
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # at most ``sample`` rows of two numbers go to every task
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = (
        with_statistics(known, ["doc_id", "y"])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "statistics")
        .limit(sample)
        .select("y", "statistics")
    )

    def taught(table: pa.Table) -> Trees:
        y = np.asarray(table.column(0), np.float64)
        x = np.asarray(table.column(1).combine_chunks().flatten(), np.float64).reshape(len(y), len(STATISTICS))
        return fit(x, y)

    return learned(rows, taught) or fit(np.zeros((0, len(STATISTICS))), np.zeros(0))


def with_quality(docs: DataFrame, model: Trees, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``docs`` with the score of its texts."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        chunks = text_chunks(batch.column(batch.schema.get_field_index("text")))
        parts = [model.score(statistics(d, o)) for _, _, d, o in chunks]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0))]

    return add_columns(docs, [(name, T.DoubleType())], make, keep)


def op8_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document; every fifth of the hashed doc_ids is held out from learning."""
    model = learn(docs, labels, bucket("doc_id", 5) != 0)
    scored = with_quality(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, ["doc_id"])
    return scored.select(
        "doc_id",
        (bucket("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
