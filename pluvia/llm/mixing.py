"""Rates at which documents enter a mixture, so that domains get their target shares of the tokens.

Membership is soft. A softmax classifier, fit on a bounded sample of labelled documents, gives every
document a probability for each domain. Its tokens (words) count for a domain by that probability. Wanted are
rates r >= 0 with expected totals sum(r * tokens * p_k) = target_k: least squares in the totals, by
projected gradient from r = 1. A step moves the rate of a document by the residuals weighted with its
probabilities; steps add up freely, and rates are their projection, cut off at 0 (the lazy form of the
method). Residuals are scaled by the curvature of the documents that are not cut off, and the best of a few
step lengths is taken. A rate depends on the document's probabilities and on the sum of the steps (one number
per domain), so Spark computes it anew from the row in each round, and a round returns sums only.

Domains come from the labels: ``toxic`` (toxic = 1), ``poor`` (quality = 0) and ``plain`` (any other label).
The total is that of the documents. With ``least`` = 1 no rate falls below 1, and the total is the least at
which no domain has to shrink: targets are then met by repeating alone. A domain without tokens cannot
reach its target, its residual stays.

Labels: the ``SAMPLE`` documents of smallest hashed doc_id, each with one domain (several labels of one
document: the largest of toxic, the smallest quality). Without labels all domains are equally likely. Null or
empty texts have no tokens, so any rate would do: theirs follows from their probabilities like all others.
Equal texts have equal rates; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, learned, text_chunks
from pluvia.llm.features import DIMENSIONS, ROWS, STATISTICS, ngrams, statistics
from pluvia.session import new_folder

SAMPLE = 4000
DOMAINS = ("plain", "poor", "toxic")
TARGETS = {"plain": 0.90, "poor": 0.05, "toxic": 0.05}
ROUNDS, EXACT, SOFT, STEPS = 30, 1e-10, 1e-8, (1.0, 0.4, 0.1, 0.01)


@dataclass(frozen=True)
class Softmax:
    weights: np.ndarray  # (features + 1, domains)
    mean: np.ndarray
    spread: np.ndarray

    def probabilities(self, grams: np.ndarray, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.mean) / self.spread
        z = grams @ self.weights[:DIMENSIONS] + x @ self.weights[DIMENSIONS:-1] + self.weights[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(grams: np.ndarray, stats: np.ndarray, domain: np.ndarray, domains: int, rounds: int = 150) -> Softmax:
    """Softmax regression by accelerated gradient steps."""
    mean = stats.mean(axis=0) if len(stats) else np.zeros(len(STATISTICS))
    spread = np.maximum(stats.std(axis=0), 1e-6) if len(stats) else np.ones(len(STATISTICS))
    w = np.zeros((DIMENSIONS + len(STATISTICS) + 1, domains), np.float32)
    if not len(domain):
        return Softmax(w.astype(np.float64), mean, spread)
    # letter counts are small numbers: scaled up they learn as fast as the statistics
    scale = 6.0
    x = np.ones((len(domain), len(w)), np.float32)
    np.multiply(grams, np.float32(scale), out=x[:, :DIMENSIONS], dtype=np.float32)
    x[:, DIMENSIONS:-1] = (stats - mean) / spread
    y = np.eye(domains, dtype=np.float32)[domain]
    step = np.float32(8.0 * len(x) / np.einsum("ij,ij->", x, x))
    before = w
    for k in range(1, rounds + 1):
        ahead = w + np.float32((k - 1) / (k + 2)) * (w - before)
        z = x @ ahead
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        before, w = w, ahead - step * (x.T @ (p - y) / len(x) + 1e-4 * ahead)
    w = w.astype(np.float64)
    w[:DIMENSIONS] *= scale
    return Softmax(w, mean, spread)


def domain_of(quality: Column, toxic: Column) -> Column:
    """The index in DOMAINS, null without a label."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(quality.isNotNull() | toxic.isNotNull(), 0)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Softmax:
    chosen = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
        .where(F.col("domain").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        grams, stats = [], []
        for _, _, d, o in text_chunks(batch.column(batch.schema.get_field_index("text")), most=ROWS):
            grams += [r.tobytes() for r in ngrams(d, o).astype("<f2")]
            stats += [r.tobytes() for r in statistics(d, o).astype("<f4")]
        return [pa.array(grams, pa.binary()), pa.array(stats, pa.binary())]

    # at most ``sample`` rows of two numbers go to every task
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    fields = [("grams", T.BinaryType()), ("stats", T.BinaryType())]
    rows = add_columns(known, fields, make, ["doc_id", "domain"])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(sample).select("domain", "grams", "stats")

    def taught(table: pa.Table) -> Softmax:
        domain = np.asarray(table.column(0), np.int64)
        stats = np.frombuffer(b"".join(table.column(2).to_pylist()), "<f4").reshape(len(domain), len(STATISTICS))
        grams = np.empty((len(domain), DIMENSIONS), np.float16)
        for k, packed in enumerate(table.column(1)):
            grams[k] = np.frombuffer(packed.as_buffer(), "<f2")
        return fit(grams, stats.astype(np.float64), domain, len(DOMAINS))

    nothing = np.zeros((0, len(STATISTICS)))
    return learned(rows, taught) or fit(np.zeros((0, DIMENSIONS)), nothing, np.zeros(0, np.int64), len(DOMAINS))


def with_membership(docs: DataFrame, model: Softmax, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``tokens`` and a probability ``p_<domain>`` for every domain."""
    words = STATISTICS.index("log_words")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        p, tokens = [np.zeros((0, len(DOMAINS)))], [np.zeros(0)]
        for _, _, d, o in text_chunks(batch.column(batch.schema.get_field_index("text")), most=ROWS):
            stats = statistics(d, o)
            p.append(model.probabilities(ngrams(d, o), stats))
            tokens.append(np.rint(np.expm1(stats[:, words])))
        p = np.concatenate(p)
        return [pa.array(np.concatenate(tokens).astype(np.int64)), *(pa.array(np.ascontiguousarray(c)) for c in p.T)]

    fields = [("tokens", T.LongType())] + [(f"p_{d}", T.DoubleType()) for d in DOMAINS]
    return add_columns(docs, fields, make, keep)


def rate(moved: np.ndarray, least: float = 0.0) -> Column:
    """The rate of a row: 1, less the steps so far weighted with its probabilities, cut off at ``least``."""
    return F.greatest(F.lit(float(least)), F.lit(1.0) - _along(moved))


def _along(moved: np.ndarray) -> Column:
    return sum((F.col(f"p_{d}") * float(m) for d, m in zip(DOMAINS, moved)), F.lit(0.0))


def _sums(moved: np.ndarray, least: float) -> list[Column]:
    """What a round needs to know at one place: the rates' own part of the objective, the totals of the
    domains, and the curvature of the documents that are not held at the bound."""
    r, t, along = rate(moved, least), F.col("tokens").cast("double"), _along(moved)
    live = F.when(F.lit(1.0) - along > least, t).otherwise(0.0)
    own = [F.sum(t * ((r - 1) * (r - 1) / 2 + r * along))]
    totals = [F.sum(t * r * F.col(f"p_{d}")) for d in DOMAINS]
    pairs = [(a, b) for k, a in enumerate(DOMAINS) for b in DOMAINS[: k + 1]]
    return own + totals + [F.sum(live * F.col(f"p_{a}") * F.col(f"p_{b}")) for a, b in pairs]


def solve(members: DataFrame, targets: dict[str, float], least: float = 0.0) -> np.ndarray:
    """The sum of all steps, one number per domain; ``members`` has tokens and probabilities.

    Minimises |totals - targets|^2 / (2 SOFT S) + sum(tokens * (r - 1)^2) / 2, S the tokens of all documents: with
    SOFT near 0 the targets are met if they can be, by the rates nearest to 1.
    """
    k = len(DOMAINS)
    share = np.array([targets[d] for d in DOMAINS], float) / sum(targets[d] for d in DOMAINS)

    def measure(places: list[np.ndarray]):
        sums = [s.alias(f"s{m}_{n}") for m, y in enumerate(places) for n, s in enumerate(_sums(y, least))]
        row = members.agg(*sums).first()
        for m, y in enumerate(places):
            part = np.array([np.nan if x is None else x for x in row[m * len(row) // len(places) : (m + 1) * len(row) // len(places)]], float)
            bend = np.zeros((k, k))
            bend[np.tril_indices(k)] = part[1 + k :]
            yield y, part[0], part[1 : 1 + k], bend + np.tril(bend, -1).T

    moved = np.zeros(k)
    _, own, totals, bend = next(measure([moved]))
    everything = totals.sum()
    if not everything > 0:
        return moved
    if least >= 1:  # at rate 1 all rows are at the bound: the first step takes them as free
        _, _, _, bend = next(measure([np.full(k, -1e-9)]))
    held = [g / s for g, s in zip(totals, share) if s] if least >= 1 else []
    want = share * max([everything, *held])
    for _ in range(ROUNDS):
        slope = totals - want - SOFT * everything * moved
        if np.abs(slope).max() <= EXACT * everything:
            break
        step = np.linalg.solve(bend + SOFT * everything * np.eye(k), slope)
        tried = measure([moved + s * step for s in STEPS])
        gain = lambda x: x[1] - x[0] @ want - SOFT * everything / 2 * x[0] @ x[0]
        moved, own, totals, bend = max(tried, key=gain)
    return moved


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, keep: list[str] | None = None, least: float = 0.0
) -> DataFrame:
    """``docs`` with tokens, probabilities and ``rate``.

    Probabilities are written below the shared folder, as each round reads them.
    """
    scored = with_membership(docs, learn(docs, labels), keep)
    path = new_folder(docs.sparkSession, "membership")
    scored.write.parquet(path)
    scored = docs.sparkSession.read.parquet(path)
    moved = solve(scored.select("tokens", *(f"p_{d}" for d in DOMAINS)), targets, least)
    return scored.withColumn("rate", rate(moved, least))


def taken(rate_: Column, *key: str) -> Column:
    """How often a document is taken: the whole part of its rate, and once more with the probability of
    the rest, decided by the hash of its key."""
    chance = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate_) + (chance < rate_ - F.floor(rate_)).cast("int")).cast("int")


def op6_mixing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: tokens, probabilities, rate and how often it is taken."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mix(rows, labels, keep=["doc_id"]).withColumn("taken", taken(F.col("rate"), "doc_id"))
