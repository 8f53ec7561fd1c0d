"""Stupid-backoff scores of documents under the n-gram counts of all other documents.

The score of a word is c(h w) / c(h) for the longest history h for which the n-gram was seen elsewhere,
times ``ALPHA`` for every word by which the history was cut; at the end c(w) / N. A document's own
occurrences are taken off every count first. The score of a document is the sum of the logarithms.

The relation (block, n-gram, count) is held in packed rows. Documents are dealt by hash into blocks of
about ``BLOCK_BYTES``; a block turns into its distinct n-grams with their counts, as sorted 64-bit hashes
cut into hash ranges. The count table is partitioned by these ranges: a range receives the rows of all
blocks, adds up, and answers every row with the totals of its n-grams in the same order. Totals and
documents are joined by block, and each document is summed up over its exploded n-grams. A frequent n-gram
is one entry per block, however often it occurs. Blocks and ranges grow in number with the table, not in size. The empty
n-gram stands for N.

Words are as in the word shingles: A-Z lower-cased, cut at ASCII white space. A null or empty text has no
words and score 0. Repeated rows are documents of their own (and so see each other). A word seen nowhere else counts as
``ALPHA`` occurrences. Two n-grams with one 64-bit hash would share a count. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.columnar import offsets_of, ranges, text_chunks

ORDER, ALPHA, BLOCK_BYTES = 2, 0.4, 10 << 20
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words of each text)."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    low = _LOWER[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~_SPACE[data]
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    stop[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    bounds = np.empty(2 * len(starts) + 1, np.int32)
    bounds[0:-1:2], bounds[1::2], bounds[-1] = starts, ends, ends[-1]
    column = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(low)])
    coded = column.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return hashes[coded.indices.to_numpy()[::2]], np.bincount(row, minlength=rows)


def grams(hashes: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each size 1..order the hash of the n-gram that ends at every word, 0 where the text is too short."""
    place = ranges(np.zeros(len(counts), np.int64), counts)
    out, last = [], np.zeros(len(hashes), np.uint64)
    for size in range(1, order + 1):
        mixed = hashes if size == 1 else np.concatenate([np.zeros(1, np.uint64), last[:-1]]) * _A + hashes
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _B + np.uint64(size)
        mixed = mixed ^ (mixed >> np.uint64(32))
        last = np.where(place >= size - 1, np.maximum(mixed, np.uint64(1)), np.uint64(0))
        out.append(last)
    return out


def _block(table: pa.Table, order: int):
    parts = [words(d, o) for chunk in table.column("text").chunks for _, _, d, o in text_chunks(chunk)]
    hashes = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    return counts, grams(hashes, counts, order)


def _distinct(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of a block, the empty one first, with counts."""
    found, count = np.unique(np.concatenate([g[g > 0] for g in levels]), return_counts=True)
    return np.append(np.uint64(0), found), np.append(len(levels[0]), count)


def _edges(ranges_: int) -> np.ndarray:
    return np.array([(k << 64) // ranges_ for k in range(1, ranges_)], np.uint64)


def ask(table: pa.Table, order: int, ranges_: int) -> pa.Table:
    """The n-grams of one block, one row per hash range."""
    _, levels = _block(table, order)
    found, count = _distinct(levels)
    cut = [0, *np.searchsorted(found, _edges(ranges_)).tolist(), len(found)]
    number = table.column("block")[0].as_py()
    rows = [(k, a, b) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b]
    return pa.table(
        {
            "slice": pa.array([k for k, _, _ in rows], pa.int32()),
            "block": pa.array([number] * len(rows), pa.int32()),
            "grams": pa.array([found[a:b].astype("<u8").tobytes() for _, a, b in rows], pa.binary()),
            "counts": pa.array([count[a:b].astype("<u4").tobytes() for _, a, b in rows], pa.binary()),
        }
    )


def answer(table: pa.Table) -> pa.Table:
    """The totals of one hash range, for every block in the order of its question."""
    every = np.frombuffer(b"".join(table.column("grams").to_pylist()), "<u8")
    count = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
    order = np.argsort(every, kind="stable")
    fresh = np.ones(len(every), bool)
    fresh[1:] = every[order][1:] != every[order][:-1]
    total = np.add.reduceat(count[order].astype(np.int64), np.flatnonzero(fresh))
    mine = np.empty(len(every), np.int64)
    mine[order] = total[np.cumsum(fresh) - 1]
    kind = "<u4" if total.max(initial=0) < 2**32 else "<u8"
    size = [len(g) // 8 for g in table.column("grams").to_pylist()]
    cut = offsets_of(np.array(size, np.int64))
    totals = [mine[a:b].astype(kind).tobytes() for a, b in zip(cut[:-1], cut[1:])]
    return pa.table(
        {"slice": table.column("slice"), "block": table.column("block"), "wide": pa.array([kind == "<u8"] * len(size)), "totals": pa.array(totals, pa.binary())}
    )


def score(docs: pa.Table, answers: pa.Table, order: int, alpha: float) -> pa.Table:
    """Scores of the documents of one block."""
    counts, levels = _block(docs, order)
    found, _ = _distinct(levels)
    rows = sorted(zip(answers.column("slice").to_pylist(), answers.column("wide").to_pylist(), answers.column("totals").to_pylist()))
    total = np.concatenate([np.frombuffer(t, "<u8" if wide else "<u4").astype(np.int64) for _, wide, t in rows])
    if len(total) != len(found):
        raise ValueError("the totals are not those of this block")
    doc = np.repeat(np.arange(len(counts)), counts)
    left = np.maximum(1, total[0] - counts)[doc].astype(np.float64)
    elsewhere = []
    for level in levels:
        at = np.searchsorted(found, level)
        pair = doc * np.int64(len(found)) + at
        _, back, own = np.unique(pair, return_inverse=True, return_counts=True)
        elsewhere.append(np.where(level > 0, total[at] - own[back], 0))
    value = np.log(np.where(elsewhere[0] > 0, elsewhere[0], alpha) / left) if len(doc) else np.zeros(0)
    for size in range(2, order + 1):
        seen = elsewhere[size - 1] > 0
        history = np.concatenate([np.zeros(1, np.int64), elsewhere[size - 2][:-1]]) if len(doc) else np.zeros(0)
        longer = np.log(np.where(seen, elsewhere[size - 1], 1) / np.maximum(history, 1))
        value = np.where(seen, longer, np.where(levels[size - 1] > 0, math.log(alpha) + value, value))
    sums = np.bincount(doc, value, len(counts))
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(counts.astype(np.int64)), "log_score": pa.array(sums.astype(np.float64))})


def backoff_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score) of every document of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(held / block_bytes))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"), "doc_id", "text")

    def question(table: pa.Table) -> pa.Table:
        return ask(table, order, blocks)

    def scores(table: pa.Table, answers: pa.Table) -> pa.Table:
        return score(table, answers, order, alpha)

    # partitions grow with the blocks, so a task has a few blocks or ranges at any size of the table
    asked = dealt.repartition(blocks, "block").groupBy("block").applyInArrow(question, "slice int, block int, grams binary, counts binary")
    answers = asked.repartition(blocks, "slice").groupBy("slice").applyInArrow(answer, "slice int, block int, wide boolean, totals binary")
    texts, totals = dealt.repartition(blocks, "block"), answers.repartition(blocks, "block")
    return (
        texts.groupBy("block")
        .cogroup(totals.groupBy("block"))
        .applyInArrow(scores, "doc_id long, n_words long, log_score double")
    )


def _means(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id",
        "n_words",
        (F.round("log_score", 4) + 0.0).alias("log_score"),
        (F.round(F.coalesce(F.try_divide("log_score", "n_words"), F.lit(0.0)), 6) + 0.0).alias("mean_log_score"),
    )


def op10_backoff(docs: DataFrame) -> DataFrame:
    """One row per document: its words, and the logarithm of its score and the mean of it per word."""
    return _means(backoff_scores(docs))


def op10_backoff_order3(docs: DataFrame) -> DataFrame:
    """``op10_backoff`` with two words of context, so that trigrams count."""
    return _means(backoff_scores(docs, order=3))


# Rows are numbered first, as each row is a document of its own.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), p AS (
  SELECT k, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d WHERE len(ws) > 0
), b AS (
  SELECT *, lag(w) OVER (PARTITION BY k ORDER BY i) AS h FROM p
), uni AS (SELECT w, count(*) AS c FROM b GROUP BY w),
own_uni AS (SELECT k, w, count(*) AS c FROM b GROUP BY k, w),
bi AS (SELECT h, w, count(*) AS c FROM b WHERE h IS NOT NULL GROUP BY h, w),
own_bi AS (SELECT k, h, w, count(*) AS c FROM b WHERE h IS NOT NULL GROUP BY k, h, w),
s AS (
  SELECT b.k, b.h, greatest(1, (SELECT count(*) FROM p) - len(d.ws)) AS n,
         uni.c - own_uni.c AS cw, hu.c - hown.c AS ch, bi.c - own_bi.c AS cb
  FROM b JOIN d USING (k) JOIN uni USING (w) JOIN own_uni USING (k, w)
  LEFT JOIN uni hu ON hu.w = b.h LEFT JOIN own_uni hown ON hown.k = b.k AND hown.w = b.h
  LEFT JOIN bi ON bi.h = b.h AND bi.w = b.w
  LEFT JOIN own_bi ON own_bi.k = b.k AND own_bi.h = b.h AND own_bi.w = b.w
), v AS (
  SELECT k, CASE WHEN h IS NOT NULL AND cb > 0 THEN ln(cb / CAST(ch AS DOUBLE))
                 ELSE ln((CASE WHEN cw > 0 THEN cw ELSE CAST(0.4 AS DOUBLE) END) / CAST(n AS DOUBLE))
                      + CASE WHEN h IS NULL THEN 0 ELSE ln(CAST(0.4 AS DOUBLE)) END END AS x
  FROM s
), t AS (SELECT k, sum(x) AS x FROM v GROUP BY k)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, round(coalesce(t.x, 0), 4) + CAST(0 AS DOUBLE) AS log_score,
       round(CASE WHEN len(d.ws) > 0 THEN t.x / len(d.ws) ELSE 0 END, 6) + CAST(0 AS DOUBLE) AS mean_log_score
FROM d LEFT JOIN t USING (k)
"""

ORACLE_ORDER3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), p AS (
  SELECT k, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d WHERE len(ws) > 0
), b AS (
  SELECT *, lag(w) OVER (PARTITION BY k ORDER BY i) AS h, lag(w, 2) OVER (PARTITION BY k ORDER BY i) AS g FROM p
), e AS (
  SELECT *, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY k, w) AS c1,
         CASE WHEN h IS NOT NULL THEN count(*) OVER (PARTITION BY h, w) - count(*) OVER (PARTITION BY k, h, w) ELSE 0 END AS c2,
         CASE WHEN g IS NOT NULL THEN count(*) OVER (PARTITION BY g, h, w) - count(*) OVER (PARTITION BY k, g, h, w) ELSE 0 END AS c3
  FROM b
), s AS (
  SELECT e.*, greatest(1, (SELECT count(*) FROM p) - len(d.ws)) AS n,
         lag(c1) OVER (PARTITION BY k ORDER BY i) AS h1, lag(c2) OVER (PARTITION BY k ORDER BY i) AS h2
  FROM e JOIN d USING (k)
), v AS (
  SELECT k, CASE WHEN c3 > 0 THEN ln(c3 / CAST(h2 AS DOUBLE))
                 ELSE CASE WHEN g IS NULL THEN 0 ELSE ln(CAST(0.4 AS DOUBLE)) END
                      + CASE WHEN c2 > 0 THEN ln(c2 / CAST(h1 AS DOUBLE))
                             ELSE CASE WHEN h IS NULL THEN 0 ELSE ln(CAST(0.4 AS DOUBLE)) END
                                  + ln((CASE WHEN c1 > 0 THEN c1 ELSE CAST(0.4 AS DOUBLE) END) / CAST(n AS DOUBLE)) END END AS x
  FROM s
), t AS (SELECT k, sum(x) AS x FROM v GROUP BY k)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, round(coalesce(t.x, 0), 4) + CAST(0 AS DOUBLE) AS log_score,
       round(CASE WHEN len(d.ws) > 0 THEN t.x / len(d.ws) ELSE 0 END, 6) + CAST(0 AS DOUBLE) AS mean_log_score
FROM d LEFT JOIN t USING (k)
"""
