"""Count-Min sketch as a table of (row_id, col_id, cnt) cells.

Cormode and Muthukrishnan (2005): estimates never fall below the true count and exceed it
by more than e/width of all updates with probability at most exp(-depth). Building is two
map-side combined aggregations; sketches merge by adding cells, so batches, partitions and
days combine in any order.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_CELLS = 1_000_000


@dataclass(frozen=True)
class Sketch:
    """Shape and hash family; two sketches with equal parameters can be merged."""

    # The published shape and seed.
    width: int = 1000
    depth: int = 5
    seed: int = 42

    def __post_init__(self) -> None:
        if self.width < 1 or self.depth < 1:
            raise ValueError("width and depth must be at least 1")

    @property
    def row_seeds(self) -> list[int]:
        rng = random.Random(self.seed)
        return [rng.randint(0, 2**31 - 1) for _ in range(self.depth)]

    @property
    def epsilon(self) -> float:
        return math.e / self.width

    @property
    def delta(self) -> float:
        return math.exp(-self.depth)

    def cells_of(self, key: Column) -> Column:
        """The (row_id, col_id) cells of a key: md5 of seed and key, first 8 bytes mod width."""
        text = F.encode(key, "UTF-8")
        cells = []
        for row, seed in enumerate(self.row_seeds):
            digest = F.md5(F.concat(F.unhex(F.lit(f"{seed:08X}")), text))
            head = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
            cells.append(
                F.struct(
                    F.lit(row).alias("row_id"), (head % self.width).cast("int").alias("col_id")
                )
            )
        return F.array(*cells)

    def build(self, updates: DataFrame, key: str, count: str | None = None) -> DataFrame:
        """Cells of the updates; counts below one are ignored."""
        amount = F.col(count) if count else F.lit(1)
        counts = (
            updates.filter(amount >= 1)
            .groupBy(F.col(key).alias("key"))
            .agg(F.sum(amount).alias("n"))
        )
        return (
            counts.select(F.inline(self.cells_of(F.col("key"))), "n")
            .groupBy("row_id", "col_id")
            .agg(F.sum("n").alias("cnt"))
        )

    def merge(self, *sketches: DataFrame) -> DataFrame:
        first, *rest = sketches
        for other in rest:
            first = first.unionByName(other)
        return first.groupBy("row_id", "col_id").agg(F.sum("cnt").alias("cnt"))

    def _estimate(self, cells: DataFrame, wanted: DataFrame) -> DataFrame:
        """Each row of ``wanted`` (with a ``key``) and the smallest of its key's cells."""
        # A sketch has at most depth * width cells, known before any data is read.
        small = self.depth * self.width <= BROADCAST_CELLS
        table = F.broadcast(cells) if small else cells
        looked_up = wanted.select("*", F.inline(self.cells_of(F.col("key"))))
        joined = looked_up.join(table, ["row_id", "col_id"], "left")
        least = F.min(F.coalesce("cnt", F.lit(0))).alias("estimate")
        extra = [F.max(c).alias(c) for c in cells.columns if c not in ("row_id", "col_id", "cnt")]
        return joined.groupBy(*wanted.columns).agg(least, *extra)

    def query(self, cells: DataFrame, candidates: DataFrame, key: str = "key") -> DataFrame:
        """Estimate per distinct candidate: the smallest of its cells, zero if one is empty."""
        return self._estimate(cells, candidates.select(F.col(key).alias("key")).distinct())

    def top_k(self, cells: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
        """The k candidates (key, pos) with the highest estimates; ties keep candidate order."""
        ranked = self._estimate(cells, candidates.select("key", "pos"))
        return ranked.orderBy(F.col("estimate").desc(), "pos").limit(k)

    def total(self, cells: DataFrame) -> DataFrame:
        """All updates: every row of the sketch sums to it."""
        return cells.filter("row_id = 0").agg(F.sum("cnt").alias("total"))

    def error_report(self, cells: DataFrame, exact: DataFrame) -> DataFrame:
        """Overcount of every key of ``exact`` (key, true_count) against the error budget."""
        # Every row of the sketch adds up to the total, so each cell can carry it along.
        with_total = cells.withColumn("total", F.sum("cnt").over(Window.partitionBy("row_id")))
        over = F.col("estimate") - F.col("true_count")
        budget = F.coalesce(F.col("epsilon") * F.col("total"), F.lit(0.0))
        return (
            self._estimate(with_total, exact.select("key", "true_count"))
            .withColumns({"overcount": over, "epsilon": F.lit(self.epsilon), "delta": F.lit(self.delta)})
            .withColumn("within_budget", F.col("overcount") <= budget)
        )


HEAVY = "key string, cnt bigint, lost bigint"


def heavy_hitters(updates: DataFrame, key: str, k: int, count: str | None = None) -> DataFrame:
    """(key, cnt, lost): a mergeable summary of at most ``k`` keys (Misra and Gries, 1982).

    Every partition counts its own keys, pruned to ``k`` whenever there are more than four times as many, so no
    shuffle of all keys is needed. Of N updates a key's true count lies between cnt and cnt + lost, and lost is at most
    N / (k + 1); each key of more than N / (k + 1) updates is held. Null keys and counts below one are left out.
    """
    amount = F.col(count) if count else F.lit(1)
    rows = updates.select(F.col(key).cast("string").alias("key"), amount.cast("bigint").alias("cnt"))
    rows = rows.where(F.col("key").isNotNull() & (F.col("cnt") >= 1))

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, lost = pd.Series(dtype="int64"), 0

        def prune(counts: pd.Series) -> tuple[pd.Series, int]:
            if len(counts) <= k:
                return counts, 0
            least = int(np.partition(counts.to_numpy(), len(counts) - k - 1)[len(counts) - k - 1])
            return (counts - least)[counts > least], least

        for batch in batches:
            held = held.add(batch.groupby("key")["cnt"].sum(), fill_value=0).astype("int64")
            if len(held) > 4 * k:
                held, least = prune(held)
                lost += least
        held, least = prune(held)
        lost += least
        if len(held) or lost:
            # what a partition has lost counts against every key, those it does not hold too
            yield pd.DataFrame({"key": [*held.index, None], "cnt": [*held, 0], "lost": [0] * len(held) + [lost]})

    return merge_heavy(rows.mapInPandas(summarise, HEAVY), k=k)


def merge_heavy(*summaries: DataFrame, k: int) -> DataFrame:
    """One summary of at most ``k`` keys from several; the bounds stay those of all updates together."""
    parts = summaries[0]
    for other in summaries[1:]:
        parts = parts.unionByName(other)
    counts = parts.groupBy("key").agg(F.sum("cnt").alias("cnt"), F.sum("lost").alias("lost"))
    top = counts.where(F.col("key").isNotNull()).orderBy(F.desc("cnt"), "key").limit(k + 1)
    # k + 1 rows at most, so one window is enough; the last of k + 1 is what all of them lose
    ranked = top.withColumn("_place", F.row_number().over(Window.orderBy(F.desc("cnt"), "key")))
    less = ranked.where(F.col("_place") == k + 1).agg(F.coalesce(F.max("cnt"), F.lit(0).cast("bigint"))).scalar()
    before = counts.where(F.col("key").isNull()).agg(F.coalesce(F.max("lost"), F.lit(0).cast("bigint"))).scalar()
    kept = ranked.where(F.col("_place") <= k).select("key", (F.col("cnt") - less).alias("cnt"), F.lit(0).cast("bigint").alias("lost"))
    mark = parts.sparkSession.createDataFrame([(None, 0)], "key string, cnt bigint").withColumn("lost", less + before)
    return kept.where(F.col("cnt") > 0).unionByName(mark)


def heavy_keys(summary: DataFrame) -> DataFrame:
    """(key, low, high): the bounds of the true count of each key held."""
    lost = summary.where(F.col("key").isNull()).agg(F.coalesce(F.max("lost"), F.lit(0).cast("bigint"))).scalar()
    return summary.where(F.col("key").isNotNull()).select("key", F.col("cnt").alias("low"), (F.col("cnt") + lost).alias("high"))


def builtin_sketch(df: DataFrame, key: str, eps: float, confidence: float, seed: int) -> DataFrame:
    """Spark's own sketch of the same purpose (another hash, a binary state)."""
    state = F.count_min_sketch(key, F.lit(eps), F.lit(confidence), F.lit(seed))
    return df.agg(state.alias("sketch"), F.count(key).alias("total"))


def builtin_cells(rows: DataFrame) -> DataFrame:
    """(row_id, counted, busiest) of the state of a ``builtin_sketch``: the sum and the largest of each row's cells.

    Every update is in one cell of each row, so ``counted`` is the number of updates in all rows, and no ``busiest`` is
    below the count of the most frequent key.
    """

    def number(start: Column, size: int) -> Column:
        return F.conv(F.hex(F.substring("sketch", start, F.lit(size))), 16, 10).cast("long")

    # fixed format: version 4 bytes, total 8, depth 4, width 4, one hash of 8 bytes a row, then the cells of 8 bytes row by row
    sized = rows.select("sketch", number(F.lit(13), 4).alias("depth"), number(F.lit(17), 4).alias("width"))
    first = 21 + 8 * F.col("depth")
    row = sized.withColumn("row_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth") - 1)))
    cell = row.withColumn("col_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("width") - 1)))
    at = (first + 8 * (F.col("row_id") * F.col("width") + F.col("col_id"))).cast("int")
    cells = cell.select("row_id", number(at, 8).alias("cnt"))
    return cells.groupBy("row_id").agg(F.sum("cnt").alias("counted"), F.max("cnt").alias("busiest"))
