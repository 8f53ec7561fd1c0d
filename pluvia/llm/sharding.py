"""Consistent hashing with bounded loads.

Every shard stands at ``POINTS`` places of a ring of hash values. A key belongs to the first place at or
after its own hash value; once that place's shard is full, the key goes on clockwise to the next place
whose shard has room. ``slack`` sets how much more than the mean load a shard may hold; with none, the
capacities add up to the number of rows and the counts of two shards differ by one at most.

Keys enter in the order of their hash value, so where they go can be told from counts alone. The ring is
cut into cells, each with about ``CELL_ROWS`` rows however many there are; Spark counts the rows of every
cell, the walk along the ring runs over those counts, and its outcome is for every cell a short list of
(first rank, shard, first slot). A row's rank in its cell then gives its shard and its slot. Nothing
but counts per cell is ever gathered, and a full shard is skipped in one step. Whether the short lists
are sent to every task is left to their size.

Rows that are equal in everything are counted together and numbered afterwards, so no cell grows with
them. A null key is a key like any other. A null text has no bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS, POINTS, CELL_ROWS, CHUNK = 24, 64, 100_000, 100_000
BITS = 52


def ring_value(*columns: str) -> Column:
    """A place on the ring of 2^52 values, from the MD5 of the columns as text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x01", *parts)), 1, BITS // 4), 16, 10).cast("long")


def ring(shards: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """(places in order, shard of each place)."""
    import hashlib

    text = [(hashlib.md5(f"shard {s} point {p}".encode()).hexdigest()[: BITS // 4], s) for s in range(shards) for p in range(points)]
    order = sorted((int(t, 16), s) for t, s in text)
    return np.array([p for p, _ in order], np.int64), np.array([s for _, s in order], np.int32)


def walk(cells: np.ndarray, counts: np.ndarray, owner: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot) for the keys of each cell in ring order.

    ``cells`` holds the index of the place that owns each cell; ``owner`` is the shard of each place.
    """
    places = len(owner)
    room = capacity.astype(np.int64).copy()
    used = np.zeros(len(capacity), np.int64)
    onward = list(range(places))  # the next place whose shard may have room

    def find(k: int) -> int:
        path = []
        for _ in range(2 * places + 2):
            if onward[k] == k and room[owner[k]] > 0:
                break
            path.append(k)
            k = onward[k] if onward[k] != k else (k + 1) % places
        for p in path:
            onward[p] = k
        return k

    out = []
    for c, (place, count) in enumerate(zip(cells.tolist(), counts.tolist())):
        rank, k = 0, place
        while rank < count:
            k = find(k)
            shard = int(owner[k])
            taken = min(count - rank, int(room[shard]))
            out.append((c, rank, rank + taken, shard, int(used[shard])))
            room[shard] -= taken
            used[shard] += taken
            rank += taken
    return out


def assign(rows: DataFrame, key: str, shards: int = SHARDS, slack: float = 0.0, points: int = POINTS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``. All columns of ``rows`` are ordinary values.

    Rows that differ only in other columns than the key stand in the order of their MD5.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    placed = counted.withColumn("_point", ring_value(key))
    total = rows.count()
    spread = np.full(shards, total // shards, np.int64)
    spread[: total % shards] += 1
    capacity = np.maximum(spread, math.ceil(total / shards * (1 + slack)) if slack else 0)
    place, owner = ring(shards, points)
    cells = max(1, math.ceil(total / CELL_ROWS))
    # a cell never reaches over a place: both are bounds of the cells
    bounds = np.unique(np.concatenate([place, np.arange(1, cells) * (1 << BITS) // cells]))
    slot_of = np.searchsorted(place, bounds) % len(place)
    # the last stretch, after the last bound, belongs to the first place
    slot_of = np.append(slot_of, 0)
    step = max(1, (1 << BITS) // max(1, 4 * len(bounds)))
    return _placed(placed, bounds, slot_of, owner, capacity, step, columns)


def _placed(placed, bounds, slot_of, owner, capacity, step, columns):
    spark = placed.sparkSession
    # the cell of a point: the number of bounds below it, by a join on a coarse grid of the ring
    grid = np.arange(0, (1 << BITS) + step, step)
    first = np.searchsorted(bounds, grid[:-1])
    last = np.searchsorted(bounds, grid[1:] - 1)
    ring_map = spark.createDataFrame(
        pd.DataFrame(
            {
                "_grid": np.arange(len(grid) - 1),
                "_first": first.astype(np.int64),
                "_bounds": [bounds[a:b].tolist() for a, b in zip(first, last)],
            }
        ),
        "_grid long, _first long, _bounds array<long>",
    )
    celled = (
        placed.withColumn("_grid", F.floor(F.col("_point") / step))
        .join(ring_map, "_grid")
        .withColumn("_cell", F.col("_first") + F.size(F.filter("_bounds", lambda b: b < F.col("_point"))))
        .drop("_grid", "_first", "_bounds")
    )
    counts = celled.groupBy("_cell").agg(F.sum("_copies").alias("n")).toPandas()
    full = np.zeros(len(slot_of), np.int64)
    full[counts["_cell"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    steps = walk(slot_of, full, owner, capacity)
    plan = pd.DataFrame(steps, columns=["_cell", "_from", "_to", "shard", "_slot"])
    plan = spark.createDataFrame(plan, "_cell long, _from long, _to long, shard int, _slot long")
    in_cell = Window.partitionBy("_cell").orderBy("_point", F.md5(F.concat_ws("\x01", *[F.col(c).cast("string") for c in columns])))
    ranked = celled.withColumn("_end", F.sum("_copies").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.col("_end") - F.col("_copies")
    low, high = F.greatest(begin, F.col("_from")), F.least("_end", F.col("_to"))
    joined = ranked.join(plan, "_cell").where(low < high)
    chunks = F.sequence(low, high - 1, F.lit(CHUNK))
    return (
        joined.select(*columns, "shard", (F.col("_slot") - F.col("_from")).alias("_shift"), high.alias("_high"), F.explode(chunks).alias("_at"))
        .select(*columns, "shard", "_shift", F.explode(F.sequence("_at", F.least(F.col("_at") + CHUNK, F.col("_high")) - 1)).alias("_rank"))
        .select(*columns, "shard", (F.col("_rank") + F.col("_shift")).alias("slot"))
    )


def op5_sharding(docs: DataFrame) -> DataFrame:
    """All documents in 24 shards whose counts are at most one apart."""
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    return assign(rows, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
