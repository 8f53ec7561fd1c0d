"""Approximate nearest neighbours by a hash-prefix forest over the whole table.

A vector has one long hash string per tree, of ``SYMBOLS`` symbols: a symbol names the axis, with its
sign, on which the vector reaches furthest in a random projection to ``AXES`` dimensions, after the mean of all
vectors has been taken off. A tree is the sorted array of its strings, so all strings with one prefix lie next
to each other. The arrays are dealt by the first symbols into parts of some ``PART`` entries, crowded parts into slices of
``SLICE``; a query is sent to the parts of its own prefixes only. It descends every tree to the longest prefix that
any string shares with its own, then ascends in all trees at once, symbol by symbol, until ``wanted``
entries have come together; at the last level trees are taken one by one. A query that finds too few in its
parts asks again in parts one symbol shorter, down to whole trees. What was found is compared by the exact
cosine in the block of rows where it lies, and ``rows_read`` says how many rows a query was compared with.

Every row is indexed. Of rows that hold the same vector only the k + 1 smallest ids are kept, each at most k
times, as no other can be among the k nearest of any query (same cosine, larger id, or the query's own);
with that a very common vector is no crowd. Planes depend on a seed and the width of the vectors; the
mean is a sum of integers, so it does not depend on the order of addition.

Vectors that are null, empty, zero or hold a null or a non-finite component take no part, nor do rows
without an id; only vectors of one length are compared. Rows with the query's own id are no candidates; equal
query rows count once. Ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.vectors import BLOCK, packed, usable
from pluvia.session import new_folder

K, TREES, SYMBOLS, AXES, SEED = 5, 128, 12, 8, 11
SYMBOL_BITS = (2 * AXES - 1).bit_length()
# entries per query: WANTED * rows ** GROWTH
WANTED, GROWTH = 5.2, 0.72
PART, SLICE, GATHERED, ASKED = 1 << 16, 1 << 20, 1 << 22, 4096
FIXED = 1 << 20
QUERY, PLACE = ["query", "hash", "width"], ["width", "tree", "part"]
ENTRIES = "width int, tree int, part long, block int, many long, keys binary, rows binary"
NEAR = "query_id long, vec_id long, score double, rows_read long"


def planes(width: int, tree: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, width, tree]).standard_normal((width, SYMBOLS * AXES)).astype(np.float32)


def strings(unit: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """The hash strings of rows, first symbol highest."""
    reach = (unit @ plane).reshape(len(unit), SYMBOLS, AXES)
    axis = np.abs(reach).argmax(axis=2)
    side = np.take_along_axis(reach, axis[:, :, None], axis=2)[:, :, 0] > 0
    shift = SYMBOL_BITS * np.arange(SYMBOLS - 1, -1, -1, dtype=np.int64)
    return ((2 * axis.astype(np.int64) + side) << shift).sum(axis=1)


def prefix_range(array: np.ndarray, asked: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the entries of a sorted array that share ``level`` symbols with each asked string."""
    cut = SYMBOL_BITS * (SYMBOLS - np.asarray(level, np.int64))
    prefix = asked >> cut
    return np.searchsorted(array, prefix << cut), np.searchsorted(array, (prefix + 1) << cut)


def units(v: np.ndarray) -> np.ndarray:
    largest = np.abs(v).max(axis=1, keepdims=True)
    scaled = v / largest
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def means(held: DataFrame) -> DataFrame:
    """(width, centre): the mean direction of all packed rows of one width."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                v = units(np.frombuffer(r.body).reshape(-1, r.width))
                total = np.rint(v.astype(np.float64) * FIXED).astype(np.int64).sum(axis=0)
                yield pd.DataFrame({"width": r.width, "at": np.arange(r.width), "total": total, "many": len(v)})

    each = held.select("width", "body").mapInPandas(run, "width int, at int, total long, many long")
    mean = each.groupBy("width", "at").agg((F.sum("total") / F.sum("many") / FIXED).alias("mean"))
    listed = F.array_sort(F.collect_list(F.struct("at", "mean")))
    return mean.groupBy("width").agg(F.transform(listed, lambda s: s["mean"]).alias("centre"))


def sorted_arrays(held: DataFrame, deal: int, trees: int) -> DataFrame:
    """A row for every block, tree and first ``deal`` symbols: the block's strings there, sorted."""
    shift = SYMBOL_BITS * (SYMBOLS - deal)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                unit = units(np.frombuffer(r.body).reshape(-1, r.width)) - np.asarray(r.centre, np.float32)
                made = []
                for tree in range(trees):
                    keys = strings(unit, planes(r.width, tree))
                    order = np.argsort(keys, kind="stable")
                    keys, part = keys[order], keys[order] >> shift
                    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(keys)]
                    for a, b in zip(cuts, cuts[1:]):
                        rows = order[a:b].astype(np.int32)
                        made.append((r.width, tree, part[a], r.block, b - a, keys[a:b].tobytes(), rows.tobytes()))
                yield pd.DataFrame(made, columns=["width", "tree", "part", "block", "many", "keys", "rows"])

    return held.select("block", "width", "centre", "body").mapInPandas(run, ENTRIES)


def asked_strings(queries: DataFrame, trees: int) -> DataFrame:
    """(query, hash, width, tree, key): the string of every query in every tree."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, same in frame.groupby("width"):
                unit = units(np.stack(same["vector"].to_list())) - np.asarray(same["centre"].iloc[0], np.float32)
                for tree in range(trees):
                    key = strings(unit, planes(width, tree))
                    yield same[QUERY].assign(tree=tree, key=key)

    wanted = queries.select(*QUERY, "vector", "centre")
    return wanted.mapInPandas(run, "query long, hash long, width int, tree int, key long")


def dealt(asked: DataFrame, arrays: DataFrame, deal: int, at: int, salts: int = 1):
    """Queries and arrays cogrouped by tree, first ``at`` symbols, slice of the array and salt of the query."""
    here = arrays.withColumn("part", F.shiftright("part", SYMBOL_BITS * (deal - at)))
    sizes = here.groupBy(*PLACE).agg(F.ceil(F.sum("many") / SLICE).cast("int").alias("slices"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    held = here.join(sizes, PLACE).withColumn("slice", F.pmod("block", "slices")).drop("slices").withColumn("salt", salt)
    each = sizes.select(*PLACE, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    sent = asked.withColumn("part", F.shiftright("key", SYMBOL_BITS * (SYMBOLS - at))).join(each, PLACE)
    sent = sent.withColumn("salt", F.pmod(F.xxhash64("query", "hash"), F.lit(salts)).cast("int"))
    cell = [*PLACE, "slice", "salt"]
    return sent.groupBy(*cell).cogroup(held.groupBy(*cell))


def levels(asked: DataFrame, arrays: DataFrame, deal: int, at: int, wanted: int) -> DataFrame:
    """The level that each query takes in each tree, not above ``at`` symbols; no row for a query that needs more.

    The level falls from the longest prefix for all trees of a query together until they hold ``wanted``
    entries; of the last step only as many trees are taken, in their order, as are needed.
    """
    steps = range(at, SYMBOLS + 1)
    names = [f"n{x}" for x in steps]

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = left[[*QUERY, "tree", "key"]].copy()
        joined = [np.frombuffer(b, np.int64) for b in right["keys"]] if len(out) else []
        array = np.sort(np.concatenate([np.zeros(0, np.int64), *joined]))
        for x, name in zip(steps, names):
            first, end = prefix_range(array, out["key"].to_numpy(np.int64), x)
            out[name] = end - first
        return out

    schema = "query long, hash long, width int, tree int, key long, " + ", ".join(f"{n} long" for n in names)
    counted = dealt(asked, arrays, deal, at).applyInPandas(count, schema)
    per_tree = counted.groupBy(*QUERY, "tree", "key").agg(*(F.sum(n).alias(n) for n in names))
    whole = Window.partitionBy(*QUERY)
    before = whole.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    totals = F.array(*(F.sum(n).over(whole) for n in names))
    reached = F.array_max(F.transform("totals", lambda t, i: F.when(t >= wanted, i)))
    frame = per_tree.select("*", F.array(*names).alias("own"), totals.alias("totals")).withColumn(
        "step", F.coalesce(reached, F.lit(0 if at == 0 else None).cast("int"))
    )
    deeper = F.coalesce(F.get("own", F.col("step") + 1), F.get("own", "step"))
    added = F.coalesce(F.sum(F.get("own", "step") - deeper).over(before), F.lit(0))
    enough = F.coalesce(F.get("totals", F.col("step") + 1) + added >= wanted, F.lit(False))
    level = F.col("step") + at + F.when(enough, 1).otherwise(0)
    return frame.where(F.col("step").isNotNull()).select(*QUERY, "tree", "key", level.cast("int").alias("level"))


def gathered(chosen: DataFrame, arrays: DataFrame, deal: int, at: int, salts: int) -> DataFrame:
    """(query, hash, width, blocks, rows): the entries of each range that was chosen, as two lists of 32-bit numbers."""

    def gather(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        some = right if len(left) else right[:0]
        keys = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(b, np.int64) for b in some["keys"])])
        rows = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(b, np.int32) for b in some["rows"])])
        blocks = np.repeat(some["block"].to_numpy(np.int32), some["many"].to_numpy(np.int64))
        order = np.argsort(keys, kind="stable")
        first, end = prefix_range(keys[order], left["key"].to_numpy(np.int64), left["level"].to_numpy(np.int64))
        out = left[QUERY].copy()
        for name, held in (("blocks", blocks[order].tobytes()), ("rows", rows[order].tobytes())):
            out[name] = [held[4 * a : 4 * b] for a, b in zip(first, end)]
        return out[end > first]

    schema = "query long, hash long, width int, blocks binary, rows binary"
    return dealt(chosen, arrays, deal, at, salts).applyInPandas(gather, schema)


def by_block(found: DataFrame) -> DataFrame:
    """(query, hash, width, block, rows): the different rows that the trees found for a query, a list for each block."""

    def unite(frame: pd.DataFrame) -> pd.DataFrame:
        block, row = (np.concatenate([np.frombuffer(b, np.int32) for b in frame[c]]).astype(np.int64) for c in ("blocks", "rows"))
        entry = np.unique(block << 32 | row)
        block, row = entry >> 32, entry.astype(np.int32)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(entry)]
        query = tuple(frame[c].iloc[0] for c in QUERY)
        made = [(*query, block[a], row[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
        return pd.DataFrame(made, columns=[*QUERY, "block", "rows"])

    return found.groupBy(*QUERY).applyInPandas(unite, "query long, hash long, width int, block int, rows binary")


def compared(found: DataFrame, queries: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """The k best of each query and block by exact cosine, with the number of rows compared."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left):
            width = int(right["width"].iloc[0])
            ids, v = np.frombuffer(right["ids"].iloc[0], np.int64), np.frombuffer(right["body"].iloc[0]).reshape(-1, width)
            unit = units(v)
        for r in left.itertuples(index=False):
            rows = np.frombuffer(r.rows, np.int32)
            rows = rows[ids[rows] != r.query]
            q, read = np.asarray(r.vector)[None], len(rows)
            if read > 4 * k:
                near = unit[rows] @ units(q)[0]
                # single precision errs by far less than the margin
                rows = rows[near >= np.partition(near, read - k)[read - k] - 1e-4]
            value = cosine(q, v[rows])
            best = np.lexsort((ids[rows], -value))[:k]
            out += [(r.query, ids[rows[j]], value[j], 0 if n else read) for n, j in enumerate(best)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "rows_read"])

    parts = max(1, math.ceil(queries.count() / ASKED))
    cell = ["width", "block", "salt"]
    asks = by_block(found).join(queries.select(*QUERY, "vector"), QUERY).withColumn("salt", F.pmod("hash", F.lit(parts)).cast("int"))
    blocks = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return asks.groupBy(*cell).cogroup(blocks.groupBy(*cell)).applyInPandas(score, NEAR)


def nearest(
    queries: DataFrame, rows: DataFrame, k: int = K, trees: int = TREES, wanted: int | None = None, deal: int | None = None
) -> DataFrame:
    """The k nearest rows found for every query; both tables are (id, vector of doubles).

    ``wanted`` entries are gathered per query (by default they grow with the table, see ``WANTED``); arrays are dealt by
    their first ``deal`` symbols (by default as many as keep parts near ``PART`` entries).
    """
    spark = rows.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_folder(spark, f"ann-{label}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    same, copies = Window.partitionBy("vector").orderBy("id"), F.least(F.count(F.lit(1)), F.lit(k))
    counted = rows.groupBy("id", "vector").agg(copies.alias("copies"))
    few = counted.withColumn("nth", F.dense_rank().over(same)).where(F.col("nth") <= k + 1)
    indexed = few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("id", "vector")
    held = stored(packed(indexed, BLOCK, "f8"), "rows")
    many = held.agg(F.sum(F.octet_length("ids") / 8)).first()[0] or 0
    wanted = wanted or math.ceil(WANTED * many**GROWTH)
    if deal is None:
        deal = max(0, int(math.log(max(many / PART, 1), 2 * AXES)))
    salts = max(1, math.ceil(wanted / trees * SLICE / 50 / GATHERED))

    centre = means(held)
    arrays = stored(sorted_arrays(held.join(centre, "width"), deal, trees), "forest")
    apart = queries.distinct().where(F.size("vector") > 0)
    apart = apart.select(F.col("id").alias("query"), F.xxhash64("vector").alias("hash"), F.size("vector").alias("width"), "vector")
    apart = stored(apart.join(centre, "width"), "queries")
    asked = asked_strings(apart, trees)

    found = None
    for at in range(deal, -1, -1):
        chosen = levels(asked, arrays, deal, at, wanted)
        if at:
            chosen = stored(chosen, "levels")
        here = gathered(chosen, arrays, deal, at, salts)
        found = here if found is None else found.unionByName(here)
        if at:
            asked = stored(asked.join(chosen.select(*QUERY).distinct(), QUERY, "left_anti"), "open")
            if asked.isEmpty():
                break

    each = compared(found, apart, held, k)
    of_query = Window.partitionBy("query_id")
    rank = F.row_number().over(of_query.orderBy(F.desc("score"), "vec_id"))
    ranked = each.select("*", rank.alias("rank"), F.sum("rows_read").over(of_query).alias("read")).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.col("read").alias("rows_read"))


def op3_ann(embeddings: DataFrame) -> DataFrame:
    """The 5 nearest rows found for every row whose vec_id is divisible by 50, and how many rows it was compared with."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = (
        embeddings.where(F.col("vec_id").isNotNull() & usable("embedding"))
        .select(F.col("vec_id").cast("long").alias("id"), vector.alias("vector"))
        .where(F.exists("vector", lambda x: x != 0))
    )
    return nearest(rows.where(F.col("id") % 50 == 0), rows)
