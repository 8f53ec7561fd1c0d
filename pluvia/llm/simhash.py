"""Near duplicates by SimHash, candidates by pigeonring filtering.

A fingerprint is cut into ``SEGMENTS`` consecutive segments on a ring. If two fingerprints differ in at
most t bits, then some segment starts a chain whose differences, added up, stay within
length * t / SEGMENTS at every length: a stronger condition than that of one equal segment. With 5
segments and t = 4 the first segment of such a chain is equal and the second differs in one bit at most.
These two are the key of a bucket: a fingerprint stands in its own bucket of every segment as a member,
and asks in it and in those where one zero bit of the second segment is set (the other side asks for the
reverse). Inside a bucket the rest of the chain is checked before the full distance.

A bucket yields a spanning forest of its links, never all pairs, so a dense group of n fingerprints gives
less than n edges. Buckets above ``BUCKET`` fingerprints are dealt into cells of (members, askers), each
of bounded size. Equal fingerprints are one node. Components come from ``components.connected``.

A null text is an empty one. No word gives fingerprint zero, which is linked like any other; fewer words
than a shingle are one shingle. A null doc_id keeps its row and never names a component, unless all of
its rows are null. Repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, text_chunks
from pluvia.llm.components import connected
from pluvia.llm.shingles import best_of_each, keyed_rows, near_duplicates, place, shingle_hashes, written

__all__ = ["near_duplicates", "one_of_each", "op7_simhash"]  # the first is that of the corpus, by similarity

SHINGLE, LIMIT = 4, 4
WIDTHS = (13, 13, 13, 13, 12)  # bits of the segments, from the lowest
SHIFTS = (0, 13, 26, 39, 52)
BUCKET = 4096

def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    rows = len(offsets) - 1
    hashes, count = shingle_hashes(data, offsets, words)
    out = np.zeros(rows, np.uint64)
    top = offsets_top = np.concatenate([[0], np.cumsum(count)])
    some = np.flatnonzero(count > 0)
    half = count[some]
    for bit in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), offsets_top[some]) if len(some) else top[:0]
        out[some] |= (2 * ones.astype(np.int64) > half).astype(np.uint64) << np.uint64(bit)
    return out


def with_fingerprint(docs: DataFrame, keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        chunks = text_chunks(batch.column(batch.schema.get_field_index("text")))
        parts = [fingerprints(d, o).view(np.int64) for _, _, d, o in chunks]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))]

    return add_columns(docs, [(name, T.LongType())], make, keep)


def _segment(k: int) -> Column:
    k %= len(WIDTHS)
    return F.shiftrightunsigned("fp", SHIFTS[k]).bitwiseAND(F.lit((1 << WIDTHS[k]) - 1).cast("long"))


def _key(k: int, second: Column) -> Column:
    return F.lit(k << 32).cast("long") + F.shiftleft(_segment(k), 13) + second


def entries(nodes: DataFrame) -> DataFrame:
    """(key, fp, asks): where each fingerprint stands, and where it asks."""
    own, asked = [], []
    for k in range(len(WIDTHS)):
        second = _segment(k + 1)
        own.append(F.struct(_key(k, second).alias("key"), F.lit(False).alias("asks")))
        asked.append(F.struct(_key(k, second).alias("key"), F.lit(True).alias("asks")))
        for bit in range(WIDTHS[(k + 1) % len(WIDTHS)]):
            one = F.lit(1 << bit).cast("long")
            free = second.bitwiseAND(one) == 0
            asked.append(F.when(free, F.struct(_key(k, second.bitwiseOR(one)).alias("key"), F.lit(True).alias("asks"))))
    every = F.filter(F.array(*own, *asked), lambda e: e.isNotNull())
    return nodes.select("fp", F.explode(every).alias("e")).select("e.key", "fp", "e.asks")


def crowded(nodes: DataFrame) -> DataFrame:
    """(key, m, a): buckets to be dealt into m parts of members and a parts of askers.

    Only buckets with many members, and those that the same fingerprints ask in, can be crowded. What the
    other fingerprints add to a bucket is less than BUCKET, so a part holds less than twice that.
    """
    few = BUCKET // (max(WIDTHS) + 1)
    own = [_key(k, _segment(k + 1)) for k in range(len(WIDTHS))]
    many = nodes.select(F.explode(F.array(*own)).alias("key")).groupBy("key").count().where(F.col("count") > few)
    bits = F.when(F.shiftright("key", 32) == len(WIDTHS) - 2, WIDTHS[-1]).otherwise(WIDTHS[0])
    asked = many.select(
        "count", F.explode(F.transform(F.sequence(F.lit(0), bits - 1), lambda b: F.col("key").bitwiseOR(F.pow(F.lit(2), b).cast("long")))).alias("to"), "key"
    ).where(F.col("to") != F.col("key"))
    each = many.select("key", F.col("count").alias("members"), F.col("count").alias("askers")).union(
        asked.select("to", F.lit(0).cast("long"), "count")
    )
    total = each.groupBy("key").agg(F.sum("members").alias("members"), F.sum("askers").alias("askers"))
    parts = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BUCKET)).cast("int")
    return total.select("key", parts("members").alias("m"), parts("askers").alias("a")).where("m > 1 or a > 1")


def within_ring(a: np.ndarray, b: np.ndarray, start: int, limit: int = LIMIT) -> np.ndarray:
    """Whether the chain of segments from ``start`` keeps to its budgets at every length.

    The last length is the whole ring, whose budget is ``limit``: the full Hamming check.
    """
    differ, total = a ^ b, np.zeros(len(a), np.int64)
    alive = np.ones(len(a), bool)
    for step in range(len(WIDTHS)):
        k = (start + step) % len(WIDTHS)
        part = (differ >> np.uint64(SHIFTS[k])) & np.uint64((1 << WIDTHS[k]) - 1)
        total += np.bitwise_count(part)
        alive &= total * len(WIDTHS) <= (step + 1) * limit
        if not alive.any():
            break
    return alive


def forest(members: np.ndarray, askers: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Edges that connect what the links between the two sides connect, fewer than there are nodes.

    A node that is linked to the pivot leaves the search on its side; nodes already known to be
    connected are compared no further than that.
    """
    nodes = np.unique(np.concatenate([members, askers]))
    root = np.arange(len(nodes))
    edges = []

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    inside, outside = np.searchsorted(nodes, members), np.searchsorted(nodes, askers)
    for position, node in enumerate(inside):
        here = top(int(node))
        other = outside[root[outside] != here]
        if not len(other):
            continue
        linked = other[within_ring(np.full(len(other), members[position]), nodes[other], start)]
        for k in linked.tolist():
            there = top(k)
            here = top(here)
            if here != there:
                edges.append((int(nodes[node].astype(np.int64)), int(nodes[k].astype(np.int64))))
                low, high = min(here, there), max(here, there)
                root[high] = low
        if len(linked):
            root[outside] = root[root[outside]]
    return edges


def links(nodes: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all that are linked."""
    large = crowded(nodes)
    # few rows or none: whether they are sent to every task is left to their measured size
    joined = entries(nodes).join(large, "key", "left")
    mine = F.coalesce(F.when(F.col("asks"), F.col("a")).otherwise(F.col("m")), F.lit(1))
    others = F.coalesce(F.when(F.col("asks"), F.col("m")).otherwise(F.col("a")), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), mine).cast("int")
    dealt = joined.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1))).select(
        "key",
        F.when(F.col("asks"), F.col("other")).otherwise(own).alias("part"),
        F.when(F.col("asks"), own).otherwise(F.col("other")).alias("asker_part"),
        "fp",
        "asks",
    )

    def run(frames):
        held: pd.DataFrame | None = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame])
            cell = frame[["key", "part", "asker_part"]].to_numpy()
            edge = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            last = int(edge[-1]) if len(edge) else 0
            held = frame.iloc[last:]
            if last:
                yield table(frame.iloc[:last], np.append(0, edge))
        if held is not None and len(held):
            yield table(held, np.array([0, len(held)]))

    def table(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        key, fp, asks = frame["key"].to_numpy(), frame["fp"].to_numpy().view(np.uint64), frame["asks"].to_numpy()
        edges = []
        wide = np.flatnonzero(np.diff(bounds) > 2)
        for a, b in zip(bounds[wide].tolist(), bounds[wide + 1].tolist()):
            side = asks[a:b]
            if not side.all():
                edges += forest(fp[a:b][~side], fp[a:b][side], int(key[a]) >> 32)
        return pd.DataFrame(np.array(edges, np.int64).reshape(-1, 2), columns=["u", "v"])

    cells = dealt.repartition("key", "part", "asker_part").sortWithinPartitions("key", "part", "asker_part", "asks", "fp")
    return cells.mapInPandas(run, "u long, v long")


def components(marked: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``marked`` (doc_id, fp), a written table."""
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected(links(first.select("fp")))
    # fingerprints without an edge are their own component
    linked = first.join(roots, first.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return linked.join(least, "root").select("fp", "root", "component_id")


def fingerprint_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of (doc_id, text); component_id is the smallest doc_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = written(with_fingerprint(docs, ["doc_id"]), "fingerprints")
    return marked.join(components(marked).select("fp", "component_id"), "fp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns, as told in ``best_of_each``."""
    rows = keyed_rows(docs).withColumn("text", F.col("text").cast("string"))
    marked = written(with_fingerprint(rows, ["doc_id", "one", "two"]), "fingerprints")
    return best_of_each(docs, marked.join(components(marked).select("fp", "root"), "fp").select("root", place().alias("place")))


def op7_simhash(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint and its component of links at 4 or fewer bits."""
    return fingerprint_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
