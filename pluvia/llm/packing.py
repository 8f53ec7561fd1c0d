"""Token ids packed into rows of one length, by best fit decreasing.

Texts are encoded, and texts longer than a row are split into pieces without loss. Pieces are dealt by a
hash of (doc_id, piece, ids) into blocks of about ``BLOCK_TOKENS`` ids, however large the table is. Inside a
block the longest piece comes first and goes into the fullest row that still has room: a segment tree
over the free places 0..length, whose nodes hold whether any row has such a free place, finds the
smallest sufficient one in logarithmic time.

Each row of the result is one row of the id matrix: ``ids`` (little-endian, 2 bytes an id if the
vocabulary allows, else 4; filled up with ``pad``), ``segment_ends`` (cumulative lengths, from 0) and
``positions`` (where positions go back to 0, as the matrix row of position ids can be told from it).
``unpack`` restores the ids of every document, which tests use as the exact round trip.

A null or empty text has no ids and takes no part in any row; it comes back as a row of its own with
``row_no`` null, so that no document is lost. Equal lengths go by doc_id (null first), then piece, then
text; rows that are equal in all of them are interchangeable. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.bpe import vocabulary
from pluvia.llm.columnar import text_chunks

LENGTH = 2048
BLOCK_TOKENS = 4 << 20
TOKENS_PER_BYTE = 0.45  # only sizes blocks

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
PACKED = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("pieces", T.ArrayType(T.IntegerType())),
        T.StructField("segment_ends", T.ArrayType(T.IntegerType())),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.BinaryType()),
    ]
)


class FreePlaces:
    """Rows by free places, under a segment tree that finds the smallest sufficient number."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.rows = defaultdict(list)
        self.some = bytearray(2 * self.width)

    def _mark(self, free: int) -> None:
        node = free + self.width
        self.some[node] = bool(self.rows[free])
        node >>= 1
        while node:
            self.some[node] = self.some[2 * node] | self.some[2 * node + 1]
            node >>= 1

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        if len(self.rows[free]) == 1:
            self._mark(free)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free places, row) of the fullest row with room for ``need``; the row is taken out."""
        node, some = need + self.width, self.some
        if not some[node]:
            while node > 1 and (node & 1 or not some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if some[2 * node] else 2 * node + 1
        free = node - self.width
        row = self.rows[free].pop()
        if not self.rows[free]:
            self._mark(free)
        return free, row


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of indexes; ``sizes`` is in decreasing order and none is above ``length``."""
    rows, places = [], FreePlaces(length)
    for k, size in enumerate(sizes):
        free, row = places.take(size) or (length, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(k)
        if free > size:
            places.add(free - size, row)
    return rows


def pieces(docs: DataFrame, vocab: str, length: int) -> DataFrame:
    """One row per piece of a document; a document without ids has one empty piece."""

    def cut(batches):
        kind = "<u2" if vocabulary(vocab).size <= 1 << 16 else "<u4"
        for batch in batches:
            doc_ids = batch.column(0)
            for first, _, data, offsets in text_chunks(batch.column(1)):
                ids, where = vocabulary(vocab).encode(data, offsets)
                packed, sizes = ids.astype(kind).tobytes(), np.diff(where)
                count = np.maximum(1, -(-sizes // length))
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                size = np.minimum(length, sizes[row] - piece * length).astype(np.int32)
                bounds = np.append(where[row] + piece * length, len(ids)).astype(np.int32) * int(kind[2])
                column = pa.Array.from_buffers(
                    pa.binary(), len(row), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(packed)]
                )
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(row + first)), pa.array(piece.astype(np.int32)), pa.array(size), column],
                    names=PIECE.names,
                )

    return docs.mapInArrow(cut, PIECE)


def pack(docs: DataFrame, vocab: str, length: int = LENGTH, pad: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` (doc_id, text) as rows of the packed matrix; see the module."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(held * TOKENS_PER_BYTE / block_tokens))
    block = F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(blocks)).cast("int")
    dealt = (
        pieces(docs, vocab, length)
        .withColumn("block", block)
        .repartition(blocks, "block")
        .sortWithinPartitions("block", F.desc("size"), "doc_id", "piece", "ids")
    )

    def fill(batches):
        kind = np.dtype("<u2" if vocabulary(vocab).size <= 1 << 16 else "<u4")
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                here = np.asarray(batch.column(4))
                if held and held[0].column(4)[0].as_py() != here[0]:
                    yield from matrix(held, kind)
                    held = []
                end = int(np.searchsorted(here, here[0], side="right"))
                held.append(batch.slice(0, end))
                batch = batch.slice(end)
        if held:
            yield from matrix(held, kind)

    def matrix(held, kind):
        table = pa.Table.from_batches(held)
        number = held[0].column(4)[0].as_py()
        doc_ids, piece, size = table.column(0).to_pylist(), table.column(1).to_pylist(), table.column(2).to_pylist()
        ids = table.column(3)
        full = size.index(0) if size[-1] == 0 else len(size)
        out = []
        for row_no, members in enumerate(best_fit_decreasing(size[:full], length)):
            lengths = [size[k] for k in members]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            line = np.full(length, pad, kind)
            line[: ends[-1]] = np.frombuffer(b"".join(ids[k].as_py() for k in members), kind)
            out.append(
                {
                    "block": number,
                    "row_no": row_no,
                    "n_tokens": int(ends[-1]),
                    "doc_ids": [doc_ids[k] for k in members],
                    "pieces": [piece[k] for k in members],
                    "segment_ends": ends.tolist(),
                    # the end of the last segment too if padding follows: its positions start anew
                    "positions": ends[:-1].tolist() + ([int(ends[-1])] if ends[-1] < length else []),
                    "ids": line.tobytes(),
                }
            )
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        for k in range(full, len(size)):
            out.append({"block": number, "n_tokens": 0, "doc_ids": [doc_ids[k]], "pieces": [piece[k]]})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("block", pa.int32()),
            ("row_no", pa.int32()),
            ("n_tokens", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())),
            ("pieces", pa.list_(pa.int32())),
            ("segment_ends", pa.list_(pa.int32())),
            ("positions", pa.list_(pa.int32())),
            ("ids", pa.binary()),
        ]
    )
    return dealt.mapInArrow(fill, PACKED)


def position_ids(positions: list[int], length: int = LENGTH) -> np.ndarray:
    """The row of position ids that belongs to a packed row."""
    starts = np.zeros(length, np.int64)
    starts[positions] = positions
    return np.arange(length) - np.maximum.accumulate(starts)


def unpack(packed: DataFrame, id_bytes: int = 2) -> DataFrame:
    """(doc_id, ids) of every document, put together again from its pieces."""
    piece = F.explode(F.arrays_zip("doc_ids", "pieces", F.sequence(F.lit(0), F.size("doc_ids") - 1).alias("k"))).alias("p")
    begin = F.coalesce(F.try_element_at("segment_ends", F.col("p.k") + 1), F.lit(0))
    end = F.coalesce(F.try_element_at("segment_ends", F.col("p.k") + 2), F.lit(0))
    cut = F.expr("substring(ids, begin * {0} + 1, (end - begin) * {0})".format(id_bytes))
    return (
        packed.select(piece, "segment_ends", "ids")
        .select(F.col("p.doc_ids").alias("doc_id"), F.col("p.pieces").alias("piece"), begin.alias("begin"), end.alias("end"), "ids")
        .select("doc_id", "piece", F.coalesce(cut, F.lit(b"")).alias("ids"))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
        .select("doc_id", F.expr("reduce(parts, X'', (a, x) -> a || x.ids)").alias("ids"))
    )


def write_packed(packed: DataFrame, path: str) -> None:
    """The matrix as Parquet, a folder per run; readers map ``ids`` onto an array without parsing."""
    packed.write.mode("overwrite").parquet(path)


def op1_packing(docs: DataFrame, vocab: str) -> DataFrame:
    """The whole packed matrix of a table of documents, 2048 ids a row."""
    return pack(docs, vocab)
