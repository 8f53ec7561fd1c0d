"""Which tokens of two tokenizers meet: alignment by shared byte offsets, and how often ids are linked.

Each text, with a space before it, is encoded by a byte-level BPE vocabulary (A) and a piece vocabulary with byte
fallback (B). Offsets where tokens of both end cut the text into groups; a token of A and one of B are linked if
they are in one group. ``corpus_counts`` tells for every pair of ids how many documents hold it linked.

The work is done on Arrow tables. Lists of ids are flattened next to the index of their document, the byte lengths
of tokens are summed up within it, and a hash join on document and end gives the shared offsets. Pairs of ids come
from a hash join on groups, as distinct ids of a group with their multiplicity, so a long run without a shared offset
needs no row per link. Counts of a batch are a ``group_by``; Spark merges them over all batches.

Encoded texts are written once, in blocks of some 9 MB of text. The counts go back to the blocks that asked for them, a
row per block and pair, not per document and pair, so no table is broadcast and a frequent pair is as many rows as
there are blocks. No step holds more than a block, or one longer text.

A text that is null, empty, or whose tokens of A or B spell other bytes than it has no tokens: zeros, and an empty
text of groups. Repeated rows are documents of their own. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.bpe import ByteBPE
from pluvia.llm.columnar import offsets_of, ranges, text_chunks
from pluvia.session import new_folder

CHUNKS_PER_BLOCK = 3
SLICE_TOKENS = 1 << 17
SLICE_PAIRS = 1 << 18
CROWDED = 1 << 8
CROWDED_ROWS = 1 << 8  # each meets the distinct ids of one group, some 30,000 at most
SPACE = 0x20
PAIRS = "block long, a int, b int, documents long"
DIGITS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class PlainBPE(ByteBPE):
    """The byte-level vocabulary without special tokens: their strings are text like any other."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special = {}


class PieceBPE:
    """The piece vocabulary. No piece has a space behind another character, so runs of spaces with what follows up to the
    next space are encoded by themselves, each distinct one once."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        whole = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blob = np.frombuffer(b"".join(whole), np.uint8)
        self.word_length = np.array([len(w) for w in whole], np.int64)
        self.word_start = offsets_of(self.word_length)[:-1]
        self.alone = self.model.piece_to_id("▁")

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that each start with a space, and the offsets of each text in them."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        start = data == SPACE
        start[1:] &= data[:-1] != SPACE
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(start)
        bounds = np.append(starts, len(data)).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        # the model adds the first space itself, but makes nothing of a text that is nothing else
        units = pc.utf8_slice_codeunits(coded.dictionary.cast(pa.string()), 1).to_pylist()
        made = self.model.encode(units, num_threads=1)
        if "" in units:
            made[units.index("")] = [self.alone]
        counts = np.fromiter(map(len, made), np.int64, len(made))
        ids = np.fromiter(chain.from_iterable(made), np.int32, int(counts.sum()))
        code = coded.indices.to_numpy()
        out = ids[ranges(offsets_of(counts)[:-1][code], counts[code])]
        return out, offsets_of(counts[code])[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def vocabularies(a: str, b: str) -> tuple[PlainBPE, PieceBPE]:
    return PlainBPE(a), PieceBPE(b)


def _widths(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of every id, which is all that a task needs of vocabularies once texts are encoded."""
    return tuple(v.word_length.astype(np.int32) for v in vocabularies(a, b))


def _spelled(vocabulary: ByteBPE | PieceBPE, ids: np.ndarray) -> np.ndarray:
    return vocabulary.blob[ranges(vocabulary.word_start[ids], vocabulary.word_length[ids])]


def _same(data, offsets, vocabulary, ids, where) -> np.ndarray:
    """Which texts their tokens spell exactly."""
    spelled, ends = _spelled(vocabulary, ids), offsets_of(vocabulary.word_length[ids])[where]
    if len(spelled) == len(data) and np.array_equal(spelled, data):
        return np.ones(len(offsets) - 1, bool)
    same = np.diff(ends) == np.diff(offsets)
    for k in np.flatnonzero(same):
        same[k] = np.array_equal(spelled[ends[k] : ends[k + 1]], data[offsets[k] : offsets[k + 1]])
    return same


def _packed(ids: np.ndarray, where: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The ids of each text as little-endian unsigned 16-bit integers, compressed; nothing where it is not kept."""
    press, body = zstandard.ZstdCompressor(level=1), memoryview(ids.astype("<u2")).cast("B")
    each = zip(where[:-1], where[1:], kept)
    return pa.array([press.compress(body[2 * x : 2 * y]) if keep and y > x else b"" for x, y, keep in each], pa.binary())


def _unpacked(packed: pa.Array | pa.ChunkedArray) -> pa.ListArray:
    open_ = zstandard.ZstdDecompressor()
    parts = [open_.decompress(body) if body else b"" for body in packed.to_pylist()]
    ids = np.frombuffer(b"".join(parts), "<u2").astype(np.int32)
    offsets = offsets_of(np.array([len(p) // 2 for p in parts], np.int64)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def encode_both(docs: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """(row, block, a, b): the ids of each text in both vocabularies, packed; ``row`` holds the other columns."""
    carried = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a, of_b = vocabularies(a, b)
        task, chunk = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                lengths = np.diff(offsets)
                data = np.insert(data, offsets[:-1][lengths > 0], SPACE)
                offsets = offsets_of(lengths + (lengths > 0))
                ids_a, where_a = of_a.encode(data, offsets)
                ids_b, where_b = of_b.encode(data, offsets)
                kept = _same(data, offsets, of_a, ids_a, where_a) & _same(data, offsets, of_b, ids_b, where_b)
                blocks = pa.array(np.full(end - first, task | chunk // CHUNKS_PER_BLOCK, np.int64))
                columns = [batch.column(0).slice(first, end - first), blocks, _packed(ids_a, where_a, kept), _packed(ids_b, where_b, kept)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "block", "a", "b"])
                chunk += 1

    rows = docs.select(carried, F.col(f"`{text}`").cast("string").alias("text"))
    ids = [T.StructField(side, T.BinaryType()) for side in "ab"]
    schema = T.StructType([rows.schema["row"], T.StructField("block", T.LongType()), *ids])
    return rows.mapInArrow(run, schema)


def _ends(lists: pa.Array, width: np.ndarray) -> pa.Table:
    """The tokens of all lists: document, id, and a key of the document and the offset in its text where it ends."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    total = pc.cumulative_sum(pa.array(width[ids.to_numpy()].astype(np.int64))).to_numpy()
    before = np.concatenate([[0], total])[lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()]
    return pa.table({"doc": doc, "id": ids, "key": (doc << 40) | (total - before[doc])})


def _grouped(a: pa.Array, b: pa.Array, widths: tuple[np.ndarray, np.ndarray]) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Tokens of both sides with their ``group``, numbered through all documents, and the groups of each document."""
    left, right = _ends(a, widths[0]), _ends(b, widths[1])
    shared = left.select(["key"]).join(right.select(["key"]), keys="key", join_type="inner", use_threads=False)
    cuts = np.sort(shared["key"].to_numpy())
    both = [t.append_column("group", pa.array(np.searchsorted(cuts, t["key"].to_numpy()))) for t in (left, right)]
    return both[0], both[1], np.bincount(cuts >> 40, minlength=len(a))


def _linked(left: pa.Table, right: pa.Table) -> Iterator[pa.Table]:
    """(doc, a, b, links) of linked pairs of ids, in tables of bounded size; a pair may come again.

    A group of many links is reduced to its distinct ids, with their multiplicity, before they are paired.
    """
    if not left.num_rows:
        return
    group_a, group_b = left["group"].to_numpy(), right["group"].to_numpy()
    groups = int(group_a[-1]) + 1
    size_b = np.bincount(group_b, minlength=groups)
    crowded = np.bincount(group_a, minlength=groups) * size_b > CROWDED
    first_b, ids_b = offsets_of(size_b)[:-1], right["id"].to_numpy()
    each = np.where(crowded[group_a], 0, size_b[group_a])
    made, ids_a, doc = offsets_of(each), left["id"].to_numpy(), left["doc"].to_numpy()
    first = 0
    while first < len(each):
        end = max(int(np.searchsorted(made, made[first] + SLICE_PAIRS, side="right")) - 1, first + 1)
        times, part = each[first:end], slice(first, end)
        b = ids_b[ranges(first_b[group_a[part]], times)]
        yield pa.table({"doc": np.repeat(doc[part], times), "a": np.repeat(ids_a[part], times), "b": b, "links": np.ones(len(b), np.int64)})
        first = end
    if not crowded.any():
        return
    sides = []
    for table, group, name in ((left, group_a, "a"), (right, group_b, "b")):
        held = table.filter(pa.array(crowded[group])).group_by(["doc", "group", "id"], use_threads=False)
        sides.append(held.aggregate([([], "count_all")]).rename_columns(["doc", "group", name, f"n_{name}"]))
    many = sides[1].drop_columns(["doc"])
    for one in range(0, sides[0].num_rows, CROWDED_ROWS):
        pairs = sides[0].slice(one, CROWDED_ROWS).join(many, keys="group", join_type="inner", use_threads=False)
        yield pa.table({"doc": pairs["doc"], "a": pairs["a"], "b": pairs["b"], "links": pc.multiply(pairs["n_a"], pairs["n_b"])})


def _slices(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with bounded numbers of tokens."""
    tokens = lists.offsets.to_numpy().astype(np.int64)
    first = 0
    while first < len(lists):
        end = int(np.searchsorted(tokens, tokens[first] + SLICE_TOKENS, side="right")) - 1
        end = min(max(end, first + 1), len(lists))
        yield first, end
        first = end


def pair_counts(coded: DataFrame, a: str, b: str) -> DataFrame:
    """(block, a, b, documents): partial counts of documents that hold a pair linked."""
    widths = _widths(a, b)

    def counted(lists: list[pa.Array]) -> pa.Table:
        left, right, _ = _grouped(*lists, widths)
        held = [p.group_by(["doc", "a", "b"], use_threads=False).aggregate([]) for p in _linked(left, right)]
        once = pa.concat_tables(held or [pa.table({n: pa.array([], k) for n, k in (("doc", pa.int64()), ("a", pa.int32()), ("b", pa.int32()))})])
        if len(held) > 1:
            once = once.group_by(["doc", "a", "b"], use_threads=False).aggregate([])
        return once.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "documents"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
            lists = [_unpacked(batch.column(side)) for side in "ab"]
            for first, stop in zip(cuts, [*cuts[1:], len(blocks)]):
                own = [side.slice(first, stop - first) for side in lists]
                parts = [counted([side.slice(x, y - x) for side in own]) for x, y in _slices(own[0])]
                whole = pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("documents", "sum")])
                block = pa.array(np.full(whole.num_rows, blocks[first], np.int64))
                arrays = [block, *(whole[c].combine_chunks() for c in ("a", "b", "documents_sum"))]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "a", "b", "documents"])

    return coded.select("block", "a", "b").mapInArrow(run, PAIRS)


def corpus_counts(partial: DataFrame) -> DataFrame:
    """(a, b, documents, best) over all blocks; ``best`` if no other id of B is linked with this one of A in more
    documents. One id of A has as many rows at most as B has ids."""
    counts = partial.groupBy("a", "b").agg(F.sum("documents").alias("documents"))
    return counts.withColumn("best", (F.col("documents") == F.max("documents").over(Window.partitionBy("a"))).cast("long"))


def _text_of_groups(left: pa.Table, right: pa.Table, docs: int) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of all documents, each closed by ``;``, and the offsets of the documents."""
    group_a, group_b = left["group"].to_numpy(), right["group"].to_numpy()
    at_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a)
    at_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, side="right")
    size = len(group_a) + len(group_b)
    ids, mark, doc = np.empty(size, np.int64), np.full(size, ord(","), np.uint8), np.empty(size, np.int64)
    for at, table in ((at_a, left), (at_b, right)):
        ids[at], doc[at] = table["id"].to_numpy(), table["doc"].to_numpy()
    for at, group, sign in ((at_a, group_a, "|"), (at_b, group_b, ";")):
        mark[at[np.append(group[1:] != group[:-1], True)] if len(at) else at] = ord(sign)
    digits, length = _decimals()
    rows, lengths = digits[ids], length[ids]
    rows[np.arange(size), lengths] = mark
    ends = np.cumsum(lengths + 1)
    out = rows[np.arange(rows.shape[1])[None, :] <= lengths[:, None]]
    return out.tobytes(), np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(docs + 1))]


@lru_cache(maxsize=1)
def _decimals() -> tuple[np.ndarray, np.ndarray]:
    """The digits of numbers below 65,536, with room for one mark, and how many there are."""
    words = [b"%d" % n for n in range(1 << 16)]
    digits = np.array(words, "S6").view(np.uint8).reshape(len(words), 6)
    return digits, np.array([len(w) for w in words], np.int64)


def alignments(docs: DataFrame, a: str, b: str, text: str = "text", spelled: bool = False) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document.

    ``n_best`` counts the links whose pair is a best one of its id of A, ``count_sum`` adds the documents of the pair
    over all links. ``spelled`` adds ``groups`` itself.
    """
    spark = docs.sparkSession
    paths = [new_folder(spark, name) for name in ("align-ids", "align-pairs")]
    encode_both(docs, a, b, text).write.parquet(paths[0])
    coded = spark.read.parquet(paths[0])
    pair_counts(coded, a, b).write.parquet(paths[1])
    partial = spark.read.parquet(paths[1])
    asked = partial.select("block", "a", "b").distinct()
    told = asked.join(corpus_counts(partial), ["a", "b"]).select("block", F.col("a").alias("pa"), F.col("b").alias("pb"), "documents", "best")
    row_type, widths = coded.schema["row"].dataType, _widths(a, b)

    def tell(rows: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        known = told.select(["pa", "pb", "documents", "best"])
        lists = [_unpacked(rows[side]) for side in "ab"]
        for first, end in _slices(lists[0]):
            left, right, groups = _grouped(*[side.slice(first, end - first) for side in lists], widths)
            count = end - first
            sums = {name: np.zeros(count, np.int64) for name in ("n_links", "n_best", "count_sum")}
            for pairs in _linked(left, right):
                met = pairs.join(known, keys=["a", "b"], right_keys=["pa", "pb"], join_type="inner", use_threads=False)
                doc, links = met["doc"].to_numpy(), met["links"].to_numpy()
                for name, weight in (("n_links", None), ("n_best", met["best"]), ("count_sum", met["documents"])):
                    np.add.at(sums[name], doc, links if weight is None else links * weight.to_numpy())
            body, where = _text_of_groups(left, right, count)
            texts = [body[x : max(y - 1, x)] for x, y in zip(where[:-1], where[1:])]
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
            made = {"n_a": np.bincount(left["doc"].to_numpy(), minlength=count), "n_b": np.bincount(right["doc"].to_numpy(), minlength=count)}
            made |= {"n_groups": groups} | sums
            columns = {"row": rows["row"].slice(first, count)} | {n: pa.array(made[n].astype(np.int64)) for n in DIGITS}
            columns["groups_sha256"] = pa.array(digests, pa.string())
            if spelled:
                columns["groups"] = pa.array([t.decode() for t in texts], pa.string())
            out.append(pa.table(columns))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out) if out else pa.table(
            {"row": rows["row"].slice(0, 0)}
            | {n: pa.array([], pa.int64()) for n in DIGITS}
            | {n: pa.array([], pa.string()) for n in (["groups_sha256", "groups"] if spelled else ["groups_sha256"])}
        )

    schema = T.StructType([T.StructField("row", row_type), *[T.StructField(n, T.LongType()) for n in DIGITS]])
    for name in ["groups_sha256", "groups"] if spelled else ["groups_sha256"]:
        schema = schema.add(name, T.StringType())
    return coded.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(tell, schema)


def op11_align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per document: tokens of both vocabularies, groups, links, and what the corpus knows of these links."""
    made = alignments(docs.select("doc_id", "text"), a, b)
    return made.select("row.doc_id", *DIGITS, "groups_sha256")
