"""Byte-level BPE encoding and decoding with a public vocabulary.

Each distinct piece of text keeps a segment tree over the ranks of its adjacent pairs. The root is the
leftmost pair of lowest rank; a merge changes three leaves, and only the nodes above them are renewed,
until the root holds no mergeable pair. ``merge_short`` runs the trees of many pieces side by side as
rows of one array; ``merge_long`` is the same tree for one long piece.

Pieces are found on arrays too: every character has a class (letter, number, space, other) and a piece
starts where the classes change, as the pattern of the vocabulary asks for. Only distinct pieces of a
chunk are merged. Special tokens in a text stay whole.

A null text is an empty one and has no ids. Nothing depends on other rows, so ties, repeated rows and
empty tables need no rule.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, offsets_of, ranges, text_chunks

SPACE, LETTER, NUMBER, OTHER = range(4)
NONE = np.int32(2**31 - 1)
WIDEST = 32  # pairs in a piece that is merged side by side with others
POSITION_BITS = 6


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point."""
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    every = "".join(map(chr, points))
    classes = np.full(len(points), OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, every):
            classes[found.start() : found.end()] = kind
    table = np.full(0x110000, OTHER, np.uint8)
    table[points] = classes
    return table


def printable_bytes() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: those that are printable as
    themselves, the others as the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBPE:
    """One vocabulary file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        vocab, byte_of = whole["model"]["vocab"], printable_bytes()
        self.special = {x["content"].encode(): x["id"] for x in whole["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        words = [b""] * self.size
        for word, number in vocab.items():
            words[number] = bytes(byte_of[c] for c in word)
        for word, number in self.special.items():
            words[number] = word
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        self.word_length = np.array([len(w) for w in words], np.int64)
        self.word_start = offsets_of(self.word_length)[:-1]
        self.of_byte = np.zeros(256, np.int32)
        for char, byte in byte_of.items():
            self.of_byte[byte] = vocab[char]
        merges = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.ranks = {(int(a), int(b)): k for k, (a, b) in reversed(list(enumerate(zip(left, right))))}
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.pair_key, self.pair_rank = keys[order], order.astype(np.int32)
        self.byte_rank = self.rank(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE if it can't be merged."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_key, keys), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == keys, self.pair_rank[at], NONE)

    # -- pieces

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where a piece starts in the UTF-8 bytes of texts that lie one after the other."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        place = None if n == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
        index = (lambda b: b) if place is None else (lambda b: np.searchsorted(place, b))
        forced = np.zeros(n + 1, bool)
        forced[index(offsets)] = True
        forced[n] = True
        held = []
        for word in self.special:
            at = raw.find(word)
            while at >= 0:
                end = at + len(word)
                # a special token never reaches over the end of its text
                if offsets[np.searchsorted(offsets, at, side="right")] >= end:
                    held.append((int(index(np.int64(at))), int(index(np.int64(end)))))
                    forced[list(held[-1])] = True
                at = raw.find(word, end)
        classes = character_classes()[points]
        space = classes == SPACE
        change = np.ones(n, bool)
        change[1:] = classes[1:] != classes[:-1]
        start = change | forced[:n]
        # the last space before something else goes with it if it is a plain one, or stands alone
        last = space.copy()
        last[:-1] &= ~space[1:]
        last &= ~forced[1:]
        start |= last
        joined = np.zeros(n, bool)
        joined[1:] = last[:-1] & (points[:-1] == 0x20)
        start &= ~joined
        for at in np.flatnonzero((points == 0x27) & start):
            end = at + self._contraction(points, forced, at)
            if end > at:
                start[at + 1 : end] = False
                if end < n:
                    start[end] = True
        for a, b in held:
            start[a + 1 : b] = False
        found = np.flatnonzero(start)
        return found if place is None else place[found]

    @staticmethod
    def _contraction(points: np.ndarray, forced: np.ndarray, at: int) -> int:
        """The length of an English contraction that starts here, 0 if there is none."""
        if forced[at + 1]:
            return 0
        if chr(points[at + 1]) in "stmd":
            return 2
        if not forced[at + 2] and chr(points[at + 1]) + chr(points[at + 2]) in ("re", "ve", "ll"):
            return 3
        return 0

    # -- merging

    def merge_long(self, piece: bytes) -> list[int]:
        """One piece by its own segment tree."""
        symbols = [int(self.of_byte[b]) for b in piece]
        count = len(symbols)
        width = 1 << max(0, (count - 2).bit_length())
        nothing = (1 << 62, 0)
        ranks = self.ranks
        tree = [nothing] * (2 * width)
        for k in range(count - 1):
            r = ranks.get((symbols[k], symbols[k + 1]))
            if r is not None:
                tree[width + k] = (r, k)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]

        def put(leaf: int, value):
            node = leaf + width
            tree[node] = value
            node >>= 1
            while node:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
                node >>= 1

        while tree[1] is not nothing and tree[1][0] < nothing[0]:
            rank, at = tree[1]
            gone = after[at]
            follow = after[gone]
            symbols[at], symbols[gone] = int(self.made[rank]), -1
            after[at] = follow
            if gone < count - 1 or follow >= 0:
                put(gone, nothing)
            r = None
            if follow >= 0:
                before[follow] = at
                r = ranks.get((symbols[at], symbols[follow]))
            put(at, nothing if r is None else (r, at))
            lead = before[at]
            if lead >= 0:
                r = ranks.get((symbols[lead], symbols[at]))
                put(lead, nothing if r is None else (r, lead))
        return [s for s in symbols if s >= 0]

    def merge_short(self, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Pieces as rows of bytes, all trees at once. Returns rows of ids, -1 where there is none."""
        rows, columns = raw.shape
        symbols = np.where(np.arange(columns)[None, :] < lengths[:, None], self.of_byte[raw], -1)
        width = 1 << max(0, (columns - 2).bit_length())
        levels = width.bit_length() - 1
        tree = np.full((rows, 2 * width), NONE, np.int32)
        pair = np.arange(columns - 1)
        ranks = self.byte_rank[(raw[:, :-1].astype(np.int32) << 8) | raw[:, 1:]]
        hit = (ranks < NONE) & (pair[None, :] < (lengths - 1)[:, None])
        tree[:, width : width + columns - 1][hit] = ((ranks << POSITION_BITS) | pair[None, :].astype(np.int32))[hit]
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        after = np.broadcast_to(np.arange(1, columns + 1, dtype=np.int32), symbols.shape).copy()
        after[np.arange(rows), lengths - 1] = -1
        before = np.broadcast_to(np.arange(-1, columns - 1, dtype=np.int32), symbols.shape).copy()
        flat, sym, aft, bef = tree.ravel(), symbols.ravel(), after.ravel(), before.ravel()

        def put(row, leaf, value):
            base = row * (2 * width)
            node = leaf + width
            flat[base + node] = value
            for _ in range(levels):
                node = node >> 1
                two = base + 2 * node
                flat[base + node] = np.minimum(flat[two], flat[two + 1])

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            root = flat[row * (2 * width) + 1]
            at = (root & ((1 << POSITION_BITS) - 1)).astype(np.int64)
            new = self.made[root >> POSITION_BITS]
            base = row * columns
            gone = aft[base + at].astype(np.int64)
            follow = aft[base + gone].astype(np.int64)
            sym[base + at], sym[base + gone] = new, -1
            aft[base + at] = follow
            inner = gone < columns - 1
            put(row[inner], gone[inner], NONE)
            value = np.full(len(row), NONE, np.int32)
            some = np.flatnonzero(follow >= 0)
            bef[base[some] + follow[some]] = at[some]
            r = self.rank(new[some], sym[base[some] + follow[some]])
            value[some] = np.where(r < NONE, (r << POSITION_BITS) | at[some].astype(np.int32), NONE)
            put(row, at, value)
            lead = bef[base + at].astype(np.int64)
            some = np.flatnonzero(lead >= 0)
            r = self.rank(sym[base[some] + lead[some]], new[some])
            value = np.where(r < NONE, (r << POSITION_BITS) | lead[some].astype(np.int32), NONE).astype(np.int32)
            put(row[some], lead[some], value)
            row = row[flat[row * (2 * width) + 1] < NONE]
        return symbols

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has."""
        counts = np.ones(len(lengths), np.int64)
        whole = {}
        for word, number in self.special.items():
            for k in np.flatnonzero(lengths == len(word)):
                if data[starts[k] : starts[k] + len(word)].tobytes() == word:
                    whole[int(k)] = number
        parts = [(np.array(list(whole), np.int64), np.array(list(whole.values()), np.int32))]
        open_ = np.where(np.isin(np.arange(len(lengths)), parts[0][0]), 0, lengths)
        single = np.flatnonzero(open_ == 1)
        parts.append((single, self.of_byte[data[starts[single]]]))
        low, high = 1, 2
        while low <= WIDEST:
            which = np.flatnonzero((open_ > low) & (open_ <= high))
            if len(which):
                column = np.minimum(np.arange(high)[None, :], lengths[which][:, None] - 1)
                symbols = self.merge_short(data[starts[which][:, None] + column], lengths[which])
                left = symbols >= 0
                counts[which] = left.sum(axis=1)
                parts.append((which, symbols[left]))
            low, high = high, 2 * high - 1 if high > 2 else 3
        for k in np.flatnonzero(open_ > low):
            made = self.merge_long(data[starts[k] : starts[k] + lengths[k]].tobytes())
            counts[k] = len(made)
            parts.append((np.array([k]), np.array(made, np.int32)))
        where = offsets_of(counts)
        ids = np.empty(int(where[-1]), np.int32)
        for which, made in parts:
            ids[ranges(where[which], counts[which])] = made
        return ids, counts

    # -- whole texts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of each text in them."""
        starts = self.pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy()
        where = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        ids, counts = self.merge(np.frombuffer(words.buffers()[2], np.uint8), where[:-1], np.diff(where))
        lengths = counts[code]
        out = ids[ranges(offsets_of(counts)[:-1][code], lengths)]
        return out, offsets_of(lengths)[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts, and the offsets of each text in them. What is no UTF-8 becomes U+FFFD."""
        lengths = self.word_length[ids]
        data = self.blob[ranges(self.word_start[ids], lengths)]
        where = offsets_of(lengths)[offsets]
        try:
            data.tobytes().decode("utf-8")
            return data, where
        except UnicodeDecodeError:
            texts = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(where[:-1], where[1:])]
            return np.frombuffer(b"".join(texts), np.uint8), offsets_of(np.array([len(t) for t in texts], np.int64))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode(docs: DataFrame, vocab: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``, an array of ids."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe, parts, counts = vocabulary(vocab), [], []
        for _, _, data, offsets in text_chunks(batch.column(batch.schema.get_field_index(text))):
            ids, where = bpe.encode(data, offsets)
            parts.append(ids)
            counts.append(np.diff(where))
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return [pa.array(n), pa.ListArray.from_arrays(pa.array(offsets_of(n).astype(np.int32)), pa.array(ids))]

    return add_columns(docs, [("n_tokens", T.LongType()), ("ids", T.ArrayType(T.IntegerType()))], make, keep)


def decode(coded: DataFrame, vocab: str, keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``, the text of its ids. A null array has the empty text."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe, column = vocabulary(vocab), batch.column(batch.schema.get_field_index(ids))
        lengths = np.array(column.value_lengths().fill_null(0), np.int64)
        data, where = bpe.decode(np.array(column.flatten(), np.int64), offsets_of(lengths))
        texts = pa.Array.from_buffers(
            pa.string(), len(lengths), [None, pa.py_buffer(where.astype(np.int32)), pa.py_buffer(data)]
        )
        return [texts]

    return add_columns(coded, [("decoded", T.StringType())], make, keep)


def round_trip(docs: DataFrame, vocab: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` encoded and decoded, as digests: ``n_tokens``, ``ids_sha256`` (ids as little-endian
    unsigned 32-bit integers) and ``decoded_sha256``. Ids never leave the task."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe, counts, of_ids, of_text = vocabulary(vocab), [], [], []
        for _, _, data, offsets in text_chunks(batch.column(batch.schema.get_field_index(text))):
            ids, where = bpe.encode(data, offsets)
            back, place = bpe.decode(ids, where)
            counts.append(np.diff(where))
            packed = memoryview(ids.astype("<u4")).cast("B")
            plain = memoryview(np.ascontiguousarray(back)).cast("B")
            of_ids += [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(where[:-1], where[1:])]
            of_text += [hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(place[:-1], place[1:])]
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return [pa.array(n), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return add_columns(docs, fields, make, keep)


def op9_bpe(docs: DataFrame, vocab: str) -> DataFrame:
    """One row per document: the digests of its ids and of the text they decode to."""
    return round_trip(docs.select("doc_id", F.col("text").cast("string").alias("text")), vocab, ["doc_id"])
