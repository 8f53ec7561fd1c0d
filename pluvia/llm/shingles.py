"""Near duplicates by the Jaccard similarity of word shingles: ``SIMILAR`` or more is a link.

Texts with one set of shingles are one node. Candidates share a band: ``ROWS`` minima of the set under
fixed hash functions, of ``BANDS`` bands. Two sets of similarity s share none with probability
(1 - s^4)^32: 5e-8 at 0.8, less above. Each node is first tied to the smallest node of each of its bands,
which is linear in the nodes; what that connects is a group. Inside a group the real sets of all pairs are
compared, unless already connected or out of reach by their marks, so no link stands on an estimate. Groups
above ``CELL`` nodes or ``CELL_BYTES`` of text are dealt into parts, and each pair of parts is a cell of bounded
size. Components of the links come from ``components.connected``.

What no band brings together is found by ``missed``, which has no chance in it. In one order of all shingles
the first size - ceil(SIMILAR * size) + 1 of a set are its lead, and linked sets have a shingle of their leads
in common. The order is by hash, but the ``HEAVY`` shingles that many texts have come last; which these are decides
on time alone. Nodes of different components that share a lead shingle are compared by their marks: a bit
for each residue of the hashes, set if an odd number of shingles has it. Two sets differ in as many shingles
as their marks differ in bits, or more, so marks too far apart tell that there is no link. First marks of
``MARK`` bits are compared, then those as long as the sets; the rest by their real sets, as above.

Every join on nodes has one row for each node: copies are brought together in partial aggregates first. Only
``near_duplicates``, which names the component of every row, joins the rows themselves.

Words are lower-cased in A-Z and cut at ASCII white space; fewer words than a shingle are one shingle. A null text is an empty one; texts without a word are one
node. Two sets with one 64-bit hash would be one node. Repeated rows stay rows of one node. Columns of any name are
carried along. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, nested, offsets_of, ranges, restored, text_chunks
from pluvia.llm.components import connected
from pluvia.session import new_folder

SEED, WORDS, SIMILAR = 42, 5, 0.8
BANDS, ROWS = 32, 4
CELL, CELL_BYTES = 4096, 16 << 20
HEAVY, HEAVY_OF_BATCH = 4096, 1024
MARK, CELL_MARK, LONGEST_MARK = 512, 1024, 1 << 15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_FACTORS = np.random.default_rng(42).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word shingle, one text after the other, number of shingles of each text)."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    low = _LOWER[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    # words one after the other, one space behind each
    length = ends - starts
    place = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[ranges(place, length)] = low[ranges(starts, length)]
    many = np.bincount(row, minlength=rows)
    begin = np.cumsum(many) - many
    count = np.where(many > 0, np.maximum(1, many - words + 1), 0)
    head = ranges(begin, count)
    owner = np.repeat(np.arange(rows), count)
    tail = np.minimum(head + words - 1, (begin + many - 1)[owner])
    text, one = joined.tobytes(), xxhash.xxh64_intdigest
    pairs = zip(place[head].tolist(), (place[tail] + length[tail]).tolist())
    hashes = np.fromiter((one(text[a:b], SEED) for a, b in pairs), np.uint64, len(head))
    return hashes, count


def sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, one text after the other, bounds of the texts in them)."""
    rows = len(offsets) - 1
    hashes, count = shingle_hashes(data, offsets, words)
    owner = np.repeat(np.arange(rows), count)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], offsets_of(np.bincount(owner[fresh], minlength=rows))


def bands(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of band keys for each set; that of an empty set means nothing."""
    out = np.zeros((len(bounds) - 1, BANDS), np.uint64)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        for k in range(BANDS):
            key = np.full(len(some), k, np.uint64)
            for factor in _FACTORS[k * ROWS : (k + 1) * ROWS]:
                key = (key ^ np.minimum.reduceat(hashes * factor, bounds[some])) * _MIX
                key ^= key >> np.uint64(32)
            out[some, k] = key
    return out


def lead(hashes: np.ndarray, bounds: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first shingles of each set, those of ``heavy`` after all others, their number). Two sets of similarity
    ``SIMILAR`` share one of them."""
    size = np.diff(bounds)
    count = np.where(size > 0, size - np.ceil(SIMILAR * size - 1e-9).astype(np.int64) + 1, 0)
    late = np.repeat(np.arange(len(size)) * 2, size) + np.isin(hashes, heavy)
    return hashes[np.argsort(late, kind="stable")][ranges(bounds[:-1], count)], count


def marks(hashes: np.ndarray, bounds: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The marks of the sets one after the other, as bytes; ``bits`` are powers of two from 8 to ``LONGEST_MARK``.
    Folded onto half its length by exclusive or, a mark is the shorter one of its set."""
    begin = offsets_of(bits)
    size = np.diff(bounds)
    residue = ((hashes * _MIX) >> np.uint64(64 - 15)).astype(np.int64)
    out = np.zeros(int(begin[-1]), np.uint8)
    np.bitwise_xor.at(out, np.repeat(begin[:-1], size) + (residue & np.repeat(bits - 1, size)), np.uint8(1))
    return np.packbits(out, bitorder="little")


def even_marks(hashes: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """One row of 64-bit words for each set."""
    return marks(hashes, bounds, np.full(len(bounds) - 1, bits)).view(np.uint64).reshape(-1, bits // 64)


def own_bits(size: np.ndarray) -> np.ndarray:
    """Bits of a mark as long as the set."""
    return np.minimum(1 << np.ceil(np.log2(np.maximum(size, 64))).astype(np.int64), LONGEST_MARK)


def reachable(differ: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of the sizes a and b may be linked if they differ in so many shingles or more."""
    return np.maximum(differ, np.abs(a - b)) * (1 + SIMILAR) <= (a + b) * (1 - SIMILAR + 1e-9)


def written(df: DataFrame, label: str) -> DataFrame:
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held, one, two): ``held`` has all other columns; the hashes ``one`` and ``two`` stand for the
    whole row, so only rows that are equal in every column share them."""
    whole = [F.col("doc_id"), F.col("text"), F.to_json("held")]
    return nested(docs, "doc_id", "text").select("*", F.xxhash64(*whole).alias("one"), F.xxhash64(F.lit(2), *whole).alias("two"))


def place() -> Column:
    """What the rows of a group are ordered by: doc_id, null last, then the hashes of the row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "one", "two")


def best_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """One row of ``docs`` for each root of ``rooted`` (place, root), the first by ``place``. Repeated rows are brought
    together before they are shuffled, and the texts are shuffled once."""
    best = rooted.groupBy("root").agg(F.min("place").alias("best")).select(F.col("best.one").alias("one"), F.col("best.two").alias("two"))
    kept = keyed_rows(docs).dropDuplicates(["one", "two"]).join(best, ["one", "two"], "left_semi")
    return restored(kept, docs, "doc_id", "text")


def heavy_shingles(docs: DataFrame) -> np.ndarray:
    """The ``HEAVY`` most frequent shingles, as far as the most frequent ones of each batch of rows tell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                values, times = np.unique(shingle_hashes(data, offsets, WORDS)[0], return_counts=True)
                top = np.argsort(-times, kind="stable")[:HEAVY_OF_BATCH]
                top = top[times[top] > 1]
                yield pa.RecordBatch.from_arrays([pa.array(values[top].view(np.int64)), pa.array(times[top])], names=["key", "times"])

    seen = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "key long, times long")
    most = seen.groupBy("key").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "key").limit(HEAVY)
    return np.array([row["key"] for row in most.collect()], np.int64).view(np.uint64)


#: What ``with_node`` adds.
SET = [
    ("node", T.LongType()),
    ("bands", T.ArrayType(T.LongType())),
    ("size", T.LongType()),
    ("lead", T.ArrayType(T.LongType())),
    ("mark", T.BinaryType()),
    ("marks", T.BinaryType()),
]


def with_node(docs: DataFrame, keep: list[str], heavy: np.ndarray) -> DataFrame:
    """``docs`` with the hash of the set of shingles, its band keys, none for an empty set, its size, its lead, its
    mark of ``MARK`` bits and the one as long as the set."""

    def listed(values: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
        where = pa.array(offsets_of(np.concatenate([np.zeros(0, np.int64), *sizes])).astype(np.int32))
        return pa.ListArray.from_arrays(where, pa.array(np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)))

    def binary(values: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
        where = offsets_of(np.concatenate([np.zeros(0, np.int64), *sizes])).astype(np.int32)
        body = np.concatenate([np.zeros(0, np.uint8), *values])
        return pa.Array.from_buffers(pa.binary(), len(where) - 1, [None, pa.py_buffer(where), pa.py_buffer(body)])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        nodes, keys, times, size, first, many, mark, own = [], [], [], [], [], [], [], []
        for _, _, data, offsets in text_chunks(batch.column(batch.schema.get_field_index("text"))):
            hashes, bounds = sets(data, offsets)
            nodes += [xxhash.xxh64_intdigest(hashes[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            size.append(np.diff(bounds))
            some = size[-1] > 0
            keys.append(bands(hashes, bounds)[some].ravel())
            times.append(np.where(some, BANDS, 0))
            for out, value in zip((first, many), lead(hashes, bounds, heavy)):
                out.append(value)
            mark.append(marks(hashes, bounds, np.full(len(some), MARK)))
            own.append(marks(hashes, bounds, own_bits(size[-1])))
        sizes = np.concatenate([np.zeros(0, np.int64), *size])
        return [
            pa.array(np.array(nodes, np.uint64).view(np.int64)),
            listed(keys, times),
            pa.array(sizes),
            listed(first, many),
            binary(mark, [np.full(len(sizes), MARK // 8)]),
            binary(own, [own_bits(sizes) // 8]),
        ]

    return add_columns(docs, SET, make, keep)


def nodes_of(marked: DataFrame) -> DataFrame:
    """One row for each node of ``marked``, with what ``with_node`` made and the place of its first row. Copies meet
    in partial aggregates, so what follows has no busy node."""
    same = [F.any_value(name).alias(name) for name, _ in SET[1:]]
    return marked.groupBy("node").agg(*same, F.min(place()).alias("place"))


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges (u, v) from each node to the smallest one of each of its bands."""
    entries = nodes.select("node", F.explode("bands").alias("key"))
    least = entries.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v < most")
    return entries.join(least, "key").where("node != v").select(F.col("node").alias("u"), "v").distinct()


def forest(
    hashes: np.ndarray, bounds: np.ndarray, root: np.ndarray, own: np.ndarray, others: np.ndarray
) -> list[tuple[int, int]]:
    """Edges between the two sides that connect what their links connect, fewer than there are sets. Sets of one
    ``root`` are connected already."""
    size, mark, edges = np.diff(bounds), even_marks(hashes, bounds, CELL_MARK), []
    label = np.unique(root, return_inverse=True)[1]
    for k in own.tolist():
        rest = others[label[others] != label[k]]
        rest = rest[reachable(np.zeros(len(rest)), size[rest], size[k])]
        rest = rest[reachable(np.bitwise_count(mark[rest] ^ mark[k]).sum(axis=1, dtype=np.int64), size[rest], size[k])]
        if not len(rest):
            continue
        mine = hashes[bounds[k] : bounds[k + 1]]
        theirs = hashes[ranges(bounds[rest], size[rest])]
        at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        shared = np.add.reduceat((mine[at] == theirs).astype(np.int64), offsets_of(size[rest])[:-1])
        for other in rest[shared / (size[k] + size[rest] - shared) >= SIMILAR].tolist():
            if label[other] != label[k]:
                edges.append((k, other))
                label[label == label[other]] = label[k]
    return edges


def _edges(node: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node[edges[:, 0]]), pa.array(node[edges[:, 1]])], names=["u", "v"])


def _cell(table: pa.Table) -> pa.RecordBatch:
    """The links of one cell."""
    parts = [sets(d, o) for chunk in table.column("text").chunks for _, _, d, o in text_chunks(chunk)]
    hashes = np.concatenate([p[0] for p in parts])
    bounds = offsets_of(np.concatenate([np.diff(p[1]) for p in parts]))
    mine, root = table.column("own").to_numpy(), table.column("root").to_numpy()
    own, others = np.flatnonzero(mine == table.column("low")[0].as_py()), np.flatnonzero(mine == table.column("high")[0].as_py())
    edges = np.array(forest(hashes, bounds, root, own, others), np.int64).reshape(-1, 2)
    return _edges(table.column("node").to_numpy(), edges)


def _starts(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each row, where the cells of rows in order begin)."""
    cell = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("group", "low", "high")], axis=1)
    return cell, np.append(0, np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of cells that come one after the other, each held by itself."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, starts = _starts(batch)
        cut = [*starts.tolist(), len(cell)]
        for a, b in zip(cut[:-1], cut[1:]):
            if held and tuple(cell[a]) != last:
                yield _cell(pa.Table.from_batches(held))
                held = []
            last = tuple(cell[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield _cell(pa.Table.from_batches(held))


def _pairs(table: pa.Table) -> pa.RecordBatch:
    """The pairs of rows of a cell, in each of many whole cells, that have different roots and marks in reach."""
    starts = _starts(table)[1]
    cell = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
    node, root, size, own, low, high = (table.column(c).to_numpy() for c in ("node", "root", "size", "own", "low", "high"))
    mark = np.frombuffer(b"".join(table.column("mark").to_pylist()), np.uint64).reshape(len(node), -1)
    found = [np.zeros((0, 2), np.int64)]
    # each row and the one so many places behind it, as long as they are of one cell
    at, step = np.arange(len(node)), 1
    while True:
        at = at[: np.searchsorted(at, len(node) - step)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        a, b = at, at + step
        a = a[(root[a] != root[b]) & ((own[a] != own[b]) | (low[a] == high[a])) & reachable(np.zeros(len(a)), size[a], size[b])]
        differ = np.bitwise_count(mark[a] ^ mark[a + step]).sum(axis=1, dtype=np.int64)
        a = a[reachable(differ, size[a], size[a + step])]
        if len(a):
            ends = np.stack([node[a], node[a + step]], axis=1)
            found.append(np.unique(np.sort(ends, axis=1), axis=0))
        step += 1
    found = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_pairs`` of cells that come one after the other; the last of a batch waits for the next."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        last = int(_starts(table)[1][-1])
        if last:
            yield _pairs(table.slice(0, last))
        held = table.slice(last)
    if held is not None:
        yield _pairs(held)


def _differ(a: bytes, b: bytes) -> int:
    """Bits in which two marks differ, the longer one folded onto the length of the other."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    short, long, half = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 4 * len(b)
    while half >= 8 * len(a):
        long = (long >> half) ^ (long & ((1 << half) - 1))
        half //= 2
    return (short ^ long).bit_count()


def _nearer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with their long marks those in reach."""
    for batch in batches:
        one = {c: batch.column(batch.schema.get_field_index(c)) for c in ("u", "v", "a", "b", "left", "right")}
        differ = [_differ(x, y) for x, y in zip(one["left"].to_pylist(), one["right"].to_pylist())]
        keep = reachable(np.array(differ, np.int64), one["a"].to_numpy(), one["b"].to_numpy())
        yield pa.RecordBatch.from_arrays([one["u"].filter(pa.array(keep)), one["v"].filter(pa.array(keep))], names=["u", "v"])


def _dealt(rows: DataFrame, parts: Column) -> DataFrame:
    """``rows`` with (low, high, own) in order of the cells: each pair of the ``parts`` of a group is one."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int"))
    pair = own.withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    low, high = F.least("own", "_other").alias("low"), F.greatest("own", "_other").alias("high")
    cells = pair.select(*rows.columns, "own", low, high)
    return cells.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")


def texts_of(docs: DataFrame) -> DataFrame:
    return keyed_rows(docs).select("one", "two", F.col("text").cast("string").alias("text"))


def links(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges (u, v) between ``nodes`` (node, root, place) that connect all that are linked, of different roots and
    connected by ``edges``. ``rows`` (one, two, text) holds the first row of each of them."""
    groups = connected(edges).select("node", F.col("root").alias("group"))
    # the first row of each node that has a candidate, with its text
    shown = nodes.join(groups, "node").select("node", "root", "group", F.col("place.one").alias("one"), F.col("place.two").alias("two"))
    texts = written(rows.dropDuplicates(["one", "two"]).join(shown, ["one", "two"]).select("node", "root", "group", "text"), "candidates")
    count = F.greatest(F.ceil(F.count(F.lit(1)) / CELL), F.ceil(F.sum(F.octet_length("text")) / CELL_BYTES))
    large = texts.groupBy("group").agg(count.cast("int").alias("parts")).where("parts > 1")
    return _dealt(texts.join(large, "group", "left"), F.coalesce("parts", F.lit(1))).mapInArrow(_cells, "u long, v long")


def missed(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (u, v) of nodes of different ``roots`` (node, root) with a shingle of their leads in common and marks
    in reach: all links between different roots are among them."""
    rows = nodes.select("node", "lead").join(roots, "node").select("node", "root", F.explode("lead").alias("group"))
    here = Window.partitionBy("group")
    several = (
        rows.withColumn("least", F.min("root").over(here))
        .withColumn("most", F.max("root").over(here))
        .withColumn("parts", F.ceil(F.count(F.lit(1)).over(here) / CELL).cast("int"))
        .where("least < most")
    )
    known = several.select("node", "root", "group", "parts").join(nodes.select("node", "size", "mark"), "node")
    pairs = _dealt(known, F.col("parts")).mapInArrow(_near, "u long, v long").distinct()
    left = nodes.select(F.col("node").alias("u"), F.col("size").alias("a"), F.col("marks").alias("left"))
    right = nodes.select(F.col("node").alias("v"), F.col("size").alias("b"), F.col("marks").alias("right"))
    return pairs.join(left, "u").join(right, "v").mapInArrow(_nearer, "u long, v long")


def _marked(docs: DataFrame) -> DataFrame:
    rows = keyed_rows(docs).withColumn("text", F.col("text").cast("string"))
    return with_node(rows, ["doc_id", "one", "two"], heavy_shingles(docs))


def _roots(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, place, root) of every node."""

    def rooted(edges: DataFrame) -> DataFrame:
        named = nodes.select("node", "place").join(connected(edges), "node", "left")
        return named.withColumn("root", F.coalesce("root", "node"))

    alone = nodes.select("node", F.col("node").alias("root"), "place")
    rows = texts_of(docs)
    known = rooted(links(rows, alone, candidates(nodes)))
    more = written(missed(nodes, known.select("node", "root")), "missed")
    if more.isEmpty():
        return known
    # written, so that its size is known: the texts are not shuffled for a few of them
    ends = more.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = written(known.join(ends, "node").select("place.one", "place.two"), "wanted")
    more = written(links(rows.join(wanted, ["one", "two"], "left_semi"), known, more), "links")
    if more.isEmpty():
        return known
    return rooted(more.union(known.select("node", "root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row; component_id is the smallest doc_id."""
    marked = written(_marked(docs), "shingles")
    rooted = _roots(docs, written(nodes_of(marked), "nodes"))
    least = rooted.groupBy("root").agg(F.min("place.doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return marked.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of links, with all its columns, as told in ``best_of_each``."""
    return best_of_each(docs, _roots(docs, written(nodes_of(_marked(docs)), "nodes")))
