"""Ordered per-key operators that do not depend on how rows spread over keys.

``Window.partitionBy(key)`` puts a whole key into one task. That is the right plan
while every key is small and the wrong one when a county holds a third of the data,
so each operator first measures its largest key. Up to ``rows_per_task`` rows it is a
plain window. Beyond that, each busy key gets cut points: of the rows whose hash falls into
a fixed share of all hashes, ordered as the key is, every ``CELLS``-th. They divide the key into
pieces of some ``SPAN`` blocks. The cuts are a tree with up to ``FANOUT`` of them in a node, and a
row finds its piece from node to node by joins on (keys, node) and halving: what it meets grows with
the logarithm of the cuts, not with their number. Numbered inside its piece, and with the exact counts of
the pieces before, a row knows its place in the key; ``rows_per_task`` places in a row are a block.
The piece of a row is a function of the row and of its key's cuts, so nothing is written and every pass
and every repeated task sees the same places: one exchange on (keys, piece) numbers the rows, one on
(keys, block) does the work. ``order`` must be unique within a key for results to be repeatable; rows
that share it are told apart by a hash of the row, and even a single busy instant is cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 5_000_000
CELLS = 8  # sampled points per cut
SPAN, SPAN_ROWS = 8, 200_000  # a piece is several blocks while these are small, else one
STEPS = 6  # halvings in a node of the tree
FANOUT = 2**STEPS - 1  # cuts in a node at most
FEW = 100_000  # cuts in all, up to which their tables are sent to every task
BLOCK = "_block"


def _key_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows in total, rows of the largest key); map-side combined, one row back."""
    row = df.groupBy(*keys).count().agg(F.sum("count"), F.max("count")).first()
    return (row[0] or 0, row[1] or 0)


def _with(rows: DataFrame, few: DataFrame, keys: Sequence[str], how: str, never_null: Sequence[str] = ()) -> DataFrame:
    """Attach a table of one row per key; null keys match. AQE broadcasts a small one."""
    renamed = few.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        other = F.col(f"_s_{k}")
        on = on & (F.col(k) == other if k in never_null else F.col(k).eqNullSafe(other))
    return rows.join(renamed, on, how).drop(*[f"_s_{k}" for k in keys])


def _piece_rows(rows_per_task: int) -> int:
    return max(rows_per_task, min(SPAN * rows_per_task, SPAN_ROWS))


def _tree(df: DataFrame, keys: list[str], order: list[str], rows_per_task: int, largest: int) -> list[DataFrame]:
    """The cuts of every busy key as a tree, one table (keys, _o_node, _o_heads, _o_stride) per level.

    A node is named by the number of its first cut. ``_o_heads`` are the first cuts of its children,
    ``_o_stride`` apart; on the last level they are the cuts themselves.
    """
    piece = _piece_rows(rows_per_task)
    busy = df.groupBy(*keys).count().filter(F.col("count") > rows_per_task).drop("count")
    share = F.pmod(F.xxhash64(*keys, *order), F.lit(max(1, piece // CELLS))) == 0
    points = df.filter(share).groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*order))).alias("_points"))
    # a level more than expected, so that thinning them further is rare
    levels = max(1, math.ceil(math.log(max(2, 2 * largest // piece), FANOUT)))
    every = F.greatest(F.lit(CELLS), F.ceil(F.size("_points") / FANOUT**levels)).cast("int")
    found = _with(busy, points, keys, "inner").withColumn("_every", every)
    cuts = (
        found.select(*keys, "_every", F.posexplode("_points").alias("_no", "_cut"))
        .filter((F.col("_no") + 1) % F.col("_every") == 0)
        .withColumn("_no", F.floor(F.col("_no") / F.col("_every")))
    )
    tables = []
    for level in range(levels):
        stride = FANOUT ** (levels - 1 - level)
        node = F.floor(F.col("_no") / (stride * FANOUT)) * (stride * FANOUT)
        heads = cuts.filter(F.col("_no") % stride == 0).withColumn("_o_node", node)
        heads = heads.groupBy(*keys, "_o_node").agg(F.sort_array(F.collect_list("_cut")).alias("_o_heads"))
        tables.append(heads.withColumn("_o_stride", F.lit(stride).cast("bigint")))
    return tables


def _in_pieces(df: DataFrame, keys: list[str], order: list[str], tree: list[DataFrame]) -> DataFrame:
    """The rows with ``_o_piece``: how many cuts of the key are at or before the row."""
    here = F.struct(*order)
    rows = df.withColumn("_o_node", F.lit(0).cast("bigint"))
    for table in tree:
        rows = _with(rows, table, [*keys, "_o_node"], "left", ["_o_node"]).withColumn("_o_found", F.lit(0))
        for step in reversed(range(STEPS)):
            # null beyond the last head, and without heads
            before = F.get("_o_heads", F.col("_o_found") + (2**step - 1)) <= here
            rows = rows.withColumn("_o_found", F.col("_o_found") + F.when(before, 2**step).otherwise(0))
        # before the first cut there is no node to go on from
        node = F.greatest(F.col("_o_node") + (F.col("_o_found") - 1) * F.col("_o_stride"), F.lit(-1))
        rows = rows.withColumn("_o_node", F.coalesce(node, F.lit(-1)).cast("bigint")).drop("_o_heads", "_o_stride", "_o_found")
    return rows.withColumn("_o_piece", F.col("_o_node") + 1).drop("_o_node")


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int,
    sizes: tuple[int, int] | None = None,
    weight: Column | None = None,
) -> DataFrame | None:
    """The rows with ``_o_at``, their 0-based place in the key, and ``_o_whole``, its rows, or None where
    every key fits one task.

    With a weight also ``_o_upto``, that of the rows up to this one, and ``_o_all``, that of the key.
    """
    keys, order = list(keys), list(order)
    total, largest = sizes or _key_sizes(df, keys)
    if largest <= rows_per_task:
        return None
    few = total // _piece_rows(rows_per_task) <= FEW
    tree = _tree(df, keys, order, rows_per_task, largest)
    rows = _in_pieces(df, keys, order, [F.broadcast(t) if few else t for t in tree])
    sums = {"_o_at": F.lit(1).cast("bigint")} | ({"_o_upto": weight} if weight is not None else {})
    totals = {"_o_at": "_o_whole", "_o_upto": "_o_all"}
    pieces = rows.groupBy(*keys, "_o_piece").agg(*[F.sum(w).alias(c) for c, w in sums.items()])
    key = Window.partitionBy(*keys)
    earlier = key.orderBy("_o_piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.select(
        *keys,
        "_o_piece",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_ahead{c}") for c in sums],
        *[F.sum(c).over(key).alias(totals[c]) for c in sums],
    )
    told_apart = F.xxhash64(*[f.name for f in df.schema if _hashable(f.dataType)])
    upto = Window.partitionBy(*keys, "_o_piece").orderBy(*order, told_apart)
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.sum(w).over(upto) for c, w in sums.items()})
    rows = _with(rows, F.broadcast(ahead) if few else ahead, [*keys, "_o_piece"], "inner", ["_o_piece"])
    places = {c: F.col(c) + F.col(f"_ahead{c}") for c in sums}
    places["_o_at"] = places["_o_at"] - 1
    return rows.withColumns(places).drop("_o_piece", *[f"_ahead{c}" for c in sums])


def _hashable(kind: T.DataType) -> bool:
    """Whether ``xxhash64`` takes the type: no map in it."""
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def blocks_of(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int,
    sizes: tuple[int, int] | None = None,
    back: int = 0,
) -> DataFrame | None:
    """The rows with a block number and ``_o_at``, their place in the key, or None where every key fits one task.

    ``_home`` is false for the copies of rows that a later block needs: the ``back`` rows before it.
    """
    rows = numbered(df, keys, order, rows_per_task, sizes)
    if rows is None:
        return None

    def block(place: Column) -> Column:
        return F.floor(place / rows_per_task)

    if not back:
        return rows.withColumns({BLOCK: block(F.col("_o_at")), "_home": F.lit(True)}).drop("_o_whole")
    last = F.least(F.col("_o_at") + back, F.col("_o_whole") - 1)
    copies = F.posexplode(F.sequence(block(F.col("_o_at")), block(last))).alias("_far", BLOCK)
    rows = rows.select(*df.columns, "_o_at", copies)
    return rows.withColumn("_home", F.col("_far") == 0).drop("_far")


def _join_blocks(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Attach per-(key, block) values; null keys match. AQE broadcasts a small summary."""
    renamed = summary.withColumnsRenamed({c: f"_s_{c}" for c in [*keys, BLOCK]})
    on = F.col(BLOCK) == F.col(f"_s_{BLOCK}")
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return rows.join(renamed, on, "left").drop(*[f"_s_{c}" for c in [*keys, BLOCK]])


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int,
    make: Callable[[Window], list[dict[str, Column]]],
    position: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows behind the current one.

    ``make`` gives the columns in steps; a step may use those before it. ``position``
    names an optional column with the 0-based place of the row in its key.
    """
    keys, order = list(keys), list(order)
    rows = blocks_of(df, keys, order, rows_per_task, back=back)
    if rows is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        for columns in make(window):
            df = df.withColumns(columns)
        return df.withColumn(position, F.row_number().over(window) - 1) if position else df
    window = Window.partitionBy(*keys, BLOCK).orderBy("_o_at")
    for columns in make(window):
        rows = rows.withColumns(columns)
    if position:
        rows = rows.withColumn(position, F.col("_o_at"))
    return rows.filter("_home").drop(BLOCK, "_home", "_o_at")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    name: str = "before",
    total: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the summed weight of the rows of the key that come earlier (exclusive).

    Without a weight this is the 0-based position of the row within its key. ``total``
    names an optional column with the summed weight of the whole key. ``sizes`` spares
    the measuring where the caller knows (rows in total, rows of the largest key).
    """
    keys, order = list(keys), list(order)
    w = F.col(weight) if weight else F.lit(1).cast("bigint")

    def local(window: Window) -> Column:
        return F.sum(w).over(window.rowsBetween(Window.unboundedPreceding, 0)) - w

    rows = numbered(df, keys, order, rows_per_task, sizes, w if weight else None)
    if rows is None:
        key = Window.partitionBy(*keys)
        columns = {name: local(key.orderBy(*order))}
        if total:
            columns[total] = F.sum(w).over(key)
        return df.withColumns(columns)
    columns = {name: F.col("_o_upto") - w if weight else F.col("_o_at")}
    if total:
        columns[total] = F.col("_o_all" if weight else "_o_whole")
    return rows.withColumns(columns).drop("_o_at", "_o_whole", "_o_upto", "_o_all")


def fill_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace nulls by the next non-null value of the key (back fill).

    Runs on the reversed order, where the frame grows by one row per step.
    """
    keys, order = list(keys), list(order)

    def upto(window_keys: list[str], places: Sequence[str]) -> Window:
        backwards = [F.col(c).desc() for c in places]
        return Window.partitionBy(*window_keys).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, 0)

    blocks = blocks_of(df, keys, order, rows_per_task)
    if blocks is None:
        return df.withColumns({c: F.last(c, ignorenulls=True).over(upto(keys, order)) for c in columns})
    rows = blocks.withColumns(
        {c: F.last(c, ignorenulls=True).over(upto([*keys, BLOCK], ["_o_at"])) for c in columns}
    )
    # the first row of a block now has the first value of the block
    firsts = rows.filter(F.col("_o_at") % rows_per_task == 0).select(*keys, BLOCK, *columns)
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col(BLOCK).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = firsts.select(
        *keys,
        BLOCK,
        *[F.last(c, ignorenulls=True).over(later).alias(f"_next_{c}") for c in columns],
    )
    joined = _join_blocks(rows, carried, keys)
    return joined.withColumns({c: F.coalesce(c, f"_next_{c}") for c in columns}).drop(
        BLOCK, "_home", "_o_at", *[f"_next_{c}" for c in columns]
    )


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    nearest_rank: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    count: str | None = None,
    mean: str | None = None,
) -> DataFrame:
    """Exact quantiles per key from counts of distinct values.

    Equal values are counted map-side first, so a busy value is one row. Interpolated
    by default; ``nearest_rank`` takes the element at ``min(int(p * n), n - 1)``.
    ``count`` and ``mean`` name optional columns that come from the same counts.
    """
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    # Distinct values per key by HyperLogLog: a scan with a tiny shuffle, good to a few percent.
    distinct = df.groupBy(*keys).agg(F.approx_count_distinct(value).alias("d"))
    sizes = distinct.agg(F.coalesce(F.sum("d"), F.lit(0)), F.coalesce(F.max("d"), F.lit(0))).first()
    rows = running(
        counts, keys, ["_value"], "_count", "_before", "_n", rows_per_task, (sizes[0], sizes[1])
    )

    def value_at(rank: Column) -> Column:
        inside = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_count"))
        return F.max(F.when(inside, F.col("_value")))

    picked = []
    for name, p in probabilities.items():
        if nearest_rank:
            rank = F.least(F.floor(F.lit(p) * F.col("_n")), F.col("_n") - 1)
            picked.append(value_at(rank).alias(name))
            continue
        h = F.lit(p) * (F.col("_n") - 1)
        low, high = value_at(F.floor(h)), value_at(F.ceil(h))
        share = F.max(h - F.floor(h))
        picked.append((low + (high - low) * share).alias(name))
    if count:
        picked.append(F.sum("_count").alias(count))
    if mean:
        picked.append((F.sum(F.col("_value") * F.col("_count")) / F.sum("_count")).alias(mean))
    return rows.groupBy(*keys).agg(*picked)
