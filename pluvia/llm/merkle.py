"""Merkle manifest of a table: one tree per group, one tree over their roots, a proof per row.

Rows of a group lie in their order; ``fanout`` consecutive nodes become the hash of their hex digests, one
after the other, until one node is left. Aligned runs of ``fanout ** block_levels`` leaves are blocks, each
folded by itself. Above them the blocks exchange as in a butterfly: in round r the blocks whose numbers differ
only in digit r (to the base ``fanout``) form a group, every one of them gets the subtree roots of the others,
notes those as a step of its own proof and hashes the parent, which all of the group then know. After the
last round each block holds the root and its whole upper proof, so nothing travels down the tree. Blocks
that lack partners get empty ones, fewer than there are blocks, which know and pass on what they are told.

Positions come from a table sorted by ranges and written once; only one row per block goes through the rounds,
in groups of ``fanout`` rows. No group, range or block is bound to a hot key.

Nulls: a null group is a group of its own, before all others; a null order value comes first. Ties in the order
lie by leaf, so rows equal in both may change places without changing a node. A lone leaf is its own root; an
empty table has no rows. Columns are carried in one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.ranks import numbered
from pluvia.session import new_folder

FANOUT = 2
BLOCK_LEVELS = 10
ROUNDS_PER_PLAN = 6  # the plan is cut by a written table after as many rounds
STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sized(value: Column) -> Column:
    """A value as its length in bytes, a colon and itself; a null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(sized, values)), 256)


def depth(leaves: int, fanout: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while fanout**levels < leaves:
        levels += 1
    return levels


def _folded(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of every level, leaves first."""
    out = [leaves]
    for _ in range(levels):
        last = out[-1]
        out.append([digest("".join(last[k : k + fanout])) for k in range(0, len(last), fanout)])
    return out


def _block_roots(rows: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    def root(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1)
        n = first["n"][0].as_py()
        leaves = table.sort_by("pos")["leaf"].to_pylist()
        node = _folded(leaves, min(depth(n, fanout), block_levels), fanout)[-1][0]
        return first.select(["tree", "block", "n"]).append_column("node", pa.array([node]))

    parts = rows.select("tree", "block", "n", "pos", "leaf").groupBy("tree", "block")
    return parts.applyInArrow(root, "tree string, block long, n long, node string")


def butterfly(nodes: DataFrame, fanout: int, width: int) -> DataFrame:
    """(tree, block, n, node, path) of blocks of ``width`` leaves: the root and the upper proof of each."""
    spark = nodes.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = new_folder(spark, "merkle-blocks")
        df.write.parquet(path)
        return spark.read.parquet(path)

    steps = F.array().cast("array<struct<before: string, after: string>>")
    nodes = stored(nodes.withColumn("path", steps))
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = max(depth(most, fanout) - depth(width, fanout), 0)
    if not rounds:
        return nodes
    blocks = F.expr(f"(n + {width - 1}) div {width}")
    needed = sum(((F.col("n") > width * fanout**r).cast("int") for r in range(rounds)), F.lit(0))
    stride = F.element_at(F.array(*[F.lit(fanout ** max(k - 1, 0)) for k in range(rounds + 1)]), needed + 1)
    nodes = nodes.withColumns({"needed": needed, "blocks": blocks, "stride": stride.cast("long")})
    whole = F.expr("((blocks + stride - 1) div stride) * stride")
    empty = nodes.where(F.col("block") + F.col("blocks") < whole).withColumns(
        {"block": F.col("block") + F.col("blocks"), "node": F.lit(None).cast("string")}
    )
    state = nodes.unionByName(empty).drop("stride")
    for r in range(rounds):
        below, above = fanout**r, fanout ** (r + 1)
        state = state.withColumns(
            {"_low": F.expr(f"block % {below}"), "_high": F.expr(f"block div {above}"), "_digit": F.expr(f"block div {below} % {fanout}")}
        )
        group = Window.partitionBy("tree", "_high", "_low")
        known = F.when(F.col("node").isNotNull(), F.struct(F.col("_digit").alias("at"), "node"))
        state = state.withColumn("_all", F.array_sort(F.collect_list(known).over(group)))

        def joined(keep) -> Column:
            return F.array_join(F.transform(F.filter("_all", keep), lambda x: x["node"]), "")

        digit, active = F.col("_digit"), F.col("needed") > r
        step = F.struct(joined(lambda x: x["at"] < digit).alias("before"), joined(lambda x: x["at"] > digit).alias("after"))
        parent = F.when(F.size("_all") > 0, F.sha2(joined(lambda x: x["at"] >= 0), 256))
        state = state.withColumns(
            {
                "path": F.when(active, F.concat("path", F.array(step))).otherwise(F.col("path")),
                "node": F.when(active, parent).otherwise(F.col("node")),
            }
        ).drop("_low", "_high", "_digit", "_all")
        if r % ROUNDS_PER_PLAN == ROUNDS_PER_PLAN - 1:
            state = stored(state)
    return state.where(F.col("block") < F.col("blocks")).drop("needed", "blocks")


def _proven(rows: DataFrame, tops: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """``rows`` with ``proof``: siblings in the block, then the path of the block."""
    carried = [c for c in rows.columns if c not in ("n", "block")]
    added = [c for c in tops.columns if c not in ("tree", "block", "n", "path")]

    def prove(rows: pa.Table, tops: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        local = min(depth(tops["n"][0].as_py(), fanout), block_levels)
        levels = _folded(rows["leaf"].to_pylist(), local, fanout)
        upper = tops["path"][0].as_py()
        above = [s["before"] for s in upper], [s["after"] for s in upper]
        before, after = [], []
        for at in range(rows.num_rows):
            for nodes in levels[:local]:
                first = at - at % fanout
                before.append("".join(nodes[first:at]))
                after.append("".join(nodes[at + 1 : first + fanout]))
                at //= fanout
            before += above[0]
            after += above[1]
        steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(STEP))
        size = local + len(upper)
        offsets = pa.array(range(0, size * rows.num_rows + 1, size) if size else [0] * (rows.num_rows + 1), pa.int32())
        out = rows.select(carried)
        for name in added:
            out = out.append_column(name, pa.array([tops[name][0].as_py()] * rows.num_rows, pa.string()))
        return out.append_column("proof", pa.ListArray.from_arrays(offsets, steps))

    fields = [rows.schema[c] for c in carried] + [tops.schema[c] for c in added] + [tops.schema["path"]]
    kinds = ", ".join(f"`{f.name if f.name != 'path' else 'proof'}` {f.dataType.simpleString()}" for f in fields)
    return rows.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(prove, kinds)


def _tree(rows: DataFrame, order: list[str], fanout: int, block_levels: int) -> tuple[DataFrame, DataFrame]:
    width = fanout**block_levels
    placed = numbered(rows, "tree", [*order, "leaf"], ["row", "leaf"]).withColumnRenamed("n_group", "n")
    placed = placed.withColumn("block", F.expr(f"pos div {width}"))
    return placed, butterfly(_block_roots(placed, fanout, block_levels), fanout, width)


def manifest(
    df: DataFrame,
    leaf: Column,
    group: Column,
    order: list[Column],
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(row, leaf, pos, subroot, root, proof) per row of ``df``.

    ``row`` holds the columns of ``df``, ``pos`` is the place in the group, ``proof`` has one step a level:
    the digests before and after the node in its run, joined.
    """
    keys = [f"_o{k}" for k in range(len(order))]
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        name.alias("tree"),
        leaf.alias("leaf"),
        *[o.alias(k) for o, k in zip(order, keys)],
    )
    placed, tops = _tree(rows, keys, fanout, block_levels)
    roots = tops.where("block = 0").select(
        F.lit("").alias("tree"), F.struct(F.col("tree").alias("name"), "n").alias("row"), F.col("node").alias("leaf"), F.col("tree").alias("_o0")
    )
    of_roots, top = _tree(roots, ["_o0"], fanout, block_levels)
    proven = _proven(of_roots, top.withColumnRenamed("node", "root"), fanout, block_levels)
    # each root goes to all blocks of its tree
    last = F.expr(f"(row.n - 1) div {fanout**block_levels}")
    spread = proven.select(
        F.col("row.name").alias("tree"), F.col("proof").alias("rest"), "root", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    tops = tops.withColumnRenamed("node", "subroot").join(spread, ["tree", "block"])
    tops = tops.withColumn("path", F.concat("path", "rest")).drop("rest")
    return _proven(placed, tops, fanout, block_levels).drop("tree")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def op12_merkle(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, the roots, the digest of its proof, and whether the row, tampered with
    where 7 divides crc32(doc_id), still leads to the root. A row without doc_id is not tampered with."""
    count = F.col("n_chars").cast("decimal(20,0)")

    def leaf(n: Column) -> Column:
        return leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))

    touched = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & count.isNotNull()
    rows = docs.select("doc_id", "lang", leaf(count).alias("leaf"), F.when(touched, leaf(count + 1)).alias("changed"))
    proven = manifest(rows, F.col("leaf"), F.col("lang"), [F.col("doc_id")])
    shown = proven.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("row.changed", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32(text: str) -> str:
    """DuckDB: the unsigned crc32 of a decimal number. The table follows from the polynomial of that checksum."""
    table = "[list_reduce([CAST(b AS BIGINT)] || range(8), lambda c, s: xor(c >> 1, (c & 1) * 3988292384)) FOR b IN range(256)]"
    step = f"xor(c >> 8, table_[(xor(c, b) & 255) + 1])"
    start = f"[4294967295] || [CAST(ord(x) AS BIGINT) FOR x IN string_split({text}, '')]"
    return f"(SELECT xor(list_reduce({start}, lambda c, b: {step}), 4294967295) FROM (SELECT {table} AS table_))"


def _sized_sql(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf_sql(count: str) -> str:
    return "sha256(" + " || ".join(_sized_sql(c) for c in ("doc_id", "source", "lang", count, "text")) + ")"


def _climb_sql(name: str, start: str) -> str:
    """All nodes of the trees of ``start`` (tree, pos, node, n)."""
    return f"""{name}(tree, level, pos, node, n) AS (SELECT tree, 0, pos, node, n FROM {start} UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(node || coalesce(next, '')), (n + 1) // 2
  FROM (SELECT *, lead(node) OVER (PARTITION BY tree ORDER BY pos) AS next FROM {name} WHERE n > 1) WHERE pos % 2 = 0)"""


def _fold_sql(name: str, start: str, nodes: str) -> str:
    """The way up from ``start`` (id, tree, pos, n, node, proof)."""
    return f"""{name}(id, tree, level, pos, n, node, proof) AS (SELECT id, tree, 0, pos, n, node, proof FROM {start} UNION ALL
  SELECT id, f.tree, f.level + 1, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 0 THEN f.node || coalesce(s.node, '') ELSE s.node || f.node END), proof || coalesce(s.node, '')
  FROM {name} f LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1)"""


ORACLE = f"""WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL
      THEN {_leaf_sql("CAST(n_chars AS HUGEINT) + 1")} END AS changed
  FROM documents),
leaves AS (SELECT *, leaf AS node, row_number() OVER (ORDER BY doc_id NULLS FIRST, leaf) AS id,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_climb_sql("nodes", "leaves")},
roots AS (SELECT tree AS name, '' AS tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_climb_sql("tops", "roots")},
tampered AS (SELECT id, tree, pos, n, coalesce(changed, leaf) AS node, '' AS proof FROM leaves),
{_fold_sql("ways", "tampered", "nodes")},
reached AS (SELECT w.id, r.tree, r.pos, r.n, w.node, w.proof FROM ways w JOIN roots r ON r.name = w.tree WHERE w.n = 1),
{_fold_sql("ends", "reached", "tops")}
SELECT l.doc_id, l.leaf, r.node AS subroot, t.node AS root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = t.node AS verified
FROM leaves l JOIN roots r ON r.name = l.tree JOIN ends e ON e.id = l.id AND e.n = 1 JOIN tops t ON t.n = 1"""
