"""Merkle manifest of a table: leaves by row, a tree per source, a tree over the sources.

A node is a lowercase hex SHA-256. Every ``FAN`` consecutive nodes of a level become one of the next, the hash of
their concatenation; the last run may be shorter, even one node. A tree ends when one node is left.

``BLOCK`` = ``FAN ** STEPS`` consecutive nodes of a tree form an aligned block, so the next ``STEPS`` levels of the
block depend on nothing else. A block keeps each of its levels as one string of hex digests: parents hash
substrings of ``FAN`` digests, and the siblings of a node are the substrings on both sides of it in its run. The
tops of the blocks are the nodes of the next round, and so are, when every source has one node left, the
sources' roots. Paths are handed back from the root, each round's blocks meeting the paths of their tops.

A block holds at most ``BLOCK`` rows, so no group grows with its source. Rows are numbered inside their source
over many tasks. Only the largest count of nodes in a tree reaches the driver, once per round.

Defined results: sources are ordered by their UTF-8 bytes, NULL first; NULL is a source like any other. Leaves
ascend by doc_id, NULL first, rows of one doc_id by their leaf. Repeated rows are leaves of their own. A lone leaf is
the root of its tree. An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.places import placed
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN, STEPS, DIGEST = 3, 6, 64
BLOCK = FAN**STEPS
POWERS = [FAN**k for k in range(40)]
PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    """Leaf of a row; a field can be given another value."""
    parts = [field(changed.get(name, F.col(f"`{name}`"))) for name in FIELDS]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def parents(level: Column) -> Column:
    """The next level of a level."""
    run = FAN * DIGEST
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / run).cast("int"))
    hashed = F.transform(runs, lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256))
    return F.array_join(hashed, "").cast("binary")


def levels_of(nodes: Column, steps: Column) -> Column:
    """All levels of a block, lowest first: its nodes and ``steps`` more."""
    first = F.array(F.array_join(nodes, "").cast("binary"))
    return F.aggregate(
        F.array_repeat(F.lit(0), steps), first, lambda done, _: F.concat(done, F.array(parents(F.element_at(done, -1))))
    )


def path_in(levels: Column, place: Column) -> Column:
    """Sibling strings (left, right) of a block's node on each level below the top."""

    def siblings(level: Column, k: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(float(FAN)), k)).cast("int")
        inside = at % FAN
        return F.struct(
            F.substring(level, (at - inside) * DIGEST + 1, inside * DIGEST).alias("left"),
            F.substring(level, (at + 1) * DIGEST + 1, (FAN - 1 - inside) * DIGEST).alias("right"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), siblings)


def fold(node: Column, path: Column) -> Column:
    """Root that a node and a path lead to."""
    step = lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256).cast("binary")
    return F.aggregate(path, node.cast("binary"), step).cast("string")


def proof_text(path: Column) -> Column:
    """All siblings of a path as one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), "")


def blocks_of(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """tree, block, n (nodes of the tree), rows, levels from (tree, place, n, node, kept columns)."""
    row = F.struct("place", "node", *kept)
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / BLOCK).alias("block"), "n").agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )
    height = F.size(F.filter(F.array(*map(F.lit, POWERS)), lambda p: p < F.col("n")))
    steps = F.least(height, F.lit(STEPS))
    return grouped.withColumn("levels", levels_of(F.col("rows.node"), steps))


def tops_of(blocks: DataFrame) -> DataFrame:
    """The nodes of the next round."""
    top = F.element_at("levels", -1).cast("string")
    return blocks.select(
        "tree", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), top.alias("node")
    )


def with_paths(blocks: DataFrame, above: DataFrame, kept: list[str]) -> DataFrame:
    """Nodes of the blocks, each with its path to the root, from the paths of the blocks' tops."""
    known = [c for c in above.columns if c not in ("tree", "place", "path")]
    upper = above.select(
        F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("path").alias("_path"), *known
    )
    met = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_place"))
    own = lambda r: F.concat(path_in(F.col("levels"), r["place"] % BLOCK), F.col("_path"))
    each = F.transform("rows", lambda r: F.struct(*(r[c].alias(c) for c in ("place", "node", *kept)), own(r).alias("path")))
    joined = blocks.join(own_exchange(upper), met)
    return joined.select("tree", *known, F.explode(each).alias("r")).select("tree", *known, "r.*")


def largest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("n").alias("n")).first()["n"] or 0


def manifest(docs: DataFrame, **kept: Column) -> DataFrame:
    """doc_id, leaf, subroot, root and path (siblings up to the root) of every row, and the columns in ``kept``."""
    carried = ["doc_id", *kept]
    leaves = docs.select(
        F.col("source").cast("string").alias("tree"), "doc_id", leaf_of().alias("node"),
        *(value.alias(name) for name, value in kept.items()),
    )
    rounds = [blocks_of(placed(leaves, "tree", ["doc_id", "node"]), carried)]
    while True:
        rounds[-1] = cut_lineage(rounds[-1])
        nodes = tops_of(rounds[-1])
        if largest(nodes) <= 1:
            break
        rounds.append(blocks_of(nodes, []))
    subroots = nodes.select("tree", "node")
    # One tree over the sources, whose nodes remember their source.
    ordered = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "node")
    tops = placed(ordered, "tree", ["source"])
    over, names = [], ["source"]
    while True:
        over.append(cut_lineage(blocks_of(tops, names)))
        tops, names = tops_of(over[-1]), []
        if largest(tops) <= 1:
            break
    paths = tops.select("tree", "place", F.col("node").alias("root"), F.expr(f"cast(array() AS {PATH})").alias("path"))
    for blocks in reversed(over[1:]):
        paths = with_paths(blocks, paths, []).drop("node")
    paths = with_paths(over[0], paths, ["source"]).select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("place"), "root", F.col("node").alias("subroot"), "path"
    )
    for blocks in reversed(rounds[1:]):
        paths = with_paths(blocks, paths, []).drop("node")
    return with_paths(rounds[0], paths, carried).select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", *kept
    )
