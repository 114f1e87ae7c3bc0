"""Merkle manifest of a dataset: one hash over all rows, and a proof for every row, found by pointer jumping.

Rows are leaves of binary trees, one for each value of a column, and the roots of these are leaves of one more tree.
A node is ``(tree, level, place)``; a tree of n leaves has ``(n - 1 >> level) + 1`` nodes on a level, so which side a
sibling is on, or that a node has none, follows from ``place`` and ``n`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.groups import placed
from rankweave.runtime import forget, stored

BLOCK_LEVELS = 8  # levels that one group of nodes is hashed up at a time: groups hold 2 ** BLOCK_LEVELS nodes
SPREAD_LEVELS = 8  # a join key of a jump has up to 2 ** SPREAD_LEVELS nodes below it


def leaf_hash(columns: list[Column]) -> Column:
    """Hash of a row: each value as its UTF-8 byte count, a colon and the value, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(F.lit(0))


def _parents(nodes: Column) -> Column:
    """Hashes of each two consecutive nodes; of the last one alone where it is left over."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Blocks of nodes of level ``base`` with the ``levels`` above them, up to the root or ``BLOCK_LEVELS``, own included."""
    above = F.least(_height(F.col("n")) - base, F.lit(BLOCK_LEVELS))
    grouped = nodes.groupBy("tree", "n", F.shiftright("place", BLOCK_LEVELS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "hash")))["hash"].alias("own")
    )
    steps = F.when(above > 0, F.sequence(F.lit(1), above)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(steps, F.array("own"), lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1)))))
    return stored(grouped.select("tree", "n", "block", levels.alias("levels")), "blocks")


def _siblings(blocks: DataFrame, base: int) -> DataFrame:
    """Each node below the top level of its block with its sibling; lone leaves as well."""
    levels = blocks.select("tree", "n", "block", F.size("levels").alias("size"), F.posexplode("levels").alias("up", "nodes"))
    levels = levels.where((F.col("up") < F.col("size") - 1) | ((F.col("up") == 0) & (F.col("n") == 1)))
    both = F.transform("nodes", lambda _, i: F.coalesce(F.get("nodes", i.bitwiseXOR(F.lit(1))), F.lit("")))
    nodes = levels.select("tree", "n", "block", "up", F.posexplode(both).alias("i", "segment"))
    place = F.expr(f"shiftleft(block, {BLOCK_LEVELS} - up)") + F.col("i")
    return nodes.select("tree", "n", (F.col("up") + base).alias("level"), place.alias("place"), "segment")


def _jump(pointers: DataFrame, distance: int) -> DataFrame:
    """Pointers over ``distance`` levels to pointers over twice as many: a self-join from a node to where it points.

    Only nodes on levels that are a multiple of the distance are ever pointed at. A node far up has many below it: its
    row is repeated for the nodes ``SPREAD_LEVELS`` above these, so that no join key is hot.
    """
    near = min(distance, SPREAD_LEVELS)
    rest = distance - near
    lower = pointers.where(F.col("level") % (2 * distance) == 0).withColumn("slot", F.shiftright("place", near))
    upper = pointers.where(F.col("level") % (2 * distance) == distance)
    last = F.expr(f"shiftright(n - 1, level - {rest})")
    slots = F.sequence(F.shiftleft("place", rest), F.least(F.shiftleft(F.col("place") + 1, rest) - 1, last))
    upper = upper.select("tree", (F.col("level") - distance).alias("level"), F.explode(slots).alias("slot"), F.col("segment").alias("further"))
    joined = lower.join(upper, ["tree", "level", "slot"], "left")
    return joined.select("tree", "n", "level", "place", F.concat("segment", F.coalesce("further", F.lit(""))).alias("segment"))


def prove(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves(tree, hash, ...)`` in the given order.

    Returns the leaves with ``place``, ``n`` and ``siblings``, the hashes of a leaf's siblings from its level to the
    root in one string, and ``roots(tree, root)``.
    """
    numbered = placed(leaves, "tree", order)
    height = numbered.agg(F.max(_height(F.col("n")))).first()[0] or 0
    nodes, pointers, roots = numbered.select("tree", "n", "place", "hash"), None, None
    for base in range(0, height + 1, BLOCK_LEVELS):
        if base and base >= height:
            break
        blocks = _blocks(nodes, base)
        below = _siblings(blocks, base)
        pointers = below if pointers is None else pointers.unionByName(below)
        top = F.get(F.element_at("levels", -1), F.lit(0))
        done = _height(F.col("n")) <= base + BLOCK_LEVELS
        ended = blocks.where(done).select("tree", top.alias("root"))
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = blocks.where(~done).select("tree", "n", F.col("block").alias("place"), top.alias("hash"))
    distance, before = 1, None
    while distance < height:
        pointers = stored(_jump(pointers, distance), "pointers")
        if before is not None:
            forget(before)
        before, distance = pointers, distance * 2
    proofs = pointers.where("level = 0").select("tree", "place", F.col("segment").alias("siblings"))
    return numbered.join(proofs, ["tree", "place"]), roots


def fold(leaf: Column, place: Column, n: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    steps = F.when(n > 1, F.sequence(F.lit(0), _height(n) - 1)).otherwise(F.array().cast("array<int>"))

    def up(node: Column, level: Column) -> Column:
        own = F.call_function("shiftright", place, level)
        last = F.call_function("shiftright", n - 1, level)
        right = own % 2 == 1
        alone = ~right & (own == last)
        sibling = F.when(alone, F.lit("")).otherwise(F.substring(siblings, node["used"] + 1, F.lit(64)))
        both = F.when(right, F.concat(sibling, node["hash"])).otherwise(F.concat(node["hash"], sibling))
        used = node["used"] + F.length(sibling)
        return F.struct(F.sha2(both, 256).alias("hash"), used.alias("used"))

    return F.aggregate(steps, F.struct(leaf.alias("hash"), F.lit(0).alias("used")), up, lambda node: node["hash"])


def merkle_manifest(rows: DataFrame, columns: list[str], *, tree: str, order: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """``order, tree, leaf, place, n, siblings, subroot, top_place, top_n, top_siblings, root`` and ``keep`` for each row.

    ``leaf`` is the hash of the row's ``columns``. Rows with the same value of ``tree`` are the leaves of one binary
    tree, ascending by ``order``; its root is ``subroot``. A node left over on a level is hashed alone, and a lone leaf
    is its own root. The subroots, null first and then by bytes, are the leaves of a tree whose root is ``root``.
    ``siblings`` and ``top_siblings`` are the proof of a leaf and of its subroot, which ``fold`` checks.

    Values may be null. Null ids come first; equal ids are ordered by their leaf, so equal rows have equal leaves at
    neighbouring places. Columns of any other name are ignored. No rows give no rows. Texts of any length are hashed
    where they are read and never shuffled. Every tree is built by blocks of ``2 ** BLOCK_LEVELS`` nodes, whatever its
    size; then nodes hold the siblings on the way to an ancestor, and joins of the nodes with themselves double the
    distance to it until the leaves point at their root.
    """
    # Null sorts before every other value, and joins as itself.
    named = F.coalesce(F.concat(F.lit("+"), F.col(f"`{tree}`").cast("string")), F.lit(""))
    extra = {f"keep_{name}": column for name, column in (keep or {}).items()}
    leaves = rows.select(
        named.alias("tree"), F.col(f"`{order}`").alias("id"), leaf_hash([F.col(f"`{c}`") for c in columns]).alias("hash"),
        *[column.alias(name) for name, column in extra.items()],
    )
    proved, roots = prove(leaves, ["id", "hash"])
    subroots = roots.select(F.lit("").alias("tree"), F.col("root").alias("hash"), F.col("tree").alias("name"))
    tops, root = prove(subroots, ["name"])
    tops = stored(
        tops.join(root, "tree").select(
            F.col("name").alias("tree"), F.col("hash").alias("subroot"), F.col("place").alias("top_place"),
            F.col("n").alias("top_n"), F.col("siblings").alias("top_siblings"), "root",
        ),
        "tops",
    )
    return proved.join(tops, "tree").select(
        F.col("id").alias(order), F.expr("substring(nullif(tree, ''), 2)").alias("tree"), F.col("hash").alias("leaf"), "place", "n", "siblings",
        "subroot", "top_place", "top_n", "top_siblings", "root", *[F.col(f"keep_{name}").alias(name) for name in keep or {}],
    )
