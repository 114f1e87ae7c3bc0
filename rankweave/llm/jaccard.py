"""Similarity join on word shingles: MinHash prefixes of a fixed length in many trees, then exact Jaccard similarity.

A forest would keep sorted prefix tries and shorten matched prefixes until enough is found. Here the length is settled
before any data is seen: the longest prefix at which a pair at the threshold still meets the target recall. Shortening
by what has been found cannot promise that for a pair that has not, and matching shorter prefixes than needed only
makes nodes larger. With one length, a prefix is a hash, and the tries are groups of equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.components import connected_components
from rankweave.llm.groups import explode_cells, local_roots, sorted_groups
from rankweave.llm.words import mix, split_words, text_blocks, windows
from rankweave.runtime import stored

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
MAX_DEPTH = 8
TARGET_RECALL = 0.999
BLOCK = 256  # rows of a tree node that one task compares with as many others
COLUMNS = 4096  # shingles that are multiplied at a time


def matched_depth(threshold: float, target: float, trees: int = TREES, depth: int = MAX_DEPTH) -> int:
    """How far matched prefixes are shortened: from ``depth`` hashes down until pairs at the threshold reach the target.

    Two sets of similarity s share a prefix of k hashes in one of the trees with probability 1 - (1 - s^k)^trees.
    """
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _seeds(trees: int) -> np.ndarray:
    return np.random.RandomState(977).randint(0, 2**63, trees * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted within a text, and where each text's begin.

    A text of fewer than ``size`` words has one shingle, all its words; one without words has none.
    """
    words = split_words(texts)
    hashes, first = words.hashes(), words.first
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(texts)), counts)
    grams = windows(hashes, size)
    inside = text_of[: len(grams)] == text_of[size - 1 :][: len(grams)] if len(grams) else np.zeros(0, dtype=bool)
    owner, value = text_of[: len(grams)][inside], grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.concatenate([windows(hashes[first[t] : first[t + 1]], int(counts[t])) for t in short])
        whole = whole * np.uint64(0x5851F42D4C957F2D)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(value):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
        owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def tree_keys(values: np.ndarray, first: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each set with a shingle, a 64-bit hash of its prefix of ``depth`` MinHashes in each tree."""
    heads = first[:-1][first[1:] > first[:-1]]
    if not len(heads):
        return np.zeros((0, trees), dtype=np.uint64)
    seeds = _seeds(trees).reshape(trees, MAX_DEPTH)
    keys = np.empty((len(heads), trees), dtype=np.uint64)
    for tree in range(trees):
        key = np.full(len(heads), np.uint64(tree + 1))
        for level in range(depth):
            hashed = values * seeds[tree, level]
            hashed ^= hashed >> np.uint64(32)
            hashed *= np.uint64(0x9E3779B97F4A7C15)
            key = mix(key + np.minimum.reduceat(hashed, heads))
        keys[:, tree] = key
    return keys


def _int64(array: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(array).view(np.int64), pa.int64())


SIGNED = "row long, doc_id long, size int, set1 long, set2 long, keys binary"
SETS = "row long, size int, shingles binary, keys binary"
LINKS = "row long, links long, root long"


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Whether each of ``left`` and each of ``right`` (``left`` itself if None) are similar: exact Jaccard of the sets."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count[column] > 1  # shingles of one set alone are in no intersection
    number = np.cumsum(count > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n = len(left)
    common = np.zeros((n, len(sets) - n if right is not None else n))
    width = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, width - begin)), dtype=np.float32)
        part[row[a:b], column[a:b] - begin] = 1
        common += part[:n] @ (part[n:] if right is not None else part).T
    union = sizes[:n, None] + (sizes[n:] if right is not None else sizes)[None, :] - common
    ratio = Fraction(threshold).limit_denominator(10_000)
    return common * ratio.denominator >= union * ratio.numerator


def _compare(trees: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for (tree, _, i, j), table in sorted_groups(batches, ["tree", "node", "cell_i", "cell_j"]):
            rows, weight, block = (table.column(c).to_numpy() for c in ("row", "copies", "block"))
            sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
            keys = np.stack([np.frombuffer(k, dtype=np.uint64) for k in table.column("keys").to_pylist()])
            if i == j:
                a = b = np.arange(len(rows))
                similar = np.triu(linked_pairs(sets, None, threshold), 1)
            else:
                a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
                if not len(a) or not len(b):
                    continue
                similar = linked_pairs([sets[k] for k in a], [sets[k] for k in b], threshold)
            x, y = np.nonzero(similar)
            x, y = a[x], b[y]
            # A pair counts in the first tree that it meets in.
            fresh = ~(keys[x, :tree] == keys[y, :tree]).any(axis=1)
            x, y = x[fresh], y[fresh]
            if not len(x):
                continue
            links = np.zeros(len(rows), dtype=np.int64)
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            root = local_roots(rows, x, y)
            met = links > 0
            out.append((rows[met], links[met], root[met]))
            if len(out) >= 1000:
                yield _links(out)
                out = []
        if out:
            yield _links(out)

    return run


def _links(parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], names=["row", "links", "root"]
    )


def join_similar(
    documents: DataFrame,
    *,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    target_recall: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, class_id, n_links, copy_id, kept, row`` for each row of ``documents``.

    Two documents are linked if the sets of their ``shingle``-word shingles have a Jaccard similarity of at least
    ``threshold``. ``n_links``: documents linked with this one; ``class_id``: the smallest doc_id that links lead to,
    itself included; ``copy_id``: the smallest doc_id with the same set; ``kept``: whether the row is its class's
    first by id. Texts under ``shingle`` words have one shingle, all their words. Texts without words, null among them, are
    linked with nothing. Null ids come after all others. Repeated rows are copies of each other with the same result,
    and ``row``, a hash of id and text, is the same for them. An empty table gives an empty result.

    Documents with equal sets are one class from the start. In each tree, classes whose signatures share
    a prefix of ``matched_depth`` hashes meet in a node. Nodes with the same members as another are dropped. All pairs
    of a node are compared exactly, in cells of two blocks each; a cell returns the number of links of each row and the
    smallest row that it is joined to, never pairs.
    """
    depth = matched_depth(threshold, target_recall, trees)
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("doc_id", "text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            values, first = shingle_sets(texts, shingle)
            sizes = np.diff(first)
            filled = sizes > 0
            heads = first[:-1][filled]
            set1, set2 = np.zeros(len(texts), dtype=np.uint64), np.zeros(len(texts), dtype=np.uint64)
            keys: list[bytes | None] = [None] * len(texts)
            if len(heads):
                set1[filled] = mix(np.add.reduceat(mix(values), heads))
                set2[filled] = mix(np.add.reduceat(mix(values ^ np.uint64(0xA0761D6478BD642F)), heads))
                found = tree_keys(values, first, trees, depth)
                for k, t in enumerate(np.flatnonzero(filled)):
                    keys[t] = found[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(sizes, pa.int32()), _int64(set1), _int64(set2), pa.array(keys, pa.binary())],
                names=["row", "doc_id", "size", "set1", "set2", "keys"],
            )

    signed = stored(keyed.select("row", "doc_id", "text").mapInArrow(sign, SIGNED), "signed")
    last_id = F.coalesce("doc_id", F.lit(2**63 - 1))
    classes = stored(
        signed.where("size > 0")
        .groupBy("set1", "set2")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(last_id.alias("id"), "row")).alias("first"))
        .select("set1", "set2", "copies", F.col("first.id").alias("copy_id"), F.col("first.row").alias("row")),
        "classes",
    )

    # Tree nodes with at least two classes, without those that have the same members as an earlier one.
    split_keys = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.substring("keys", t * 8 + 1, F.lit(8)).alias("node")),
    )
    unique_rows = signed.where("size > 0").join(classes.select("row", "copies"), "row").dropDuplicates(["row"])
    entries = stored(
        unique_rows.select("row", "copies", F.inline(split_keys)).withColumn("node", F.conv(F.hex("node"), 16, -10).cast("long")),
        "entries",
    )
    nodes = (
        entries.groupBy("tree", "node")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min("row").alias("low"),
            F.max("row").alias("high"),
            F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("total"),
        )
        .where("members > 1")
    )
    nodes = stored(
        nodes.groupBy("members", "low", "high", "total").agg(F.min(F.struct("tree", "node")).alias("first")).select(
            "first.tree", "first.node", "members"
        ),
        "nodes",
    )
    met = stored(entries.join(nodes, ["tree", "node"]), "met")

    # The sets of the classes that meet any other.
    needed = stored(met.select("row").distinct(), "needed")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            values, first = shingle_sets(texts, shingle)
            keys = tree_keys(values, first, trees, depth)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.diff(first), pa.int32()),
                    pa.array([values[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                ],
                names=["row", "size", "shingles", "keys"],
            )

    texts = keyed.select("row", "text").join(needed, "row").dropDuplicates(["row"])
    sets = stored(texts.mapInArrow(collect, SETS), "sets")
    cells = explode_cells(met.join(sets, "row"), F.col("members"), F.col("row"), block)
    cell = ["tree", "node", "cell_i", "cell_j"]
    dealt = cells.select(*cell, "row", "block", "copies", "shingles", "keys").repartition(*cell).sortWithinPartitions(*cell)
    links = stored(dealt.mapInArrow(_compare(trees, threshold), LINKS), "links")

    roots = connected_components(links.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")))
    counts = stored(links.groupBy("row").agg(F.sum("links").alias("links")), "counts")
    placed = (
        classes.join(counts, "row", "left")
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .withColumn("root", F.coalesce("root", "row"))
    )
    placed = stored(placed, "placed")
    first = F.min(F.struct("copy_id", "row")).alias("first")
    heads = stored(
        placed.groupBy("root").agg(first).select("root", F.col("first.copy_id").alias("class_id"), F.col("first.row").alias("head")),
        "heads",
    )
    result = stored(
        placed.join(heads, "root").select(
            F.col("set1").alias("s1"),
            F.col("set2").alias("s2"),
            "class_id",
            "head",
            "copy_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "result",
    )
    same = (signed["set1"] == result["s1"]) & (signed["set2"] == result["s2"]) & (signed["size"] > 0)
    null_id = F.lit(2**63 - 1)
    return signed.join(result, same, "left").select(
        "doc_id",
        F.nullif(F.coalesce("class_id", last_id), null_id).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(F.coalesce("copy_id", last_id), null_id).alias("copy_id"),
        (F.coalesce("head", "row") == F.col("row")).alias("kept"),
        "row",
    )
