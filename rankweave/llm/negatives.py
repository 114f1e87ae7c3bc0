"""Hard negatives for anchors, by inner product: length buckets with sorted coordinate lists that prune candidates.

Rows are sorted by length (norm) into buckets of a fixed size. In a bucket, a score of at least s means a cosine of at
least s / (anchor's length x longest row). An angle to the anchor that is at most the one of this cosine bounds each
coordinate of a row: the feasible range is cut out of the sorted list of that coordinate. Rows that are in the ranges
of all focus coordinates, those where the anchor is largest, are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.llm.groups import placed, sorted_groups
from rankweave.runtime import forget, stored

BUCKET = 8192  # rows that are compared with at a time
ANCHORS = 1024  # anchors that travel together
FOCUS = 4  # coordinates whose ranges are intersected
LEAST, MOST = -(2**63), 2**63 - 1

PACKED = "width int, number long, longest double, needed double, packed binary"
FOUND = "anchor long, which int, score long, id long, row long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each bucket as one row."""
    for (width, number), table in sorted_groups(batches, ["width", "number"]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        longest, needed = max(table.column("norm").to_pylist()), min(table.column("needed").to_pylist())
        columns = [(width, pa.int32()), (number, pa.int64()), (longest, pa.float64()), (needed, pa.float64()), (sink.getvalue().to_pybytes(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in columns], names=["width", "number", "longest", "needed", "packed"]
        )


class _Block:
    """A packed block: ids, labels, rows, lengths and a matrix of vectors."""

    def __init__(self, packed: bytes):
        table = pa.ipc.open_stream(packed).read_all()
        self.table = table
        self.id, self.label, self.row, self.norm = (table.column(c).to_numpy() for c in ("id", "label", "row", "norm"))
        width = table.column("width")[0].as_py()
        vectors = table.column("vector").combine_chunks()
        self.vectors = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(self.id), width)
        # Python's numbers, as the distance to zero of the smallest one does not fit.
        self.largest = max(int(self.vectors.max()), -int(self.vectors.min())) if self.vectors.size else 0
        self.unit = self.vectors / np.where(self.norm > 0, self.norm, 1.0)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in the order of a coordinate, and its values."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def feasible(self, unit: np.ndarray, cosine: float, focus: int) -> np.ndarray:
        """Places of the rows that can have at least this cosine with ``unit``: all those, and others."""
        angle = np.arccos(min(max(cosine - 1e-9, -1.0), 1.0))
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:focus].tolist():
            to_axis = np.arccos(min(max(unit[f], -1.0), 1.0))
            low, high = np.cos(min(np.pi, to_axis + angle)) - 1e-9, np.cos(max(0.0, to_axis - angle)) + 1e-9
            order, values = self.sorted_list(f)
            a, b = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
            ranges.append((b - a, f, low, high, order[a:b]))
        ranges.sort(key=lambda r: r[0])
        found = ranges[0][4]
        for _, f, low, high, _ in ranges[1:]:
            found = found[(self.unit[found, f] >= low) & (self.unit[found, f] <= high)]
        return found


def _scores(rows: np.ndarray, queries: np.ndarray, largest: int) -> np.ndarray:
    """Exact inner products, ``queries`` by ``rows``; those beyond 64 bits become the nearest number of 64 bits."""
    if largest < 2**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if largest < 2**63:
        return queries @ rows.T
    return np.clip(queries.astype(object) @ rows.astype(object).T, LEAST, MOST).astype(np.int64)


def _best(block: _Block, places: np.ndarray, scores: np.ndarray, ranges: list[dict], k: int) -> Iterator[tuple]:
    """For each range of scores the first ``k`` by falling score, then id."""
    order = np.lexsort((block.row[places], block.id[places], ~scores))
    falling = ~scores[order]
    for which, span in enumerate(ranges):
        begin = int(np.searchsorted(falling, ~np.int64(span["high"])))
        for i in order[begin : begin + k].tolist():
            if scores[i] < span["low"]:
                break
            yield which, int(scores[i]), int(block.id[places[i]]), int(block.row[places[i]])


def _searcher(k: int, same: bool, focus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i].as_py() for name in ("bucket", "rows", "anchors")}
                if block is None or cell["bucket"] != current:
                    current, block = cell["bucket"], _Block(cell["rows"])
                anchors = _Block(cell["anchors"])
                found = list(search_block(block, anchors, k, same, focus))
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["anchor", "which", "score", "id", "row"])

    return run


def search_block(block: _Block, anchors: _Block, k: int, same: bool, focus: int = FOCUS) -> Iterator[tuple]:
    """``anchor, which, score, id, row``: the best ``k`` rows of a block for each anchor and each of its ranges of scores."""
    longest = float(block.norm.max())
    bound = block.largest * anchors.largest * max(block.vectors.shape[1], 1)
    ranges = anchors.table.column("ranges").to_pylist()
    everything = np.arange(len(block.id))
    dense: list[int] = []
    feasible: dict[int, np.ndarray] = {}
    for a, spans in enumerate(ranges):
        lowest = min((span["low"] for span in spans), default=MOST)
        if not spans or lowest > anchors.norm[a] * longest * (1 + 1e-9):
            continue
        if lowest <= 0:
            dense.append(a)
            continue
        found = block.feasible(anchors.unit[a], lowest / (anchors.norm[a] * longest), focus)
        if 2 * len(found) > len(everything):
            dense.append(a)
        elif len(found):
            feasible[a] = found

    def answers(a: int, places: np.ndarray, scores: np.ndarray) -> Iterator[tuple]:
        lowest = min(span["low"] for span in ranges[a])
        chosen = ((block.label[places] == anchors.label[a]) == same) & (block.row[places] != anchors.row[a]) & (scores >= lowest)
        for answer in _best(block, places[chosen], scores[chosen], ranges[a], k):
            yield int(anchors.row[a]), *answer

    for begin in range(0, len(dense), 64):
        some = dense[begin : begin + 64]
        for a, scores in zip(some, _scores(block.vectors, anchors.vectors[some], bound)):
            yield from answers(a, everything, scores)
    for a, places in feasible.items():
        yield from answers(a, places, _scores(block.vectors[places], anchors.vectors[a : a + 1], bound)[0])


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows in buckets of ``size``, numbered from 0 by falling length."""
    numbered = placed(rows, "width", [F.desc("norm"), "row"])
    dealt = numbered.withColumn("number", F.expr(f"place div {size}")).drop("place", "n").repartition("width", "number")
    packed = stored(dealt.sortWithinPartitions("width", "number").mapInArrow(_pack, PACKED), "packed")
    forget(numbered)
    return packed


def _search(anchors: DataFrame, buckets: DataFrame, k: int, same: bool, focus: int, size: int, first: bool) -> DataFrame:
    """The first ``k`` rows for each anchor and range of scores over all buckets, or only those of the longest rows."""
    blocks = _packed(anchors, size).withColumnRenamed("number", "block")
    counts = buckets.groupBy("width").agg(F.max("number").alias("last"))
    last = F.lit(0).cast("long") if first else F.col("last")
    cells = blocks.select("block", "width", "needed").join(counts, "width").select(
        "block", "width", "needed", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("number")
    )
    # Whole buckets whose rows are too short for any anchor of a block are left out here.
    long_enough = F.col("longest") * (1 + 1e-9) >= F.col("needed")
    cells = cells.join(buckets.select("width", "number", "longest"), ["width", "number"]).where(long_enough)
    cells = stored(cells.select("block", "width", "number"), "cells")
    dealt = (
        cells.join(blocks.select("width", "block", F.col("packed").alias("anchors")), ["width", "block"])
        .join(buckets.select("width", "number", F.col("packed").alias("rows")), ["width", "number"])
        .select(F.xxhash64("width", "number").alias("bucket"), "rows", "anchors")
    )
    found = dealt.mapInArrow(_searcher(k, same, focus), FOUND)
    order = Window.partitionBy("anchor", "which").orderBy(F.desc("score"), "id", "row")
    best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")
    forget(cells)
    return best


def _ranged(anchors: DataFrame) -> DataFrame:
    """How long a row must be to reach the lowest score of an anchor."""
    lowest = F.array_min(F.transform("ranges", lambda span: span["low"]))
    needed = F.when(F.size("ranges") == 0, float("inf")).when(lowest <= 0, 0.0).when(F.col("norm") > 0, lowest / F.col("norm"))
    return anchors.withColumn("needed", F.coalesce(needed, F.lit(float("inf"))))


def _span(low: Column, high: Column) -> Column:
    return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))


def _raised(anchors: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Ranges whose low end is the score of the last of ``k`` rows already found."""
    kth = found.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("which", "score"))).alias("kth"))
    joined = anchors.join(kth, anchors["row"] == kth["anchor"], "left")
    raised = F.transform("ranges", lambda span, i: _span(F.greatest(span["low"], F.coalesce(F.try_element_at("kth", i), span["low"])), span["high"]))
    return joined.withColumn("ranges", F.when(F.col("kth").isNull(), F.col("ranges")).otherwise(raised)).drop("kth", "anchor")


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    bucket: int = BUCKET,
    anchors: int = ANCHORS,
    focus: int = FOCUS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` holds whole numbers and ``label`` a whole number; a score is the inner product. Rows come by falling
    score, equal ones by id. The positives of an anchor, a row where the condition holds, are its first ``positives``
    other rows of the same label. Of each, the negatives are the first ``negatives`` rows of other labels with a score
    of ``low`` to ``high`` hundredths of the positive's. Where there are fewer, all are returned.

    Rows with a null label, vector or component take no part. A null id comes after all others and is returned as null.
    Rows of one id are different rows, and each is an anchor if the condition holds. Only vectors of one length have a
    score. Scores beyond 64 bits become the largest or smallest number. Zero vectors score 0. No rows or anchors give
    no rows.

    Rows are cut into buckets of exactly ``bucket`` rows by their place in the order of lengths, so equal ones are
    spread. All anchors, in blocks, meet all buckets but those too short for them. First they meet the longest rows
    alone: the last score found there is one that later rows must reach. Pruning never drops a row that belongs to the
    result, and a bucket in which it drops less than half is multiplied out. Results of a bucket are bounded by its
    anchors, and limited again per anchor before they are shuffled.
    """
    values = F.col(f"`{vector}`")
    usable = F.col(f"`{label}`").isNotNull() & values.isNotNull() & F.forall(values, lambda x: x.isNotNull())
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    chosen = rows.where(usable).select(
        F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(MOST)).alias("id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        values.cast("array<bigint>").alias("vector"),
        F.size(values).alias("width"),
        norm.alias("norm"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    held = stored(chosen.withColumn("row", F.monotonically_increasing_id()), "rows")
    nothing = F.array().cast("array<struct<low:bigint,high:bigint>>")
    buckets = _packed(held.drop("anchor").withColumn("ranges", nothing).withColumn("needed", F.lit(0.0)), bucket)
    queries = held.where("anchor").drop("anchor")

    def best(ranged: DataFrame, k: int, same: bool) -> DataFrame:
        seen = _search(_ranged(ranged), buckets, k, same, focus, anchors, first=True)
        return _search(_ranged(_raised(ranged, seen, k)), buckets, k, same, focus, anchors, first=False)

    near = best(queries.withColumn("ranges", F.array(_span(F.lit(LEAST), F.lit(MOST)))), positives, True)
    score = F.col("score").cast("decimal(25,0)")
    span = _span(F.ceil(score * low / 100), F.floor(score * high / 100))
    spans = near.select(
        F.col("anchor").alias("query"), "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), span.alias("span")
    )
    listed = spans.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "span")))["span"].alias("ranges"))
    far = best(queries.join(listed, queries["row"] == listed["query"]).drop("query"), negatives, False)
    named = queries.select("row", F.col("id").alias("anchor_id"))
    return (
        far.select(F.col("anchor").alias("query"), (F.col("which") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(spans.select("query", F.col("rank").alias("place"), "positive_id", "positive_score"), ["query", "place"])
        .join(named, F.col("query") == named["row"])
        .select(
            "anchor_id", F.nullif("positive_id", F.lit(MOST)).alias("positive_id"), "rank",
            F.nullif("negative_id", F.lit(MOST)).alias("negative_id"), "positive_score", "negative_score",
        )
    )
