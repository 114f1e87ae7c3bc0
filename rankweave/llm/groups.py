"""Rows of one key out of sorted partitions, and the cells that large keys are cut into."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.runtime import stored


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal ``keys``, also across batches."""
    last, parts = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        begin = 0
        for i, key in enumerate(zip(*columns)):
            if key != last:
                if i > begin:
                    parts.append(batch.slice(begin, i - begin))
                if parts:
                    yield last, pa.Table.from_batches(parts)
                last, parts, begin = key, [], i
        if batch.num_rows > begin:
            parts.append(batch.slice(begin))
    if parts:
        yield last, pa.Table.from_batches(parts)


def placed(rows: DataFrame, group: str, order: list[str | Column]) -> DataFrame:
    """Rows with their ``place`` in the order of their group, from 0, and the number ``n`` of its rows; stored.

    They are sorted by ranges, so no group is too large; only the rows of each group in each range are summed.
    """
    ordered = rows.orderBy(group, *order).withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered.withColumn("_range", F.shiftright("_id", 33)), "ordered")
    cells = ordered.groupBy(group, "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    ranges = Window.partitionBy(group).orderBy("_range")
    before = F.sum("_rows").over(ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    cells = cells.withColumn("_before", before).withColumn("n", F.sum("_rows").over(Window.partitionBy(group)))
    place = F.col("_before") + F.col("_id") - F.col("_first")
    found = ordered.join(stored(cells.drop("_rows"), "cells"), [group, "_range"]).withColumn("place", place)
    return stored(found.drop("_id", "_range", "_first", "_before"), "placed")


def explode_cells(members: DataFrame, count: Column, row: Column, size: int) -> DataFrame:
    """Deal the rows of a key into blocks of about ``size`` and send each block to its cells with all blocks.

    Adds ``cell_i, cell_j`` and ``block``. Every pair of rows of a key meets in exactly one cell: (i, i) for two rows
    of block i, (i, j) with i < j otherwise. A key of up to ``size`` rows is one cell.
    """
    blocks = F.ceil(count / size).cast("int")
    dealt = members.withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64(row), F.col("_blocks")).cast("int"))
    other = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return (
        other.withColumn("cell_i", F.least("block", "_other"))
        .withColumn("cell_j", F.greatest("block", "_other"))
        .drop("_blocks", "_other")
    )


def local_roots(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest of ``rows`` that each row reaches over links between positions ``left`` and ``right``."""
    root = rows.copy()
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        if (root == before).all():
            break
    return root
