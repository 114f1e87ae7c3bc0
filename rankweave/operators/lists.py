"""Arrays per key of at most about a fixed number of entries.

A key with more entries has several rows, told apart by ``part``, which is 0 for
all others. The part of an entry is its place in the order of the key's entries
over the size of a part or, where entries repeat, a hash of the entry modulo the
number of parts. So rows depend neither on settings nor on how the data is
partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.runtime import stored

LIST_ENTRIES = 10_000


def long_keys(rows: DataFrame, key: str, size: Column, max_list: int) -> DataFrame:
    """Keys with more than ``max_list`` entries: ``long(long_key, parts)``.

    They are counted now and stored as files, whose size is known, so that a join with them can be split by key
    wherever the rows are skewed, and is a broadcast if they are few.
    """
    if max_list < 1:
        raise ValueError("max_list must be at least 1")
    sizes = rows.groupBy(F.col(key).alias("long_key")).agg(F.sum(size).alias("entries"))
    parts = F.ceil(F.col("entries") / max_list).cast("long")
    return stored(sizes.where(F.col("entries") > max_list).select("long_key", parts.alias("parts")), "long")


def with_list_parts(rows: DataFrame, key: str, long: DataFrame) -> DataFrame:
    """Rows with the number of ``parts`` of their key, one for most."""
    joined = rows.join(long, F.col(key) == F.col("long_key"), "left").drop("long_key")
    return joined.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))


def places(rows: DataFrame, key: str, items: list[str]) -> DataFrame:
    """Rows with their ``place`` in the order of their key's items, from 0.

    They are sorted by ranges, over which a key with many items is spread, and stored; only the numbers of rows of a
    key in each range are summed.
    """
    ordered = rows.orderBy(key, *items).withColumn("id", F.monotonically_increasing_id())
    ordered = stored(ordered.withColumn("range", F.shiftright("id", 33)), "ordered")
    before = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy(key, "range").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    place = F.col("before") + F.col("id") - F.col("first")
    return ordered.join(ranges, [key, "range"]).select(key, *items, place.alias("place"))


def collect_items(rows: DataFrame, key: str, items: list[str], name: str, max_list: int) -> DataFrame:
    """One sorted array of up to ``max_list`` of the ``items``, distinct within their key, per key and ``part``."""
    item = F.col(items[0]) if len(items) == 1 else F.struct(*items)
    # Only the items of long lists are sorted over all tasks.
    long = long_keys(rows, key, F.lit(1), max_list).select(F.col("long_key").alias(key))
    short = rows.join(long, key, "left_anti").select(key, *items, F.lit(0).cast("long").alias("part"))
    parts = places(rows.join(long, key, "left_semi").select(key, *items), key, items)
    parts = parts.select(key, *items, F.expr(f"place div {int(max_list)}").alias("part"))
    return short.unionByName(parts).groupBy(key, "part").agg(F.sort_array(F.collect_list(item)).alias(name))


def collect_copies(
    rows: DataFrame, key: str, item: str, copies: str, name: str, long: DataFrame, max_list: int
) -> DataFrame:
    """Like ``collect_items`` with each item as often as ``copies`` says.

    Many copies of one item come in chunks, so that they can be spread as well.
    """
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / max_list))
    chunk_size = F.least(F.lit(max_list), F.col(copies) - F.col("chunk") * max_list).cast("int")
    part = F.pmod(F.pmod(F.xxhash64(item), F.col("parts")) + F.col("chunk"), F.col("parts"))
    return (
        with_list_parts(rows, key, long)
        .withColumn("chunk", F.explode(chunks))
        .groupBy(key, part.alias("part"))
        .agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col(item), chunk_size)))).alias(name))
    )
