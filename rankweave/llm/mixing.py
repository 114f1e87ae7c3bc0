"""Mixing sources to target weights: entropy balancing by distributed Newton iterations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.llm.groups import placed
from rankweave.runtime import stored

WEIGHTS = (5, 2, 1)
MIX_PERCENT = 150
MAX_COPIES = 2
BLANKS = "\t\n\x0b\x0c\r"
TOLERANCE = 1e-6
MAX_ITERATIONS = 40
UNIT_BITS = 20
UNIT = 1 << UNIT_BITS  # rates are whole numbers of this fraction when they are rounded into copies
RANK_BUCKET = 200  # rows of a source and size that are numbered together


def word_count(text: Column) -> Column:
    """Longest runs without blank, tab, line feed, vertical tab, form feed and carriage return; null has none."""
    blanked = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        blanked = F.replace(blanked, F.lit(blank), F.lit(" "))
    return F.size(F.array_remove(F.split(blanked, " "), "")).cast("long")


def running_sums(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Rows with ``<column>_sum`` of each column, over all rows up to this one in ascending order; stored.

    They are sorted by ranges and summed within these; only the sums of the ranges are added up together.
    """
    ordered = rows.orderBy(order).withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered.withColumn("_range", F.shiftright("_id", 33)), "ordered")
    here = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("_range").agg(*[F.sum(c).alias(c) for c in columns])
    ranges = ranges.select("_range", *[F.coalesce(F.sum(c).over(here), F.lit(0)).alias(f"_before{c}") for c in columns])
    within = Window.partitionBy("_range").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ordered.join(ranges, "_range")
    for c in columns:
        summed = summed.withColumn(f"{c}_sum", F.col(f"_before{c}") + F.sum(c).over(within)).drop(f"_before{c}")
    return stored(summed.drop("_id", "_range"), "summed")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = MIX_PERCENT) -> DataFrame:
    """``source, source_size`` with ``target``: ``percent`` of all sizes shared by weight, at most ``MAX_COPIES`` times the source.

    The excess of capped sources goes to the others by weight until none is above. With the sources in the order of
    cap to weight, those up to some place are capped, and all others get the same multiple of their weights.
    """
    everything = sources.agg(F.sum("source_size").alias("size")).first()["size"] or 0
    named = placed(sources.withColumn("_all", F.lit(0)), "_all", [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    cap = (MAX_COPIES * F.col("source_size")).cast("double")
    ranked = named.select("source", "source_size", weight.alias("_weight"), cap.alias("_cap"))
    ranked = running_sums(ranked.withColumn("_ratio", F.col("_cap") / F.col("_weight")), "_ratio", ["_cap", "_weight"])
    total = everything * (percent / 100)
    all_weights = ranked.agg(F.sum("_weight").alias("weight")).first()["weight"] or 0.0
    # A source is capped if what is left for it and the heavier ones lifts it to its cap.
    ranked = ranked.withColumn("_capped", F.col("_cap_sum") + (all_weights - F.col("_weight_sum")) * F.col("_ratio") <= total)
    sums = ranked.groupBy("_capped").agg(F.sum("_cap").alias("cap"), F.sum("_weight").alias("weight")).collect()  # two rows at most
    rest = total - sum(row["cap"] for row in sums if row["_capped"])
    free = sum(row["weight"] for row in sums if not row["_capped"])
    share = F.col("_weight") / F.lit(free or 1.0)
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least(F.lit(rest) * share, F.col("_cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def _rate(multiplier: Column, size: Column) -> Column:
    """Copies of a document of relative size ``size``: the exponential tilt of one copy towards 0 or ``MAX_COPIES``."""
    return MAX_COPIES / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), multiplier * size))))


def balance(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, multiplier``: the solution of the dual for each source.

    ``cells``: source, size, number of documents. The rates nearest to one copy in relative entropy (of the copies
    taken and of those left out of ``MAX_COPIES``) whose words meet the target are tilted exponentially by
    multiplier * size. The dual is convex and separate for each source; a Newton step needs the sum of rate * size and
    of its derivative, which all cells give in one aggregation. A step that leaves the interval known to hold the
    solution is replaced by its middle. A target at the cap, or at 0, has no finite solution: all or no copies.
    """
    relative = F.col("size") / F.col("_mean")
    state = targets.select(
        "source",
        "target",
        "_mean",
        F.lit(0.0).alias("multiplier"),
        F.lit(-1e6).alias("_low"),
        F.lit(1e6).alias("_high"),
        (
            (F.col("target") <= 0) | (F.col("target") >= MAX_COPIES * F.col("source_size") * (1 - 1e-12))
        ).alias("_done"),
    )
    state = stored(
        state.withColumn(
            "multiplier", F.when(F.col("_done"), F.when(F.col("target") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))).otherwise(0.0)
        ),
        "multipliers",
    )
    for _ in range(MAX_ITERATIONS):
        active = state.where(~F.col("_done"))
        if active.isEmpty():
            break
        rate = _rate(F.col("multiplier"), relative)
        sums = (
            cells.join(active, F.equal_null(cells["source"], active["source"]))
            .select(
                active["source"],
                (F.col("n") * F.col("size") * rate).alias("words"),
                (F.col("n") * F.col("size") * relative * rate * (1 - rate / MAX_COPIES)).alias("slope"),
            )
            .groupBy("source")
            .agg(F.sum("words").alias("_words"), F.sum("slope").alias("_slope"))
            .withColumnRenamed("source", "_source")
        )
        miss = F.col("_words") - F.col("target")
        low = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("_low"))
        high = F.when(miss > 0, F.col("multiplier")).otherwise(F.col("_high"))
        step = F.col("multiplier") - F.try_divide(miss, F.col("_slope"))
        inside = step.isNotNull() & ~F.isnan(step) & (step > low) & (step < high)
        # Without a usable step: towards the solution, twice as far from 0 as long as no other bound is known.
        wide = F.when((low <= -1e6) | (high >= 1e6), F.when(miss < 0, F.abs("multiplier") + 1).otherwise(-F.abs("multiplier") - 1) * 2).otherwise((low + high) / 2)
        done = F.abs(miss) <= TOLERANCE * F.col("target")
        stepped = state.join(sums, F.equal_null(state["source"], F.col("_source")), "left").select(
            "source",
            "target",
            "_mean",
            F.when(F.col("_done") | done, F.col("multiplier")).when(inside, step).otherwise(wide).alias("multiplier"),
            F.when(F.col("_done"), F.col("_low")).otherwise(low).alias("_low"),
            F.when(F.col("_done"), F.col("_high")).otherwise(high).alias("_high"),
            (F.col("_done") | F.coalesce(done, F.lit(True))).alias("_done"),
        )
        state = stored(stepped, "multipliers")
    return state.select("source", "multiplier", "_mean")


def mix_sources(documents: DataFrame, *, doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, percent: int = MIX_PERCENT) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for each row of ``documents``.

    ``size`` is the number of words, ``target`` the words wanted from the row's source, ``taken`` = copies * size with 0
    to ``MAX_COPIES`` copies. Sources are ordered by code point with null last and weigh 5, 2, 1 and so on.

    Rates become copies by rounding their running sum, by source, size and id: as sizes only rise within a source,
    its words miss the target by at most one of its largest documents. The order is fixed, so reruns agree. Repeated
    rows count as documents of their own; which of them is copied more often is not determined, but the rows of the
    result are. A null or empty text has size 0 and is taken 0 words; a source of nothing else has target 0. An empty
    table gives an empty result.

    Texts are read once, for their sizes. All further work is on sizes: Newton iterations on the number of documents
    of each source and size, running sums over these, and numbers within them by buckets of ``RANK_BUCKET`` rows.
    """
    chosen = documents.select(F.col(doc_id).alias("doc_id"), "source", word_count(F.col("text")).alias("size"))
    sized = stored(chosen.withColumn("_row", F.monotonically_increasing_id()), "sizes")
    cells = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("_mean"),
    )
    targets = stored(
        source_targets(sources.select("source", "source_size"), weights, percent)
        .withColumnRenamed("source", "_name")
        .withColumnRenamed("source_size", "_size")
        .join(sources, F.equal_null(F.col("_name"), F.col("source")))
        .select("source", "source_size", "_mean", "target"),
        "targets",
    )
    solved = balance(cells, targets)
    rated = (
        cells.join(solved.withColumnRenamed("source", "_name"), F.equal_null(F.col("source"), F.col("_name")))
        .withColumn(
            "rate",
            F.when(F.col("multiplier") == float("inf"), float(MAX_COPIES))
            .when(F.col("multiplier") == float("-inf"), 0.0)
            .otherwise(_rate(F.col("multiplier"), F.col("size") / F.col("_mean"))),
        )
        .withColumn("_units", F.round(F.col("rate") * UNIT).cast("long"))
    )
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn("_before", F.coalesce(F.sum(F.col("n") * F.col("_units")).over(before), F.lit(0)) % UNIT).select(
        F.col("source").alias("_name"), F.col("size").alias("_cell"), "n", "rate", "_units", "_before"
    )
    same_cell = F.equal_null(F.col("source"), F.col("_name")) & (F.col("size") == F.col("_cell"))
    buckets = F.ceil(F.col("n") / RANK_BUCKET)
    # Rows without an id come after all others, and are spread by themselves.
    bucket = F.when(F.col("doc_id").isNull(), buckets + F.pmod(F.xxhash64("_row"), buckets)).otherwise(F.pmod(F.xxhash64("doc_id"), buckets))
    dealt = stored(
        sized.join(rated, same_cell)
        .withColumn("_bucket", bucket)
        .select("doc_id", "source", "size", "rate", "_units", "_before", "_bucket"),
        "dealt",
    )
    earlier = Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("source", "size", "_bucket")
        .agg(F.count(F.lit(1)).alias("_in"))
        .select(
            F.col("source").alias("_name"),
            F.col("size").alias("_cell"),
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    within = Window.partitionBy("source", "size", "_bucket").orderBy("doc_id")
    numbered = dealt.withColumn("_number", F.row_number().over(within) - 1).join(
        offsets, same_cell & (F.col("_bucket") == F.col("_b"))
    )
    start = F.col("_before") + (F.col("_offset") + F.col("_number")) * F.col("_units") + UNIT // 2
    copies = F.shiftright(start + F.col("_units"), UNIT_BITS) - F.shiftright(start, UNIT_BITS)
    result = numbered.withColumn("copies", copies.cast("int")).drop("_name")
    return result.join(targets.select(F.col("source").alias("_name"), "source_size", "target"), F.equal_null(F.col("source"), F.col("_name"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )
