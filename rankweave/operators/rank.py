"""Link rank: damped rounds over a multigraph of pages.

Pages have numbers, kept in a dictionary, and links are held as ``(src, dst, weight)`` by number, where the weight is
the share of a source's rank that goes to a target. They are put into buckets by source once; each round joins them in
place with the ranks and shuffles nothing but the contributions, which are summed before and after the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.lists import LIST_ENTRIES, collect_copies, long_keys, with_list_parts
from rankweave.runtime import bucketed, forget, shuffle_partitions, stored

# The rank every source starts with, whatever the damping, and the defaults.
INITIAL_RANK = 0.85
DAMPING = 0.85
ITERATIONS = 2

# Bits of a hash that make the number of a page.
NUMBER_BITS = 62

# Names that are handed to all tasks, if no more are numbered otherwise.
BROADCAST_NAMES = 100_000


def clamp_damping(damping: float) -> float:
    return max(min(float(damping), 1.0), 0.0)


def count_links(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` to ``links(src, dst, copies)``."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("copies"))


def out_degree(edges: DataFrame) -> DataFrame:
    """Links per source, duplicates included: ``degrees(page, links)``."""
    return edges.groupBy(F.col("src").alias("page")).agg(F.count("*").alias("links"))


def node_set(edges: DataFrame) -> DataFrame:
    """Every distinct source and target: ``nodes(page)``."""
    return edges.select(F.col("src").alias("page")).union(edges.select("dst")).distinct()


def init_ranks(
    edges: DataFrame | Graph, initial_rank: float = INITIAL_RANK, max_list: int = LIST_ENTRIES
) -> DataFrame:
    """``edges`` to ``adjacency(page, part, rank, links)``: every source with its links, duplicates included.

    An export form. A source has one row of ``part`` 0 unless it has more than
    ``max_list`` links; its rows together hold its links.
    """
    lists, _ = _link_lists(edges, max_list)
    return lists.select("page", "part", F.lit(float(initial_rank)).alias("rank"), "links")


def rank_state(edges: DataFrame | Graph, ranks: DataFrame, max_list: int = LIST_ENTRIES) -> DataFrame:
    """``ranks(page, rank)`` with the links of each page: ``adjacency``, as it stands between rounds.

    Given the graph that the ranks come from, its links are not counted again.
    """
    lists, long = _link_lists(edges, max_list)
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    return (
        with_list_parts(ranks, "page", long)
        .withColumn("part", parts)
        .join(lists, ["page", "part"], "left")
        .select("page", "part", "rank", F.coalesce("links", F.array().cast("array<string>")).alias("links"))
    )


def _link_lists(edges: DataFrame | Graph, max_list: int) -> tuple[DataFrame, DataFrame]:
    if isinstance(edges, Graph):
        links, sizes = edges.named_links(), edges.pages.select(F.col("page").alias("src"), F.col("links").alias("copies"))
    else:
        # The links are read twice, and edges may come straight from a dump.
        links = sizes = stored(count_links(edges), "links")
    long = long_keys(sizes, "src", F.col("copies"), max_list)
    lists = collect_copies(links, "src", "dst", "copies", "links", long, max_list)
    return lists.withColumnRenamed("src", "page"), long


def adjacency_edges(adjacency: DataFrame) -> DataFrame:
    """``adjacency`` back to ``edges(src, dst)``."""
    return adjacency.select(F.col("page").alias("src"), F.explode("links").alias("dst"))


def adjacency_ranks(adjacency: DataFrame) -> DataFrame:
    """``adjacency`` to ``ranks(page, rank)``, one row per page however many hold its links."""
    return adjacency.select("page", "rank").distinct()


@dataclass(frozen=True)
class Graph:
    """A graph laid out for the rounds, by the numbers of its pages.

    ``pages(number, page, links)`` is the dictionary, with the links of each page, duplicates included. ``light(src, dst,
    copies, weight)`` are the counted and weighted links, in ``buckets`` by source, but for those of the sources in
    ``hubs(hub, out)``, which ``heavy(src, dst, copies, weight)`` has in no order.
    """

    pages: DataFrame
    light: DataFrame
    heavy: DataFrame
    hubs: DataFrame
    buckets: int

    def named_links(self) -> DataFrame:
        """``links(src, dst, copies)`` by the names of the pages."""
        source = self.pages.select(F.col("number").alias("src"), F.col("page").alias("source"))
        target = self.pages.select(F.col("number").alias("dst"), F.col("page").alias("target"))
        # Sources are named in place, in their buckets; only targets take a shuffle.
        light = self.light.join(source.hint("shuffle_hash"), "src")
        hubs = source.join(F.broadcast(self.hubs.select(F.col("hub").alias("src"))), "src")
        links = light.unionByName(self.heavy.join(F.broadcast(hubs), "src")).select("source", "dst", "copies")
        named = links.join(target.hint("shuffle_hash"), "dst")
        return named.select(F.col("source").alias("src"), F.col("target").alias("dst"), "copies")

    def numbered_ranks(self, ranks: DataFrame) -> DataFrame:
        """``ranks(page, rank)`` as ``(number, rank)``, in buckets by number; pages that are not in the graph drop out."""
        found = ranks.join(self.pages, "page").select("number", "rank")
        return bucketed(found.repartition(self.buckets, "number"), "ranks", "number", self.buckets)


def _number(page: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(page), 64 - bits)


def number_pages(edges: DataFrame, bits: int = NUMBER_BITS) -> tuple[DataFrame, DataFrame]:
    """The pages of ``edges(src, dst)`` as ``pages(number, page, links)``, and ``others(page, number)``, those not numbered by hash.

    A page's number is a hash of its name, so no join is needed to find it. Where names share a hash, the first one
    has it; the others, next to none, get negative numbers, which no hash has. ``links`` counts those of a page.
    """
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(end).alias("page"), F.lit(n).alias("n")) for end, n in (("src", 1), ("dst", 0))])))
    hashed = ends.groupBy("page").agg(F.sum("n").alias("links"))
    hashed = stored(hashed.select(_number(F.col("page"), bits).alias("number"), "page", "links"), "pages")
    firsts = hashed.groupBy("number").agg(F.min("page").alias("first"), F.count("*").alias("names")).where("names > 1")
    later = hashed.join(firsts, "number").where("page <> first").select("page")
    others = stored(later.withColumn("number", -1 - F.monotonically_increasing_id()), "others")
    named = hashed.join(others.withColumnRenamed("number", "other"), "page", "left")
    return named.select(F.coalesce("other", "number").alias("number"), "page", "links"), others


def _numbered(edges: DataFrame, others: DataFrame, bits: int) -> DataFrame:
    """``edges(src, dst)`` by number. Many ``others`` are joined by hash tables, which spares sorting the edges twice."""
    join = "broadcast" if others.count() <= BROADCAST_NAMES else "shuffle_hash"
    for end in ("src", "dst"):
        other = others.select(F.col("page").alias(end), F.col("number").alias(f"{end}_number")).hint(join)
        edges = edges.join(other, end, "left").withColumn(f"{end}_number", F.coalesce(f"{end}_number", _number(F.col(end), bits)))
    return edges.select(F.col("src_number").alias("src"), F.col("dst_number").alias("dst"))


def lay_out(edges: DataFrame, bits: int = NUMBER_BITS) -> Graph:
    """Number the pages, collapse duplicate links, weigh them, and put them into buckets by source for the rounds.

    The layout is the same for every graph. Sources with more targets than a bucket has edges on average are its hubs:
    fewer than there are buckets, whatever the graph. Their links are kept apart, and joined with a broadcast of their
    ranks. All other edges are moved once, to the bucket of their source, and counted and weighed there.
    """
    buckets = shuffle_partitions(edges.sparkSession)
    # The edges are read twice, and may come straight from a dump.
    edges = stored(edges.select("src", "dst"), "edges")
    average = edges.count() / buckets
    pages, others = number_pages(edges, bits)
    pages = bucketed(pages.repartition(buckets, "number"), "pages", "number", buckets)
    sizes = pages.groupBy(F.col("number").alias("hub")).agg(F.sum("links").alias("out"))
    # Sources with many edges, most of which may be copies, are counted with a combine and a shuffle by source and target.
    busy = stored(pages.where(F.col("links") > average).select("page"), "busy")
    names, of_busy = F.broadcast(busy), F.col("src").eqNullSafe(F.col("page"))
    copied = stored(count_links(_numbered(edges.join(names, of_busy, "left_semi"), others, bits)), "copied")
    targets = copied.groupBy(F.col("src").alias("hub")).agg(F.count("*").alias("targets")).where(F.col("targets") > average)
    hubs = stored(sizes.join(F.broadcast(targets.select("hub")), "hub"), "hubs")
    of_hub = F.col("src") == F.col("hub")
    weighed = ["src", "dst", "copies", (F.col("copies") / F.col("out")).alias("weight")]
    heavy = stored(copied.join(F.broadcast(hubs), of_hub).select(*weighed), "heavy")
    rest = _numbered(edges.join(names, of_busy, "left_anti"), others, bits).withColumn("copies", F.lit(1).cast("long"))
    rest = rest.unionByName(copied.join(F.broadcast(hubs), of_hub, "left_anti")).repartition(buckets, "src")
    links = rest.groupBy("src", "dst").agg(F.sum("copies").alias("copies"))
    light = bucketed(links.join(sizes.hint("shuffle_hash"), of_hub).select(*weighed), "light", "src", buckets)
    for table in (edges, copied, busy):
        forget(table)
    return Graph(pages, light, heavy, hubs, buckets)


def _handed(graph: Graph, ranks: DataFrame | None, missing: float) -> DataFrame:
    """``contributions`` by number; ``ranks(number, rank)`` lie in buckets by number, so that nothing is moved."""
    if ranks is None:
        both = graph.light.unionByName(graph.heavy)
        return both.select(F.col("dst").alias("page"), (F.lit(missing) * F.col("weight")).alias("contribution"))
    rank = F.coalesce("rank", F.lit(missing))
    # A hash table of the ranks of a bucket spares sorting its links.
    light = graph.light.join(ranks.hint("shuffle_hash"), F.col("src") == F.col("number"), "left")
    of_hubs = ranks.join(F.broadcast(graph.hubs), F.col("number") == F.col("hub"), "left_semi")
    heavy = graph.heavy.join(F.broadcast(of_hubs), F.col("src") == F.col("number"), "left")
    return light.unionByName(heavy).select(F.col("dst").alias("page"), (rank * F.col("weight")).alias("contribution"))


def contributions(graph: Graph, ranks: DataFrame | None, missing: float = INITIAL_RANK) -> DataFrame:
    """What each source hands to each of its targets: ``contributions(page, contribution)``.

    Sources without a row in ``ranks(page, rank)`` have the rank ``missing``.
    """
    handed = _handed(graph, None if ranks is None else graph.numbered_ranks(ranks), missing)
    return handed.join(graph.pages, handed["page"] == graph.pages["number"]).select(graph.pages["page"], "contribution")


def update_ranks(contributed: DataFrame, nodes: DataFrame | None = None, damping: float = DAMPING) -> DataFrame:
    """Ranks from the contributions; those of ``nodes(page)`` without any are one minus damping."""
    if nodes is not None:
        contributed = contributed.unionByName(nodes.select("page", F.lit(0.0).alias("contribution")))
    damping = clamp_damping(damping)
    damped = F.lit(damping) * F.sum("contribution") + F.lit(1.0 - damping)
    return contributed.groupBy("page").agg(damped.alias("rank"))


def rank_round(graph: Graph, ranks: DataFrame | None, missing: float, damping: float) -> DataFrame:
    """One round by number: ``(number, rank)`` of the pages with in-links."""
    return update_ranks(_handed(graph, ranks, missing), damping=damping).withColumnRenamed("page", "number")


def rank_step(edges: DataFrame | Graph, ranks: DataFrame, damping: float = DAMPING) -> DataFrame:
    """One round from the given ranks: ``ranks(page, rank)`` of all pages."""
    return rank_pages(edges, damping, 1, ranks=ranks)


def rank_pages(
    edges: DataFrame | Graph,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    initial_rank: float = INITIAL_RANK,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """Ranks of all pages after a fixed number of rounds: ``ranks(page, rank)``.

    Rounds start from ``initial_rank``, or from ``ranks`` of an earlier run with one
    row per page, where sources without a row start from ``initial_rank``. Several
    runs over one graph can share what ``lay_out`` gives. The rank of a page without
    links is not handed on.

    The ranks of each round but the last are written, in the buckets that the next one reads, and those before removed.
    """
    graph = edges if isinstance(edges, Graph) else lay_out(edges)
    missing = float(initial_rank)
    current = None if ranks is None else graph.numbered_ranks(ranks)
    # Between rounds only pages with in-links have a row: any other source has one minus damping.
    for _ in range(1, int(iterations)):
        before, current = current, bucketed(rank_round(graph, current, missing, damping), "ranks", "number", graph.buckets)
        missing = 1.0 - clamp_damping(damping)
        if before is not None:
            forget(before)
    last = rank_round(graph, current, missing, damping)
    rank = F.coalesce("rank", F.lit(1.0 - clamp_damping(damping)))
    return graph.pages.join(last, "number", "left").select("page", rank.alias("rank"))


def number_ranks(ranks: DataFrame) -> DataFrame:
    """``order_ranks`` with the place of each row from 1: ``numbered(place, rank, page)``.

    The sorted ranks are stored with their place within their partition; only the sizes of the partitions are summed.
    """
    within = F.monotonically_increasing_id()
    ordered = stored(order_ranks(ranks).withColumn("_id", within), "ordered")
    ordered = ordered.withColumn("_partition", F.shiftright("_id", 33))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("_partition").agg(F.count("*").alias("_rows"))
    offsets = offsets.select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_id") - F.shiftleft("_partition", 33) + 1
    return ordered.join(offsets, "_partition").select(place.alias("place"), "rank", "page")


def order_ranks(ranks: DataFrame) -> DataFrame:
    """Ranks in ascending order, equal ones by page: the page also splits long runs of one rank."""
    return ranks.select("rank", "page").orderBy("rank", "page")
