"""Rank rounds against a plain model, and the plans they run with."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import EDGES, RANKS, rows
from rankweave.operators import rank
from rankweave.plans.jobs import link_rank


def ranks_of(edges, iterations, damping=0.85, start=0.85):
    """Plain rounds over an edge list."""
    degree = Counter(src for src, _ in edges)
    nodes = {node for edge in edges for node in edge}
    ranks = dict.fromkeys(nodes, start)
    for _ in range(iterations):
        sums = defaultdict(float)
        for src, dst in edges:
            sums[dst] += ranks[src] / degree[src]
        ranks = {node: damping * sums[node] + (1 - damping) for node in nodes}
    return ranks


def found(df):
    return {row["page"]: row["rank"] for row in df.collect()}


def random_edges(seed, nodes=60, links=600):
    draw = random.Random(seed)
    return [(f"n{draw.randint(0, nodes // 2)}", f"n{draw.randint(0, nodes)}") for _ in range(links)]


def hub_edges():
    """A third of all links leave one page, a third enter one, and a third are copies of one."""
    out = [("hub", f"t{n}") for n in range(4000)]
    into = [(f"s{n}", "sink") for n in range(4000)] + [("sink", "hub"), ("t1", "hub")]
    return out + into + [("x", "hub")] * 4000


@pytest.mark.parametrize("iterations", [1, 2, 3])
def test_fixture_ranks(edges, iterations):
    ranks = found(rank.rank_pages(edges, iterations=iterations))
    assert ranks == pytest.approx({page: r[iterations - 1] for page, r in RANKS.items()}, abs=1e-9)


@pytest.mark.parametrize("iterations, damping", [(1, 0.85), (4, 0.5), (7, 0.85), (12, 1.0), (3, 0.0)])
def test_random_graph(spark, iterations, damping):
    edges = random_edges(iterations)
    ranks = rank.rank_pages(spark.createDataFrame(edges, "src string, dst string"), damping, iterations)
    assert found(ranks) == pytest.approx(ranks_of(edges, iterations, damping), abs=1e-12)


@pytest.mark.parametrize("iterations", [1, 3, 6])
def test_links_of_a_hub_are_kept_apart_and_ranks_stay(spark, iterations):
    edges = hub_edges()
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"))
    hubs = graph.hubs.join(graph.pages, F.col("hub") == F.col("number"))
    assert rows(hubs.select("page", "out")) == [("hub", 4000)]
    assert graph.heavy.count() == 4000
    sizes = [row["count"] for row in graph.light.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000
    ranks = rank.rank_pages(graph, iterations=iterations)
    assert found(ranks) == pytest.approx(ranks_of(edges, iterations), abs=1e-9)


@pytest.mark.parametrize("bits", [62, 4, 1])
def test_pages_that_share_a_hash_have_numbers_of_their_own(spark, bits):
    edges = random_edges(8)
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"), bits=bits)
    pages = graph.pages.collect()
    assert len({row["number"] for row in pages}) == len(pages) == len({node for edge in edges for node in edge})
    assert sum(row["number"] >= 0 for row in pages) <= 2**bits
    assert rows(graph.named_links()) == sorted((*edge, n) for edge, n in Counter(edges).items())
    assert found(rank.rank_pages(graph, iterations=3)) == pytest.approx(ranks_of(edges, 3), abs=1e-12)


def test_empty_graph(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    assert rows(rank.rank_pages(empty)) == []
    assert rows(rank.init_ranks(empty)) == []


def test_self_links_and_dangling_pages(spark):
    edges = [("a", "a"), ("a", "b"), ("c", "a")]
    ranks = rank.rank_pages(spark.createDataFrame(edges, "src string, dst string"), iterations=4)
    assert found(ranks) == pytest.approx(ranks_of(edges, 4), abs=1e-12)
    assert "" not in found(ranks)


def test_rank_sum_without_dangling_pages(spark):
    edges = [(f"n{n}", f"n{n * 7 % 50}") for n in range(50)] + [(f"n{n}", f"n{n * 3 % 50}") for n in range(50)]
    df = spark.createDataFrame(edges, "src string, dst string")
    before = sum(found(rank.rank_pages(df, iterations=2)).values())
    after = sum(found(rank.rank_pages(df, iterations=3)).values())
    assert after == pytest.approx(0.85 * before + 50 * 0.15)
    assert min(found(rank.rank_pages(df, iterations=3)).values()) >= 0.15 - 1e-12


def test_resume_equals_one_run(spark):
    edges = random_edges(3)
    df = spark.createDataFrame(edges, "src string, dst string")
    resumed = rank.rank_pages(df, iterations=2, ranks=rank.rank_pages(df, iterations=3))
    assert found(resumed) == pytest.approx(ranks_of(edges, 5), abs=1e-12)


def test_step_equals_one_round(edges):
    start = rank.node_set(edges).withColumn("rank", F.lit(0.85))
    assert found(rank.rank_step(edges, start)) == pytest.approx({p: r[0] for p, r in RANKS.items()}, abs=1e-9)


def test_contributions_of_one_round(spark, edges):
    ranks = spark.createDataFrame([("Alpha", 3.0), ("Beta", 1.0)], "page string, rank double")
    handed = rows(rank.contributions(rank.lay_out(edges), ranks, missing=4.0))
    assert handed == sorted(
        [("Beta", 2.0), ("Gamma_Ray", 1.0), ("Alpha", 0.5), ("Café", 0.5)]
        + [(page, 1.0) for page in ("Alpha", "A|b", "1", "_Delta_")]
    )


def test_parameters_are_clamped(spark):
    edges = random_edges(5)
    df = spark.createDataFrame(edges, "src string, dst string")
    assert found(rank.rank_pages(df, damping=7, iterations=-3)) == pytest.approx(ranks_of(edges, 1, 1.0))
    assert found(rank.rank_pages(df, damping=-1)) == pytest.approx(ranks_of(edges, 2, 0.0))


def test_degrees_and_nodes(edges):
    assert rows(rank.out_degree(edges)) == [("Alpha", 3), ("Beta", 2), ("Gamma_Ray", 4)]
    assert [page for (page,) in rows(rank.node_set(edges))] == sorted(RANKS)


def test_adjacency_keeps_duplicates(edges):
    adjacency = {row["page"]: row["links"] for row in rank.init_ranks(edges).collect()}
    assert adjacency["Alpha"] == ["Beta", "Beta", "Gamma_Ray"]
    assert rows(rank.adjacency_edges(rank.init_ranks(edges))) == sorted(EDGES)


def test_adjacency_of_a_hub_is_split(spark, conf):
    edges = hub_edges()
    adjacency = rank.init_ranks(spark.createDataFrame(edges, "src string, dst string"), max_list=50)
    sizes = Counter({})
    for row in adjacency.collect():
        assert len(row["links"]) < 4 * 50
        sizes[row["page"]] += 1
    assert sizes["hub"] > 1 and sizes["x"] > 1 and sizes["s1"] == 1
    assert rows(rank.adjacency_edges(adjacency)) == sorted(edges)


@pytest.mark.parametrize("max_list", [rank.LIST_ENTRIES, 50])
def test_rank_state_between_rounds(spark, max_list):
    edges = hub_edges()
    df = spark.createDataFrame(edges, "src string, dst string")
    state = rank.rank_state(df, rank.rank_pages(df), max_list)
    assert rows(rank.adjacency_edges(state)) == sorted(edges)
    assert found(state) == pytest.approx(ranks_of(edges, 2), abs=1e-9)
    counts = Counter(row["page"] for row in state.select("page").collect())
    assert set(counts) == {page for edge in edges for page in edge}
    assert (counts["hub"] > 1) == (max_list == 50) and counts["t1"] == 1
    assert state.where("page = 't2'").first()["links"] == []
    resumed = rank.rank_pages(rank.adjacency_edges(state), iterations=1, ranks=rank.adjacency_ranks(state))
    assert found(resumed) == pytest.approx(ranks_of(edges, 3), abs=1e-9)


def test_order(edges):
    ordered = [(row["rank"], row["page"]) for row in link_rank(edges).collect()]
    assert ordered == sorted(ordered)
    assert len(ordered) == len(RANKS)


def test_link_rank_takes_pages(spark, dump):
    from rankweave.operators.pages import extract_pages
    from rankweave.sources.readers import read_pages

    ranks = {row["page"]: row["rank"] for row in link_rank(extract_pages(read_pages(spark, dump))).collect()}
    assert ranks == pytest.approx({page: r[1] for page, r in RANKS.items()}, abs=1e-9)


@pytest.mark.parametrize("partitions", [1, 3, 32])
def test_any_number_of_partitions(spark, conf, partitions):
    conf(shuffle__partitions=partitions)
    edges = random_edges(11)
    ranks = rank.rank_pages(spark.createDataFrame(edges, "src string, dst string"), iterations=3)
    assert found(ranks) == pytest.approx(ranks_of(edges, 3), abs=1e-12)


def test_lists_do_not_depend_on_partitions(spark, conf):
    df = spark.createDataFrame(hub_edges(), "src string, dst string")
    seen = []
    for partitions in (1, 2, 32):
        conf(shuffle__partitions=partitions)
        seen.append(rows(rank.init_ranks(df, max_list=50).select("page", "part", "links")))
    assert seen[0] == seen[1] == seen[2]


def test_state_takes_the_graph_of_its_ranks(spark, edges):
    graph = rank.lay_out(edges)
    ranks = rank.rank_pages(graph)
    assert rows(rank.rank_state(graph, ranks)) == rows(rank.rank_state(edges, ranks))


def test_places_follow_the_order(spark, conf):
    conf(shuffle__partitions=5)
    ranks = spark.createDataFrame([(f"p{n}", float(n % 7)) for n in range(300)], "page string, rank double")
    numbered = sorted(tuple(row) for row in rank.number_ranks(ranks).collect())
    assert [place for place, _, _ in numbered] == list(range(1, 301))
    assert [row[1:] for row in numbered] == sorted((r, p) for p, r in ranks.collect())


def round_plan(spark, edges):
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"))
    ranks = graph.numbered_ranks(graph.pages.select("page", F.lit(1.0).alias("rank")))
    plan = rank.rank_round(graph, ranks, 0.15, 0.85)._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?|_[0-9a-f]{32}|run-\w+|plan_id=\d+|\[file:[^]]*\]", "", plan)


def test_each_round_shuffles_only_contributions(spark, conf):
    conf(autoBroadcastJoinThreshold=-1)
    plan = round_plan(spark, random_edges(2))
    assert plan.replace("BroadcastExchange", "").count("Exchange") == 1
    # The ranks of a bucket are hashed: neither they nor the links are sorted. Only hubs and their ranks are broadcast.
    assert plan.count("Sort [") == 0 and plan.count("ShuffledHashJoin") == 1 and plan.count("BroadcastExchange") == 2


def test_adaptive_execution_stays_on(spark):
    assert "AdaptiveSparkPlan" in round_plan(spark, random_edges(2))


def test_the_plan_is_the_same_with_and_without_hubs(spark, conf):
    conf(autoBroadcastJoinThreshold=-1)
    assert round_plan(spark, hub_edges()) == round_plan(spark, random_edges(2))


def test_the_names_of_ranks_are_found_without_a_shuffle(spark, conf):
    conf(autoBroadcastJoinThreshold=-1)
    graph = rank.lay_out(spark.createDataFrame(random_edges(2), "src string, dst string"))
    plan = rank.rank_pages(graph, iterations=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.replace("BroadcastExchange", "").count("Exchange") == 1


def test_ranks_of_earlier_rounds_are_removed(spark):
    graph = rank.lay_out(spark.createDataFrame(random_edges(2), "src string, dst string"))
    before = {t.name for t in spark.catalog.listTables()}
    ranks = rank.rank_pages(graph, iterations=6)
    assert len({t.name for t in spark.catalog.listTables()} - before) == 1
    assert found(ranks) == pytest.approx(ranks_of(random_edges(2), 6), abs=1e-12)


def test_links_are_named_by_one_shuffle(spark, conf):
    conf(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    edges = hub_edges()
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"))
    named = graph.named_links()
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert rows(named) == sorted((*edge, n) for edge, n in Counter(edges).items())


def test_names_and_copies_of_a_state_are_not_stored(spark, monkeypatch):
    names = []
    keep = rank.stored
    monkeypatch.setattr(rank, "stored", lambda df, name: names.append(name) or keep(df, name))
    edges = hub_edges()
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"))
    state = rank.rank_state(graph, rank.rank_pages(graph), 50)
    assert "links" not in names
    assert rows(rank.adjacency_edges(state)) == sorted(edges)


def test_many_names_that_share_a_hash_are_joined_without_a_sort(spark, conf, monkeypatch):
    conf(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    monkeypatch.setattr(rank, "BROADCAST_NAMES", 0, raising=False)
    edges = random_edges(9) + [("n1", "n2")] * 2000
    df = spark.createDataFrame(edges, "src string, dst string")
    written = []
    keep = rank.bucketed
    monkeypatch.setattr(rank, "bucketed", lambda df, name, *a: written.append((name, df)) or keep(df, name, *a))
    graph = rank.lay_out(df, bits=2)
    light = dict(written)["light"]._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in light and "SortMergeJoin" not in light
    assert rows(graph.named_links()) == sorted((*edge, n) for edge, n in Counter(edges).items())
    assert found(rank.rank_pages(graph, iterations=4)) == pytest.approx(ranks_of(edges, 4), abs=1e-12)


def test_a_page_without_a_name_is_a_page(spark):
    edges = [(None, "a"), ("a", None), ("a", "b")] + [(None, "b")] * 3000
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"))
    assert found(rank.rank_pages(graph, iterations=3)) == pytest.approx(ranks_of(edges, 3), abs=1e-12)


def test_pages_that_share_a_number_do_not_multiply_links(spark):
    # A page without a name keeps the number of its hash, even where it shares it.
    edges = [(None, "a"), ("a", None), ("a", "b"), ("b", "a")]
    graph = rank.lay_out(spark.createDataFrame(edges, "src string, dst string"), bits=1)
    out = graph.light.unionByName(graph.heavy).groupBy("src").agg(F.sum("copies").alias("copies"), F.sum("weight").alias("weight"))
    assert sum(row["copies"] for row in out.collect()) == 4
    assert [row["weight"] for row in out.collect()] == pytest.approx([1.0] * out.count())
