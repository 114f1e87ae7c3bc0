"""Text forms: exact lines, and reading back what was written."""

from __future__ import annotations

from pathlib import Path

import pytest

from conftest import EDGES, POSTINGS, RANKS, dump_text, rows
from rankweave.operators.rank import adjacency_edges, adjacency_ranks, init_ranks, rank_pages
from rankweave.operators.terms import posting_lists
from rankweave.plans import jobs
from rankweave.sources import readers, writers
from rankweave.sources.index_table import read_index, write_index


def lines_of(path) -> list[str]:
    files = sorted(Path(path).glob("part-*"))
    return [line for file in files for line in file.read_text(encoding="utf-8").splitlines()]


def test_edge_list(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("# a\tb\na\tb\nb\tc\td\n\n#\nno tab\n c \t\n", encoding="utf-8")
    edges = readers.read_edge_list(spark, str(tmp_path / "edges.txt"))
    assert rows(edges) == [(" c ", ""), ("a", "b"), ("b", "c\td")]


def test_ranks_of_an_edge_list(spark, tmp_path):
    text = "# comment\n" + "".join(f"{src}\t{dst}\n" for src, dst in EDGES)
    (tmp_path / "edges.txt").write_text(text, encoding="utf-8")
    jobs.rank_edge_list(spark, str(tmp_path / "edges.txt"), str(tmp_path / "ranks"), iterations=3)
    ranks = dict(rows(readers.read_ranks(spark, str(tmp_path / "ranks"))))
    assert ranks == pytest.approx({page: r[2] for page, r in RANKS.items()}, abs=1e-9)


def test_rank_state(spark, edges, tmp_path):
    path = str(tmp_path / "state")
    writers.write_rank_state(init_ranks(edges), path)
    assert sorted(lines_of(path))[0] == "Alpha\t0.85\tBeta,Beta,Gamma_Ray"
    state = readers.read_rank_state(spark, path)
    assert rows(adjacency_edges(state)) == sorted(EDGES)
    resumed = rank_pages(adjacency_edges(state), iterations=2, ranks=adjacency_ranks(state))
    assert {r["page"]: r["rank"] for r in resumed.collect()} == pytest.approx(
        {page: r[1] for page, r in RANKS.items()}, abs=1e-9
    )


def test_rank_state_without_links(spark, tmp_path):
    (tmp_path / "state").write_text("a\t0.5\tb\nb\t1.5E-1\t\nc\t0.2\n")
    state = readers.read_rank_state(spark, str(tmp_path / "state"))
    assert rows(state) == [("a", 0.5, ["b"]), ("b", 0.15, []), ("c", 0.2, [])]


def test_ranks_are_written_in_order(spark, tmp_path):
    path = str(tmp_path / "ranks")
    ranks = [(f"p{n}", float(n * 7919 % 1000)) for n in range(2000)]
    writers.write_ranks(spark.createDataFrame(ranks, "page string, rank double"), path)
    assert lines_of(path) == [f"{rank}\t{page}" for rank, page in sorted((r, p) for p, r in ranks)]
    assert rows(readers.read_ranks(spark, path)) == sorted(ranks)


def test_ranks_replace_an_earlier_output(spark, tmp_path):
    path = str(tmp_path / "ranks")
    for rank in [1.0, 2.0]:
        writers.write_ranks(spark.createDataFrame([("a", rank)], "page string, rank double"), path)
    assert lines_of(path) == ["2.0\ta"]


def test_posting_lists(spark, postings, tmp_path):
    path = str(tmp_path / "lists")
    writers.write_posting_lists(posting_lists(postings), path)
    assert "beta\tAlpha:2 Beta:2 Café:1 Gamma_Ray:1 " in lines_of(path)
    assert rows(readers.read_posting_lists(spark, path)) == POSTINGS
    with pytest.raises(Exception, match="already exists"):
        writers.write_posting_lists(posting_lists(postings), path)


def test_hits_and_results(spark, tmp_path):
    hits = spark.createDataFrame([("Café", 3), ("B", 2**40)], "doc string, tf bigint")
    writers.write_hits(hits, str(tmp_path / "hits"))
    assert sorted(lines_of(tmp_path / "hits")) == [f"B\t{2**40}", "Café\t3"]
    assert rows(readers.read_hits(spark, str(tmp_path / "hits"))) == [("B", 2**40), ("Café", 3)]
    results = spark.createDataFrame([("Café", 0.5), ("B", 2.0)], "doc string, score double")
    writers.write_results(results, str(tmp_path / "results"))
    assert sorted(lines_of(tmp_path / "results")) == ["B\t2.0", "Café\t0.5"]


def test_all_jobs_over_files(spark, dump, tmp_path):
    ranks, index, lists, results = (str(tmp_path / name) for name in ("ranks", "index", "lists", "results"))
    jobs.rank_dump(spark, dump, ranks)
    jobs.index_dump(spark, dump, index)
    jobs.export_index(read_index(spark, index), lists)
    jobs.search_files(spark, "alpha beta", lists, ranks, results)
    scores = dict(line.split("\t") for line in lines_of(results))
    assert {doc: float(score) for doc, score in scores.items()} == pytest.approx(
        {"Alpha": 1.0030208333, "Beta": 1.6261875, "Gamma_Ray": 0.34603125, "Café": 0.4184583333}, abs=1e-9
    )


def test_terms_are_looked_up_before_lists_are_split(spark, tmp_path):
    (tmp_path / "lists").write_text("beta\tA:1 B:2 \n")
    found = readers.read_posting_lists(spark, str(tmp_path / "lists")).where("term IN ('beta')")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("beta")
    assert rows(found) == [("beta", "A", 1), ("beta", "B", 2)]


def test_large_dump_splits_like_a_small_one(spark, tmp_path, conf):
    pages = [(f"Page {n}", f"[[Page {n // 2}]] [[Page {n // 3}]] word{'abc'[n % 3]}") for n in range(2000)]
    (tmp_path / "dump.xml").write_text(dump_text(pages), encoding="utf-8")
    jobs.rank_dump(spark, str(tmp_path / "dump.xml"), str(tmp_path / "whole"))
    conf(files__maxPartitionBytes=5000, shuffle__partitions=3)
    jobs.rank_dump(spark, str(tmp_path / "dump.xml"), str(tmp_path / "split"))
    whole, split = (dict(rows(readers.read_ranks(spark, str(tmp_path / name)))) for name in ("whole", "split"))
    assert split == pytest.approx(whole, abs=1e-9)


def test_lines_without_a_number_are_skipped(spark):
    lines = spark.createDataFrame([("x\tp",), ("1.5\tq",), ("none",)], "value string")
    assert rows(readers.parse_ranks(lines)) == [("q", 1.5)]
    lines = spark.createDataFrame([("t\ta:b:1 a:c:2 d:x e",)], "value string")
    assert rows(readers.parse_posting_lists(lines)) == [("t", "a:b", 1), ("t", "a:c", 2)]


def test_search_over_the_stored_index(spark, postings, tmp_path):
    index, ranks, found = (str(tmp_path / name) for name in ("index", "ranks", "found"))
    write_index(postings, index)
    writers.write_ranks(spark.createDataFrame([("Alpha", 2.0), ("Beta", 3.0)], "page string, rank double"), ranks)
    jobs.search_index(spark, "beta", index, ranks, found)
    assert sorted(row["value"] for row in spark.read.text(found).collect()) == ["Alpha\t4.0", "Beta\t6.0"]


def test_posting_lines_are_cut_once_a_line(spark):
    lines = spark.createDataFrame([("t\ta:1 b:2 ",), ("u\tc:3 ",)], "value string")
    found = readers.parse_posting_lists(lines)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "value" not in above
    assert rows(found) == [("t", "a", 1), ("t", "b", 2), ("u", "c", 3)]
