"""Keyword search."""

from __future__ import annotations

import random
import shutil
from pathlib import Path

import pytest

from conftest import RANKS, rows
from rankweave import search
from rankweave.operators.lookup import lookup_terms, sum_hits, top_k
from rankweave.sources import index_table
from rankweave.sources.index_table import open_index, read_index, write_index
from rankweave.sources.ranked_index import search_top_k, tier_bounds, write_ranked_index


@pytest.fixture
def ranks(spark):
    return spark.createDataFrame([(page, r[1]) for page, r in RANKS.items()], "page string, rank double")


def scores(df):
    return {row["doc"]: row["score"] for row in df.collect()}


BETA = {"Alpha": 1.0030208333, "Beta": 1.084125, "Gamma_Ray": 0.34603125, "Café": 0.4184583333}
BETA_ALPHA = {**BETA, "Beta": 1.6261875}


@pytest.mark.parametrize(
    "terms, expected",
    [
        ("beta", BETA),
        ("beta alpha", BETA_ALPHA),
        ("  Alpha  BETA beta ", BETA_ALPHA),
        (["beta", "alpha"], BETA_ALPHA),
        ("aachen", {}),
        ("", {}),
        ("42", {}),
    ],
)
def test_fixture_scores(postings, ranks, terms, expected):
    assert scores(search(terms, postings, ranks)) == pytest.approx(expected, abs=1e-9)


def test_documents_without_rank_drop_out(postings, ranks):
    assert set(scores(search("beta", postings, ranks.where("page <> 'Beta'")))) == set(BETA) - {"Beta"}


def test_totals_are_long(spark):
    big = 2**31 - 1
    postings = spark.createDataFrame([("a", "d", big), ("b", "d", big)], "term string, doc string, tf bigint")
    assert rows(sum_hits(lookup_terms(postings, "a b"))) == [("d", 2 * big)]


def test_stored_index_is_pruned(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "index")
    write_index(postings, path)
    index = read_index(spark, path)
    assert scores(search("beta alpha", index, ranks)) == pytest.approx(BETA_ALPHA, abs=1e-9)
    plan = lookup_terms(index, "beta alpha")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert "PushedFilters: [In(term, [alpha,beta])]" in plan


def test_only_the_directories_of_the_terms_are_opened(spark, postings, ranks, tmp_path):
    path = tmp_path / "index"
    write_index(postings, str(path), buckets=8)
    opened = open_index(spark, str(path), "beta alpha")
    assert scores(search("beta alpha", opened, ranks)) == pytest.approx(BETA_ALPHA, abs=1e-9)
    folders = {Path(file).parent.name for file in opened.inputFiles()}
    assert len(folders) <= 2
    # The others may even be unreadable.
    for folder in (path / "buckets=8").iterdir():
        if folder.name not in folders:
            (folder / "part-broken.parquet").write_text("no parquet")
    assert scores(search("beta alpha", open_index(spark, str(path), "beta alpha"), ranks)) == pytest.approx(BETA_ALPHA, abs=1e-9)
    assert rows(open_index(spark, str(path), "!")) == []


def test_many_terms_are_joined(spark, postings, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    write_index(postings, path, buckets=8)
    few = rows(lookup_terms(open_index(spark, path, "beta alpha ray"), "beta alpha ray"))
    texts = spark.createDataFrame([("beta alpha",), ("Beta ray",), (None,), ("",)], "text string")
    assert rows(lookup_terms(open_index(spark, path, texts), texts)) == few
    monkeypatch.setattr(index_table, "MAX_FILTER_TERMS", 2)
    joined = lookup_terms(open_index(spark, path, "beta alpha ray"), "beta alpha ray")
    assert rows(joined) == few
    assert "LeftSemi" in joined._jdf.queryExecution().executedPlan().toString()


def ranked(spark, seed=1, docs=400):
    draw = random.Random(seed)
    names = [f"d{n:03}" for n in range(docs)]
    ranks = {name: round(0.15 + draw.paretovariate(1.0) * draw.choice([0, 1]), 3) for name in names} | {"d000": 0.0}
    found = [(term, name, draw.randint(1, 5)) for term in ("alpha", "beta", "ray") for name in names if draw.random() < 0.4]
    return (
        spark.createDataFrame(found, "term string, doc string, tf bigint"),
        spark.createDataFrame(list(ranks.items())[:-5], "page string, rank double"),
    )


@pytest.mark.parametrize("terms", ["alpha", "alpha beta ray", "none", ""])
def test_top_k_equals_a_sorted_search(spark, tmp_path, terms):
    postings, ranks = ranked(spark)
    path = str(tmp_path / "index")
    write_ranked_index(postings, ranks, path, buckets=4)
    ordered = sorted(scores(search(terms, postings, ranks)).items(), key=lambda found: (-found[1], found[0]))
    for k in (0, 1, 7, 50, 1000):
        assert [tuple(row) for row in search_top_k(spark, terms, path, k).collect()] == ordered[:k]
    assert [tuple(row) for row in top_k(search(terms, postings, ranks), 7).collect()] == ordered[:7]


def test_tiers_below_the_best_are_not_read(spark, tmp_path):
    postings, ranks = ranked(spark)
    path = tmp_path / "index"
    write_ranked_index(postings, ranks, str(path), buckets=4)
    best = [tuple(row) for row in search_top_k(spark, "alpha beta", str(path), 3).collect()]
    tiers = tier_bounds(spark, str(path), "alpha beta")
    needless = [tier for tier, bound in tiers if bound < best[-1][1]]
    assert len(needless) > 2
    for tier in needless:
        for folder in path.glob(f"postings/*/*/tier={tier}"):
            shutil.rmtree(folder)
            folder.mkdir()
            (folder / "part-broken.parquet").write_text("no parquet")
    assert [tuple(row) for row in search_top_k(spark, "alpha beta", str(path), 3).collect()] == best


def test_top_k_sorts_no_more_than_k(spark):
    postings, ranks = ranked(spark, docs=20)
    plan = top_k(search("alpha", postings, ranks), 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan and "rangepartitioning" not in plan
