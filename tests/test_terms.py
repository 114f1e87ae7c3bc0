"""Index terms, postings and posting lists."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import POSTINGS, rows
from rankweave.functions.terms import normalise_term, query_terms
from rankweave.operators import terms
from rankweave.operators.lists import long_keys
from rankweave.operators.pages import extract_pages
from rankweave.operators.terms import posting_lists, tokenize
from rankweave.plans.jobs import build_index
from rankweave.sources import index_table
from rankweave.sources.index_table import read_index, write_index
from rankweave.sources.readers import read_pages


def terms_of(text: str, delimiters: str = " '-") -> list[str]:
    words = re.split("[" + re.escape(delimiters) + "]", text)
    return [term for word in words if (term := re.sub("[^a-zA-Z]", "", word).lower())]


def test_fixture_postings(spark, dump):
    assert rows(build_index(extract_pages(read_pages(spark, dump)))) == POSTINGS


@pytest.mark.parametrize("delimiters", [" '-", " \n\t/", "]^\\-"])
def test_terms_of_random_text(spark, delimiters):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abCÀé 1'-\n\t/[]^\\.😀\u2028", k=draw.randint(0, 80))) for _ in range(1000)]
    pages = spark.createDataFrame([(str(n), text) for n, text in enumerate(texts)], "page string, text string")
    expected = sorted((term, str(n)) for n, text in enumerate(texts) for term in terms_of(text, delimiters))
    assert rows(tokenize(pages, delimiters)) == expected


def test_delimiters_must_not_be_letters(spark):
    pages = spark.createDataFrame([("a", "b")], "page string, text string")
    for delimiters in ["", "a ", "1"]:
        with pytest.raises(ValueError):
            tokenize(pages, delimiters)


def test_normalise_term(spark):
    df = spark.createDataFrame([("Café",), ("&quot;a",), ("42",)], "word string")
    assert [row.term for row in df.select(normalise_term(F.col("word")).alias("term")).collect()] == ["caf", "quota", ""]


def test_counts_add_up_and_titles_merge(spark):
    pages = spark.createDataFrame([("A", "x y x"), ("A", "x"), ("B", "x")], "page string, text string")
    index = build_index(pages)
    assert rows(index) == [("x", "A", 3), ("x", "B", 1), ("y", "A", 1)]
    assert index.agg(F.sum("tf")).first()[0] == tokenize(pages).count()


def test_null_and_empty_texts(spark):
    pages = spark.createDataFrame([("A", None), ("B", ""), ("C", " '- ")], "page string, text string")
    assert rows(build_index(pages)) == []


def test_query_terms():
    assert query_terms("  Café Ärger CAFÉ 42 ") == ["caf", "rger"]
    assert query_terms(["The", "the", ""]) == ["the"]


def test_posting_lists_are_sorted_and_whole(spark, postings):
    lists = posting_lists(postings)
    entries = {row["term"]: [tuple(p) for p in row["postings"]] for row in lists.collect()}
    assert entries["beta"] == [("Alpha", 2), ("Beta", 2), ("Café", 1), ("Gamma_Ray", 1)]
    assert lists.count() == len({term for term, _, _ in POSTINGS})


def test_frequent_term_is_split(spark):
    data = [("the", f"d{n}", 1) for n in range(3000)] + [(f"t{n}", f"d{n}", 2) for n in range(6000)]
    lists = posting_lists(spark.createDataFrame(data, "term string, doc string, tf bigint"), max_list=100)
    found = lists.collect()
    counts = Counter(row["term"] for row in found)
    assert counts["the"] == 30 and counts["t1"] == 1
    assert {row["part"] for row in found if row["term"] == "the"} == set(range(30))
    # Parts follow each other in the order of documents, and all but the last are full.
    parts = [[p["doc"] for p in row["postings"]] for row in sorted(found, key=lambda row: row["part"]) if row["term"] == "the"]
    assert {len(part) for part in parts} == {100} and sum(parts, []) == sorted(sum(parts, []))
    assert sorted((row["term"], p["doc"], p["tf"]) for row in found for p in row["postings"]) == sorted(data)


@pytest.mark.parametrize("partitions", [1, 16])
def test_index_with_any_number_of_partitions(spark, dump, conf, partitions):
    conf(shuffle__partitions=partitions)
    assert rows(build_index(extract_pages(read_pages(spark, dump)))) == POSTINGS


@pytest.mark.parametrize("partitions", [2, 32])
def test_lists_do_not_depend_on_partitions(spark, conf, partitions):
    data = [("the", f"d{n}", 1) for n in range(500)]
    df = spark.createDataFrame(data, "term string, doc string, tf bigint")
    conf(shuffle__partitions=1)
    expected = rows(posting_lists(df, max_list=50))
    conf(shuffle__partitions=partitions)
    assert rows(posting_lists(df, max_list=50)) == expected


def test_keywords_are_cut_like_the_text():
    assert query_terms("That's Jean-Louis don't") == ["that", "s", "jean", "louis", "don", "t"]
    assert query_terms(["that's", "The"]) == ["that", "s", "the"]


def test_stored_index(spark, postings, tmp_path):
    path = str(tmp_path / "index")
    write_index(postings, path, buckets=7)
    assert {row["buckets"] for row in read_index(spark, path).collect()} == {7}
    assert rows(read_index(spark, path).select("term", "doc", "tf")) == POSTINGS
    with pytest.raises(Exception, match="already exists"):
        write_index(postings, path)


def test_counting_combines_before_its_one_shuffle(spark):
    pages = spark.createDataFrame([("A", "x")], "page string, text string")
    plan = build_index(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert plan.count("regexp_replace") == 1


def test_words_of_files_are_counted_where_their_page_is(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(terms, "COUNT_BYTES", 100, raising=False)
    pages = [("A", "x y x"), ("B", "x"), ("A", "x z")]
    spark.createDataFrame(pages, "page string, text string").write.parquet(str(tmp_path / "pages"))
    index = build_index(spark.read.parquet(str(tmp_path / "pages")))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") > plan.index("Generate")
    assert rows(index) == [("x", "A", 3), ("x", "B", 1), ("y", "A", 1), ("z", "A", 1)]


def test_index_is_written_in_as_many_files_as_its_rows_need(spark, postings, tmp_path, monkeypatch):
    monkeypatch.setattr(index_table, "RANGE_ROWS", 5, raising=False)
    write_index(postings, str(tmp_path / "index"), buckets=1)
    assert len(list((tmp_path / "index").rglob("*.parquet"))) >= 5
    assert rows(read_index(spark, str(tmp_path / "index")).select("term", "doc", "tf")) == rows(postings)


def test_long_keys_are_stored_as_files(spark, postings):
    long = long_keys(postings, "term", F.lit(1), 1)
    assert long.inputFiles()
    assert rows(long) == sorted((term, n) for term, n in Counter(p[0] for p in POSTINGS).items() if n > 1)
