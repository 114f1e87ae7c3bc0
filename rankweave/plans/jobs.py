"""The three jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankweave.functions.terms import Terms
from rankweave.operators.lookup import lookup_terms, score_hits, sum_hits
from rankweave.operators.pages import extract_links, extract_pages
from rankweave.operators.rank import DAMPING, INITIAL_RANK, ITERATIONS, order_ranks, rank_pages
from rankweave.operators.terms import by_page, count_terms, posting_lists, tokenize
from rankweave.sources import readers, writers
from rankweave.sources.index_table import open_index, write_index


def link_rank(
    source: DataFrame,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    initial_rank: float = INITIAL_RANK,
) -> DataFrame:
    """Ranks of ``pages(page, text)`` or ``edges(src, dst)`` in ascending order: ``(rank, page)``."""
    edges = source if {"src", "dst"} <= set(source.columns) else extract_links(source)
    return order_ranks(rank_pages(edges, damping, iterations, initial_rank))


def build_index(pages: DataFrame) -> DataFrame:
    """``pages(page, text)`` to ``postings(term, doc, tf)``."""
    return count_terms(tokenize(by_page(pages)))


def search(terms: Terms | DataFrame, postings: DataFrame, ranks: DataFrame) -> DataFrame:
    """``results(doc, score)`` of the documents that hold any term."""
    return score_hits(sum_hits(lookup_terms(postings, terms)), ranks)


def rank_dump(
    spark: SparkSession,
    dump: str,
    output: str,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    initial_rank: float = INITIAL_RANK,
) -> None:
    """Rank the pages of a dump into ``rank<tab>page`` text files; an earlier output is replaced."""
    edges = extract_links(extract_pages(readers.read_pages(spark, dump)))
    writers.write_ranks(rank_pages(edges, damping, iterations, initial_rank), output)


def rank_edge_list(
    spark: SparkSession,
    edge_list: str,
    output: str,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    initial_rank: float = INITIAL_RANK,
) -> None:
    """Like ``rank_dump`` for ``src<tab>dst`` text files."""
    edges = readers.read_edge_list(spark, edge_list)
    writers.write_ranks(rank_pages(edges, damping, iterations, initial_rank), output)


def index_dump(spark: SparkSession, dump: str, output: str) -> None:
    """Index a dump into the stored form that ``read_index`` opens."""
    write_index(build_index(extract_pages(readers.read_pages(spark, dump))), output)


def export_index(postings: DataFrame, output: str) -> None:
    """Write a stored index as posting-list text files."""
    writers.write_posting_lists(posting_lists(postings), output)


def search_index(spark: SparkSession, terms: Terms, index: str, ranks: str, output: str) -> None:
    """Search a stored index with rank text files into ``doc<tab>score`` text files; reads only what the terms need."""
    postings = open_index(spark, index, terms)
    writers.write_results(search(terms, postings, readers.read_ranks(spark, ranks)), output)


def search_files(spark: SparkSession, terms: Terms, index: str, ranks: str, output: str) -> None:
    """Like ``search_index`` on posting-list text files, all of which it reads."""
    postings = readers.read_posting_lists(spark, index)
    writers.write_results(search(terms, postings, readers.read_ranks(spark, ranks)), output)
