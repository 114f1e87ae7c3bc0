"""The inverted index: one row per term occurrence, then one per term and document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.terms import DELIMITERS, split_terms
from rankweave.operators.lists import LIST_ENTRIES, collect_items
from rankweave.runtime import input_bytes, shuffle_partitions

# Bytes of the files of the pages for each task that counts: they bound the terms it holds at a time.
COUNT_BYTES = 8 << 20


def tokenize(pages: DataFrame, delimiters: str = DELIMITERS) -> DataFrame:
    """``pages(page, text)`` to ``tokens(term, doc)``, one row per occurrence."""
    words = split_terms(F.col("text"), delimiters)
    return (
        pages.select(F.col("page").alias("doc"), F.explode(words).alias("term"))
        .where(F.col("term") != "")
        .select("term", "doc")
    )


def count_terms(tokens: DataFrame) -> DataFrame:
    """``tokens(term, doc)`` to ``postings(term, doc, tf)``.

    The key is the pair, so a term that is everywhere spreads over all partitions. Counts are combined before the
    shuffle, or need none if the tokens are those of pages spread ``by_page``.
    """
    return tokens.groupBy("term", "doc").agg(F.count("*").alias("tf"))


def by_page(pages: DataFrame) -> DataFrame:
    """Pages spread by name, in as many parts as keep the terms of each few; rows of one name lie in one part.

    So the words of a page are counted where they are, and the texts are shuffled in place of their words.
    """
    parts = input_bytes(pages) // COUNT_BYTES
    return pages.repartition(max(parts, shuffle_partitions(pages.sparkSession)), "page") if parts > 1 else pages


def posting_lists(postings: DataFrame, max_list: int = LIST_ENTRIES) -> DataFrame:
    """``postings`` to ``posting_lists(term, part, postings)`` for export, each list sorted by document.

    A term has one row of ``part`` 0 unless it has more than ``max_list`` postings.
    The input is read twice, so pass a stored index.
    """
    return collect_items(postings, "term", ["doc", "tf"], "postings", max_list).select("term", "part", "postings")
