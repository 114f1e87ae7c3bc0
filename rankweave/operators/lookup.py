"""Keyword search over the inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.terms import Terms
from rankweave.sources.index_table import of_terms


def lookup_terms(postings: DataFrame, terms: Terms | DataFrame) -> DataFrame:
    """Postings of any of the terms: a keyword string, a list, or a DataFrame of texts; a repeated one counts once.

    A few terms become a filter on the scan, and on a stored index they also pick
    the directories to read. Many are joined.
    """
    return of_terms(postings, terms).select("term", "doc", "tf")


def sum_hits(found: DataFrame) -> DataFrame:
    """Occurrences of all matched terms per document: ``hits(doc, tf)``."""
    return found.groupBy("doc").agg(F.sum("tf").alias("tf"))


def score_hits(hits: DataFrame, ranks: DataFrame) -> DataFrame:
    """Occurrences times rank: ``results(doc, score)``; documents without a rank drop out."""
    return hits.join(ranks, hits["doc"] == ranks["page"]).select(
        "doc", (F.col("rank") * F.col("tf")).alias("score")
    )


def top_k(results: DataFrame, k: int) -> DataFrame:
    """The ``k`` results of the highest scores, equal ones by document. Each task keeps no more than ``k``."""
    return results.orderBy(F.desc("score"), "doc").limit(int(k))
