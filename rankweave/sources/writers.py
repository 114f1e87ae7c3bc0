"""Text sinks. Each ``*_lines`` forms ``lines(value)``; the matching ``write_*`` stores them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.operators.rank import order_ranks


def rank_state_lines(adjacency: DataFrame) -> DataFrame:
    return adjacency.select(F.concat_ws("\t", "page", "rank", F.array_join("links", ",")).alias("value"))


def write_rank_state(adjacency: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``page<tab>rank<tab>link,link`` lines."""
    rank_state_lines(adjacency).write.mode(mode).text(path)


def rank_lines(ranks: DataFrame) -> DataFrame:
    return ranks.select(F.concat_ws("\t", "rank", "page").alias("value"))


def write_ranks(ranks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``rank<tab>page`` lines, ascending through the part files in name order."""
    rank_lines(order_ranks(ranks)).write.mode(mode).text(path)


def posting_list_lines(lists: DataFrame) -> DataFrame:
    entries = F.transform("postings", lambda p: F.concat_ws(":", p["doc"], p["tf"]))
    return lists.select(F.concat("term", F.lit("\t"), F.array_join(entries, " "), F.lit(" ")).alias("value"))


def write_posting_lists(lists: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``term<tab>doc:tf doc:tf `` lines."""
    posting_list_lines(lists).write.mode(mode).text(path)


def hit_lines(hits: DataFrame) -> DataFrame:
    return hits.select(F.concat_ws("\t", "doc", "tf").alias("value"))


def write_hits(hits: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``doc<tab>total`` lines."""
    hit_lines(hits).write.mode(mode).text(path)


def result_lines(results: DataFrame) -> DataFrame:
    return results.select(F.concat_ws("\t", "doc", "score").alias("value"))


def write_results(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``doc<tab>score`` lines."""
    result_lines(results).write.mode(mode).text(path)
