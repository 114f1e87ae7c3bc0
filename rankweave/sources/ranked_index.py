"""The stored index with ranks, for the best results of a search: directories by term bucket, then by tier of rank.

A tier holds the documents whose rank is within a factor of two. Beside the postings lies, for each term and tier, the
largest count and rank in it: no document of the tier can score more than these allow.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.terms import Terms
from rankweave.operators.lookup import top_k
from rankweave.sources.index_table import BUCKET, BUCKETS, TERM_BUCKETS, bucket_folders, of_terms, subfolders, write_buckets

TIER = "tier"
TIERS = 16
POSTINGS, BOUNDS = "postings", "bounds"


def write_ranked_index(
    postings: DataFrame, ranks: DataFrame, path: str, mode: str = "errorifexists", buckets: int = TERM_BUCKETS, tiers: int = TIERS
) -> None:
    """Write ``postings(term, doc, tf)`` with ``ranks(page, rank)``; documents without a rank drop out, as in a search.

    Tier 0 has the ranks above half of the largest, the next those above a quarter, and the last all others.
    """
    largest = ranks.agg(F.max("rank").alias("rank")).first()["rank"] or 0.0
    halvings = F.floor(F.log2(F.lit(float(largest)) / F.col("rank")))
    tier = F.when(F.col("rank") > 0, F.least(halvings, F.lit(tiers - 1))).otherwise(tiers - 1).cast("int")
    ranked = postings.join(ranks, postings["doc"] == ranks["page"]).select("term", "doc", "tf", "rank", tier.alias(TIER))
    write_buckets(ranked, f"{path}/{POSTINGS}", mode, buckets, [TIER], ["doc"])
    written = postings.sparkSession.read.schema(_schema("doc string, ")).parquet(f"{path}/{POSTINGS}")
    bounds = written.groupBy("term", TIER).agg(F.max("tf").alias("tf"), F.max("rank").alias("rank"))
    write_buckets(bounds, f"{path}/{BOUNDS}", mode, buckets, [], [TIER])


def _schema(more: str = "") -> str:
    return f"term string, {more}tf bigint, rank double, {BUCKETS} int, {BUCKET} int, {TIER} int"


def tier_bounds(spark: SparkSession, path: str, terms: Terms | DataFrame) -> list[tuple[int, float]]:
    """Tiers that hold any of the terms, with the score that no document in them exceeds; the highest first."""
    folders = bucket_folders(spark, f"{path}/{BOUNDS}", terms)
    if not folders:
        return []
    stored = spark.read.schema(f"term string, {TIER} int, tf bigint, rank double, {BUCKETS} int, {BUCKET} int")
    found = of_terms(stored.option("basePath", f"{path}/{BOUNDS}").parquet(*folders), terms)
    bounds = found.groupBy(TIER).agg((F.sum("tf") * F.max("rank")).alias("bound")).collect()  # a row for each tier
    return sorted(((row[TIER], row["bound"]) for row in bounds), key=lambda tier: (-tier[1], tier[0]))


def _tiers(spark: SparkSession, path: str, terms: Terms | DataFrame) -> Iterator[tuple[float, DataFrame]]:
    """The bound and the results of each tier, opened when it is asked for."""
    folders = bucket_folders(spark, f"{path}/{POSTINGS}", terms)
    held = {folder: set(subfolders(spark, folder)) for folder in folders}
    for tier, bound in tier_bounds(spark, path, terms):
        opened = [f"{folder}/{TIER}={tier}" for folder in folders if f"{TIER}={tier}" in held[folder]]
        rows = spark.read.schema(_schema("doc string, ")).option("basePath", f"{path}/{POSTINGS}").parquet(*opened)
        hits = of_terms(rows, terms).groupBy("doc").agg(F.sum("tf").alias("tf"), F.max("rank").alias("rank"))
        yield bound, hits.select("doc", (F.col("rank") * F.col("tf")).alias("score"))


def search_top_k(spark: SparkSession, terms: Terms | DataFrame, path: str, k: int) -> DataFrame:
    """The ``k`` best ``results(doc, score)`` of a search, equal scores by document.

    A document lies in one tier. Tiers are read from the one with the highest bound on, and no more of them once ``k``
    results score more than the next bound; no row that cannot be among the best is read. Up to ``k`` rows are held.
    """
    best: list[tuple[float, str]] = []
    for bound, results in _tiers(spark, path, terms):
        if k < 1 or (len(best) >= k and -best[k - 1][0] > bound):
            break
        best += [(-row["score"], row["doc"]) for row in top_k(results, k).collect()]
        best = sorted(best, key=lambda found: (found[0], found[1].encode()))[:k]
    return spark.createDataFrame([(doc, -score) for score, doc in best], "doc string, score double")
