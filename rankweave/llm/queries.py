"""The numbered operators as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm.embeddings import link_embeddings
from rankweave.llm.extraction import extract_text
from rankweave.llm.jaccard import join_similar
from rankweave.llm.merkle import fold, leaf_hash, merkle_manifest
from rankweave.llm.mixing import mix_sources
from rankweave.llm.negatives import mine_hard_negatives
from rankweave.llm.oracles import ORACLES
from rankweave.llm.packing import pack
from rankweave.llm.quality import judge_quality
from rankweave.llm.secrets import scan_secrets
from rankweave.llm.substrings import dedup_substrings
from rankweave.llm.suffixes import dedup_repeats
from rankweave.llm.toxicity import score_toxicity
from rankweave.llm.url_filter import filter_urls
from rankweave.plans.table_inputs import table

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def tokenizer_files() -> dict[str, str]:
    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), **tokenizer_files())


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents")).drop("class_distance", "word_distance")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_substrings(table(spark, folder, "documents"))


def op8_embedding_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(table(spark, folder, "embeddings"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"), URL_RULES)


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_similar(table(spark, folder, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "copy_id", "kept")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").where(fine).select(
        "vec_id", label.alias("label"), F.transform(x, lambda v: F.floor(v * 256)).alias("vector")
    )
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.try_add("n_chars", F.lit(1)) if c == "n_chars" else F.col(c) for c in columns]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_hash(tampered))
    rows = merkle_manifest(table(spark, folder, "documents"), columns, tree="lang", order="doc_id", keep={"changed": changed})
    subroot = fold(F.coalesce("changed", "leaf"), F.col("place"), F.col("n"), F.col("siblings"))
    folded = rows.withColumn("folded_subroot", subroot)
    root = fold(F.col("folded_subroot"), F.col("top_place"), F.col("top_n"), F.col("top_siblings"))
    folded = folded.withColumn("folded_root", root)
    proof = F.sha2(F.concat("siblings", "top_siblings"), 256)
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


QUERIES = {
    query.__name__: query
    for query in [
        op1_secret_scans,
        op2_toxicity,
        op3_html_extraction,
        op4_packing,
        op5_mixing,
        op6_quality,
        op7_substring_dedup,
        op8_embedding_neighbours,
        op9_url_filter,
        op10_jaccard_join,
        op11_hard_negatives,
        op12_merkle_manifest,
        op13_suffix_dedup,
    ]
}

__all__ = ["ORACLES", "QUERIES", "tokenizer_files"]
