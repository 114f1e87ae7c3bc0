"""From raw documents to packed training sequences, in five stages.

Each stage takes all that its predecessor kept and its decisions take effect: rejected documents and near copies go,
secrets are replaced in the text, documents are left out or repeated to meet the mix, and what remains is packed. All
but the last return the columns they were given. Nulls, empty texts, repeated rows and empty tables are treated as the
operators' docstrings say; columns that happen to have an operator's internal names are carried through unharmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm.jaccard import join_similar
from rankweave.llm.mixing import mix_sources
from rankweave.llm.packing import pack
from rankweave.llm.quality import judge_quality
from rankweave.llm.queries import tokenizer_files
from rankweave.llm.secrets import redacted, scan_secrets
from rankweave.plans.table_inputs import table
from rankweave.runtime import stored


def _boxed(docs: DataFrame) -> DataFrame:
    """All columns as one, beside those that the operators read."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text", "lang", "source")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge_quality(_boxed(docs), keep=["doc"]).where("kept").select("doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id out of each group of near copies; of equal rows, one."""
    heads = stored(join_similar(docs.select("doc_id", "text")).where("kept").select("row").distinct(), "heads")
    keyed = _boxed(docs).select("doc", F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("row"))
    return keyed.join(heads, "row").dropDuplicates(["row"]).select("doc.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for each secret; ``n_chars`` follows the text."""
    found = scan_secrets(_boxed(docs), keep=["doc"])
    changed = found.select("doc", "spans", redacted(F.col("doc.text"), F.col("spans")).alias("cleaned"))
    length = F.when(F.col("spans") == "", F.col("doc.n_chars")).otherwise(F.length("cleaned"))
    new = {"text": F.col("cleaned"), "n_chars": length.cast(docs.schema["n_chars"].dataType)}
    return changed.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit("")), "source").alias("row")
    mixed = mix_sources(docs.select(row, "text", "source"), doc_id="row")
    copies = stored(mixed.groupBy("doc_id").agg(F.sum("copies").alias("copies")).where("copies > 0"), "copies")
    boxed = _boxed(docs).withColumn("row", row)
    # Equal rows share a key, and so the sum of their copies.
    once = boxed.select("doc", "row").join(copies.withColumnRenamed("doc_id", "row"), "row").dropDuplicates(["row"])
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of up to 2048 tokens."""
    return pack(docs, **tokenizer_files())


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# Similarity, tilted rates and tokens are beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *inner, (_, last) = STAGES
    for name, stage in inner:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
