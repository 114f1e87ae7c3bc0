"""The stored index: parquet in directories by term bucket, sorted by term and document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.terms import Terms, query_terms, split_terms
from rankweave.runtime import forget, stored

# Part of the stored layout: lookups compute the bucket of a term again, from the number of buckets stored with it.
BUCKET, BUCKETS = "bucket", "buckets"
TERM_BUCKETS = 64
# Rows that a task sorts and writes, whatever the number of all.
RANGE_ROWS = 500_000
# Terms that become a filter; more of them are joined.
MAX_FILTER_TERMS = 200


def term_bucket(term: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(term), buckets).cast("int")


def write_index(
    postings: DataFrame, path: str, mode: str = "errorifexists", buckets: int = TERM_BUCKETS
) -> None:
    """Write ``postings(term, doc, tf)`` in ``buckets`` directories: more for a large index, so that a lookup opens few files.

    The ranges run over bucket, term and document, so a frequent term fills as
    many files as it needs while a rare one stays in one row group.
    """
    write_buckets(postings.select("term", "doc", "tf"), path, mode, buckets, [], ["doc"])


def write_buckets(rows: DataFrame, path: str, mode: str, buckets: int, folders: list[str], order: list[str]) -> None:
    """Write rows with a ``term`` in directories by bucket, then by the columns ``folders``, sorted by term and ``order``.

    The rows are stored first: they are counted, sampled for the ranges and then read, and there are as many ranges as
    keep a task's rows few.
    """
    count = F.lit(int(buckets))
    sort = [BUCKET, *folders, "term", *order]
    rows = stored(rows, "unsorted")
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    (
        rows.select("*", count.alias(BUCKETS), term_bucket(F.col("term"), count).alias(BUCKET))
        .repartitionByRange(ranges, *sort)
        .sortWithinPartitions(*sort)
        .write.mode(mode)
        .partitionBy(BUCKETS, BUCKET, *folders)
        .parquet(path)
    )
    forget(rows)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``postings(term, doc, tf)`` with the directories as further columns: number of buckets, and bucket."""
    schema = f"term string, doc string, tf bigint, {BUCKETS} int, {BUCKET} int"
    return spark.read.schema(schema).parquet(path)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in a directory; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory())


def distinct_terms(spark: SparkSession, terms: Terms | DataFrame) -> DataFrame:
    """``terms(term)``, cut and normalised like the text of an index, each once.

    ``terms`` are keywords, or a DataFrame of which the first column holds them.
    """
    if isinstance(terms, DataFrame):
        words = terms.select(F.explode(split_terms(terms[terms.columns[0]])).alias("term"))
        return words.where(F.col("term") != "").distinct()
    return spark.createDataFrame([(term,) for term in query_terms(terms)], "term string")


def bucket_folders(spark: SparkSession, path: str, terms: Terms | DataFrame) -> list[str]:
    """The bucket directories that hold the terms. Only the one above them is listed, and asked which of them exist."""
    found = []
    for folder in subfolders(spark, path):
        name, _, buckets = folder.partition("=")
        if name == BUCKETS:
            there = set(subfolders(spark, f"{path}/{folder}"))
            numbers = _bucket_numbers(spark, terms, F.lit(int(buckets)))
            found += [f"{path}/{folder}/{BUCKET}={n}" for n in sorted(numbers) if f"{BUCKET}={n}" in there]
    return found


def _bucket_numbers(spark: SparkSession, terms: Terms | DataFrame, buckets: Column) -> set[int]:
    """Buckets of the terms: no more numbers than buckets, whatever the number of terms."""
    if not isinstance(terms, DataFrame):
        # Constants over a table of constants are computed while planning, without a job.
        words = F.array(*[term_bucket(F.lit(word), buckets) for word in query_terms(terms)])
        return set(spark.sql("VALUES (0)").select(words).first()[0])
    words = distinct_terms(spark, terms)
    return {n for (n,) in words.select(term_bucket(F.col("term"), buckets)).distinct().collect()}


def open_index(spark: SparkSession, path: str, terms: Terms | DataFrame) -> DataFrame:
    """What ``read_index`` gives, of the directories that hold the terms alone: no other is listed or opened."""
    schema = f"term string, doc string, tf bigint, {BUCKETS} int, {BUCKET} int"
    folders = bucket_folders(spark, path, terms)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def of_terms(rows: DataFrame, terms: Terms | DataFrame) -> DataFrame:
    """Rows whose ``term`` is one of the terms: a filter on the scan, or a semi join if there are many."""
    words = None if isinstance(terms, DataFrame) else query_terms(terms)
    if words is None or len(words) > MAX_FILTER_TERMS:
        return rows.join(distinct_terms(rows.sparkSession, terms), "term", "left_semi")
    found = rows.where(F.col("term").isin(words))
    if BUCKET in rows.columns:
        found = found.where(F.col(BUCKET).isin([term_bucket(F.lit(word), F.col(BUCKETS)) for word in words]))
    return found
