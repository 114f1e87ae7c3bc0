"""Text sources. Each ``read_*`` loads lines; the matching ``parse_*`` turns ``lines(value)`` into columns.

Lines without a tab, and entries whose number is none, are skipped everywhere.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_START, PAGE_END = "<page>", "</page>"
TAIL_BYTES, TAIL_READERS = 4096, 16  # of each file, read before the scan; files at a time


def _has_tab() -> Column:
    return F.contains("value", F.lit("\t"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``pages_raw(value)``: from each first ``<page>`` up to the next ``</page>``, which is left off.

    The end tag is the line separator of a text scan, so files split at any
    byte and a page is read whole by the task its record begins in. A last page without an end tag is dropped: the
    last bytes of each file tell whether there is one, unless the file is compressed.
    """
    scan = spark.read.option("lineSep", PAGE_END)
    text = scan.text(path)
    files = file_ends(spark, text.inputFiles())
    cut = [file for file, in_page in files if in_page]
    if not cut:
        return parse_pages(text)
    whole = [file for file, in_page in files if not in_page]
    pages = without_last(scan.text(cut))
    return parse_pages(pages.unionByName(scan.text(whole).select("value")) if whole else pages)


def file_ends(spark: SparkSession, files: list[str]) -> list[tuple[str, bool]]:
    """Each file, and whether it may end within a page: its last bytes show no end tag, or the start of a page behind it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def end_of(file: str) -> tuple[str, bool]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        if codecs.getCodec(path) is not None:
            return path.toString(), False
        system = path.getFileSystem(conf)
        size = system.getFileStatus(path).getLen()
        stream = system.open(path)
        try:
            stream.seek(max(0, size - TAIL_BYTES))
            _, end, rest = bytes(stream.readNBytes(TAIL_BYTES)).rpartition(PAGE_END.encode())
        finally:
            stream.close()
        return path.toString(), size > 0 and (not end or PAGE_START.encode() in rest)

    with ThreadPoolExecutor(TAIL_READERS) as readers:
        return list(readers.map(end_of, files))


def without_last(text: DataFrame) -> DataFrame:
    """Records but for the last one of each file."""
    placed = text.select("value", "_metadata.file_path", "_metadata.file_block_start").withColumn("place", F.monotonically_increasing_id())
    last = placed.groupBy("file_path").agg(F.max(F.struct("file_block_start", "place")).alias("last"))
    last = last.select("file_path", "last.place")
    return placed.join(F.broadcast(last), ["file_path", "place"], "left_anti").select("value")


def parse_pages(chunks: DataFrame) -> DataFrame:
    value = F.col("value")
    return chunks.where(F.contains(value, F.lit(PAGE_START))).select(
        F.substr(value, F.instr(value, PAGE_START)).alias("value")
    )


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """``edges(src, dst)`` from ``src<tab>dst`` lines; ``#`` starts a comment line."""
    return parse_edge_list(spark.read.text(path))


def parse_edge_list(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    return (
        lines.where(~F.startswith("value", F.lit("#")) & _has_tab())
        .select(parts[0].alias("src"), parts[1].alias("dst"))
    )


def read_rank_state(spark: SparkSession, path: str) -> DataFrame:
    """``adjacency(page, rank, links)`` from ``page<tab>rank<tab>link,link`` lines."""
    return parse_rank_state(spark.read.text(path))


def parse_rank_state(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 3)
    links = F.filter(F.split(F.get(parts, 2), ","), lambda link: link != "")
    state = lines.where(_has_tab()).select(
        parts[0].alias("page"),
        parts[1].try_cast("double").alias("rank"),
        F.coalesce(links, F.array().cast("array<string>")).alias("links"),
    )
    return state.where(F.col("rank").isNotNull())


def read_posting_lists(spark: SparkSession, path: str) -> DataFrame:
    """``postings(term, doc, tf)`` from ``term<tab>doc:tf doc:tf `` lines; a term may have several.

    The last colon of an entry ends the document, which may hold others.
    """
    return parse_posting_lists(spark.read.text(path))


def parse_posting_lists(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    count = F.substring_index("posting", ":", -1)
    doc = F.substring("posting", F.lit(1), F.length("posting") - F.length(count) - 1)
    # The line is cut below the generator: beside it, it would be cut again for each of its entries.
    return (
        lines.where(_has_tab())
        .select(parts[0].alias("term"), parts[1].alias("entries"))
        .select("term", F.explode(F.split("entries", " ")).alias("posting"))
        .where(F.contains("posting", F.lit(":")))
        .select("term", doc.alias("doc"), count.try_cast("bigint").alias("tf"))
        .where(F.col("tf").isNotNull())
    )


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``ranks(page, rank)`` from ``rank<tab>page`` lines."""
    return parse_ranks(spark.read.text(path))


def parse_ranks(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    ranks = lines.where(_has_tab()).select(parts[1].alias("page"), parts[0].try_cast("double").alias("rank"))
    return ranks.where(F.col("rank").isNotNull())


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """``hits(doc, tf)`` from ``doc<tab>total`` lines."""
    return parse_hits(spark.read.text(path))


def parse_hits(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    hits = lines.where(_has_tab()).select(parts[0].alias("doc"), parts[1].try_cast("bigint").alias("tf"))
    return hits.where(F.col("tf").isNotNull())
