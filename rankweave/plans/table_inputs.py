"""Pages, graphs and dumps derived from the given tables, which hold no wiki dump of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions import markup
from rankweave.runtime import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def html_records(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as page records: they have a title and an article element."""
    return table(spark, folder, "pages").select(F.col("html").alias("value"))


def wiki_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages under their titles, with each anchor as a wiki link."""
    anchor = r'<a href="/([^"]*)">([^<]*)</a>'
    title = markup.extract_between(F.col("html"), "<title>", "</title>")
    return (
        table(spark, folder, "pages")
        .where(markup.in_main_namespace(title))
        .select(
            markup.page_id(title).alias("page"),
            F.regexp_replace("html", anchor, "[[$1|$2]]").alias("text"),
        )
    )


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("page"), "text")


def document_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Each document links to those with half and a third of its number."""
    number = F.col("doc_id")
    return (
        table(spark, folder, "documents")
        .select(number.alias("src"), F.explode(F.array(F.expr("doc_id div 2"), F.expr("doc_id div 3"))).alias("dst"))
        .select(F.col("src").cast("string"), F.col("dst").cast("string"))
    )


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey")


def trade_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Nation of the customer to nation of the supplier, once per line item."""
    nation = table(spark, folder, "nation")
    buyers = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("src"))
    )
    sellers = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("dst"))
    )
    return (
        _sales(spark, folder)
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("src", "dst")
    )


def account_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to supplier and back, once per line item."""
    customer = F.concat(F.lit("customer-"), "o_custkey")
    supplier = F.concat(F.lit("supplier-"), "l_suppkey")
    both = F.array(
        F.struct(customer.alias("src"), supplier.alias("dst")),
        F.struct(supplier.alias("src"), customer.alias("dst")),
    )
    return _sales(spark, folder).select(F.inline(both))


def status_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Order status to customer and back, once per order: every link leaves or enters one of a few hubs."""
    status = F.concat(F.lit("status-"), "o_orderstatus")
    customer = F.concat(F.lit("customer-"), "o_custkey")
    both = F.array(
        F.struct(status.alias("src"), customer.alias("dst")),
        F.struct(customer.alias("src"), status.alias("dst")),
    )
    return table(spark, folder, "orders").select(F.inline(both))


# Link texts that reach every rule, x and y standing for words; one document in sixteen has each.
RULE_TEXTS = [
    "see [x] here",
    "[[x#y|z]]",
    "[[x|y#z]] and [[y]]",
    "[[-x]] [[.x]] [['x]] [[{x]]",
    "[[:x]] [[x:y]]",
    "[[x&y]] [[&x]]",
    "[[ x\ty ]]",
    "[[|x]] [[#x]]",
    "[[x|" + "z" * 120 + "]] [[x|" + "z" * 90 + "]]",
    "[[x\U0001f600y]]",
    "[[File:x.png|see [[y]]]] [[y]]",
    "[[x,y]] [[,x]]",
    "[[]] [[x]]",
    "[[x|y|z]] [1]",
    "[[" + "\U0001f600" * 60 + "]] [[" + "\U0001f600" * 40 + "]]",
    "[[x]] [[x|y]] [[x]]",
]


def rule_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page for each document whose links touch one of the link rules."""
    number = F.col("doc_id").cast("string")
    half = F.expr("CAST(doc_id div 2 AS STRING)")
    text = F.element_at(F.array(*map(F.lit, RULE_TEXTS)), (F.col("doc_id") % len(RULE_TEXTS) + 1).cast("int"))
    for letter, word in (("x", F.concat(F.lit("Doc "), number)), ("y", F.concat(F.lit("Doc_"), half))):
        text = F.replace(text, F.lit(letter), word)
    return table(spark, folder, "documents").select(F.concat(F.lit("Doc_"), number).alias("page"), text.alias("text"))


def write_rule_dump(spark: SparkSession, folder: str) -> str:
    """The same pages as a page dump; return its path."""
    record = F.concat(
        F.lit("  <page><title>"), F.col("page"), F.lit("</title>\n<text xml:space='preserve'>"), F.col("text"), F.lit("</text></page>")
    )
    path = fresh_path(spark, "dump")
    rule_pages(spark, folder).select(record.alias("value")).write.text(path)
    return path


def write_cut_dumps(spark: SparkSession, folder: str) -> str:
    """Dump files of a page for each document, and a last page of which each file has one byte more; return their path."""
    whole = F.concat(F.lit("<page><title>Doc "), F.col("doc_id"), F.lit("</title><text>x</text></page>"))
    last = F.concat(F.lit("<page><title>Last "), F.col("kind"), F.lit("</title><text>[[x]]</text></page>"))
    kind = F.pmod(F.col("doc_id"), F.lit(60)).cast("int")
    docs = table(spark, folder, "documents").select("doc_id", kind.alias("kind"))
    pages = docs.groupBy("kind").agg(F.array_join(F.sort_array(F.collect_list(whole)), "\n").alias("pages"))
    files = pages.select("kind", F.concat("pages", F.lit("\n"), F.substring(last, F.lit(1), F.col("kind"))).alias("value"))
    path = fresh_path(spark, "dump")
    files.repartition("kind").write.partitionBy("kind").option("lineSep", " ").text(path)
    return path


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with and without titles, texts and namespaces, one document in six of each."""
    text = F.concat(F.lit("<text>"), "doc_id", F.lit(" [[x]]</text>"))
    title = F.concat(F.lit("<title>Doc "), "doc_id", F.lit("</title>"))
    talk = F.concat(F.lit("<title>Talk:"), "doc_id", F.lit("</title>"))
    kinds = F.array(
        F.concat(title, text),
        F.concat(talk, text),
        title,
        F.concat(title, F.lit("<text />")),
        text,
        F.concat(title, F.lit("<ns>0</ns>"), F.replace(text, F.lit("<text>"), F.lit('<text xml:space="preserve">'))),
    )
    kind = F.element_at(kinds, (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, folder, "documents").select(F.concat(F.lit("<page>"), kind).alias("value"))


def _escaped(text: Column) -> Column:
    for char, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def write_document_dump(spark: SparkSession, folder: str) -> str:
    """Write the documents as a page dump in which each links to two others; return its path."""

    def name(number: str) -> Column:
        return F.concat(F.lit("Doc "), F.expr(number))

    record = F.concat(
        F.lit("  <page>\n    <title>"),
        name("doc_id"),
        F.lit('</title>\n    <revision>\n      <text xml:space="preserve">'),
        _escaped(F.col("text")),
        F.lit(" [["),
        name("doc_id div 2"),
        F.lit("]] [["),
        name("doc_id div 3"),
        F.lit("|other]]</text>\n    </revision>\n  </page>"),
    )
    path = fresh_path(spark, "dump")
    table(spark, folder, "documents").select(record.alias("value")).write.text(path)
    return path
