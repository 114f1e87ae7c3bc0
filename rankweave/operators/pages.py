"""Pages out of raw page records, and links out of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions import markup


def extract_pages(pages_raw: DataFrame, title: str = "title", body: str = "text") -> DataFrame:
    """``pages_raw(value)`` to ``pages(page, text)``.

    Records without a title or a body element are skipped, as are pages of
    other namespaces.
    """
    # One generated row per record keeps each pattern to one evaluation: a
    # filter cannot move below the generator and repeat it.
    fields = F.struct(
        F.regexp_extract("value", f"(?s)<{title}>.*?</{title}>", 0).alias("title"),
        markup.element_body(F.col("value"), body).alias("text"),
    )
    tags = 2 * len(title) + len("<></>")
    name = F.substring("title", len(title) + len("<>") + 1, F.length("title") - tags)
    return (
        pages_raw.select(F.inline(F.array(fields)))
        .where((F.col("title") != "") & (F.col("text") != ""))
        .select(name.alias("title"), "text")
        .where(markup.in_main_namespace(F.col("title")))
        .select(markup.page_id(F.col("title")).alias("page"), "text")
    )


def extract_links(pages: DataFrame) -> DataFrame:
    """``pages(page, text)`` to ``edges(src, dst)``, one row per link: duplicates and self-links stay."""
    link = F.col("link")
    return (
        pages.select(F.col("page").alias("src"), F.explode(markup.link_matches(F.col("text"))).alias("link"))
        .where(markup.is_page_link(link))
        .select("src", markup.link_target(link).alias("dst"))
        .where(F.col("dst") != "")
    )
