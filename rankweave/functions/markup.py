"""Column functions for page records and wiki links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The link pattern, the length limit in UTF-16 units, the first
# characters and the characters anywhere that disqualify a link, and the
# characters that count as white space in a link target.
LINK_PATTERN = r"\[.+?\]"
MAX_LINK_LENGTH = 100
BAD_FIRST_CHARS = ["#", ",", ".", "&", "'", "-", "{"]
BAD_CHARS = [":", ",", "&"]
WHITE_SPACE = " \t\n\x0b\f\r"


def _quoted(literal: str) -> str:
    """A literal as a regular expression."""
    return rf"\Q{literal}\E"


def extract_between(text: Column, opening: str, closing: str) -> Column:
    """Text between the first ``opening`` and the next ``closing``; empty when either is missing."""
    return F.regexp_extract(text, f"(?s){_quoted(opening)}(.*?){_quoted(closing)}", 1)


def element_body(text: Column, tag: str) -> Column:
    """Body of the first element whose start tag begins with ``<tag``; attributes are allowed."""
    return F.regexp_extract(text, f"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)


def page_id(title: Column) -> Column:
    """Title with every blank as an underscore; case and entities stay as they are."""
    return F.replace(title, F.lit(" "), F.lit("_"))


def in_main_namespace(title: Column) -> Column:
    return ~F.contains(title, F.lit(":"))


def link_matches(text: Column) -> Column:
    """Every non-overlapping bracketed piece of a text, as an array."""
    return F.regexp_extract_all(text, F.lit(LINK_PATTERN), F.lit(0))


def _bracket_width(link: Column) -> Column:
    return F.when(F.startswith(link, F.lit("[[")), 2).otherwise(1)


def _fits(link: Column) -> Column:
    # A character takes one or two UTF-16 units, so short links need no encoding.
    chars = F.length(link)
    units = F.octet_length(F.encode(link, "UTF-16BE")) / 2
    return (chars <= MAX_LINK_LENGTH // 2) | ((chars <= MAX_LINK_LENGTH) & (units <= MAX_LINK_LENGTH))


def is_page_link(link: Column) -> Column:
    """Whether a bracketed piece points to a page of the collection."""
    width = _bracket_width(link)
    keep = (F.length(link) >= width + 2) & _fits(link)
    keep &= ~F.substring(link, width + 1, F.lit(1)).isin(BAD_FIRST_CHARS)
    for char in BAD_CHARS:
        keep &= ~F.contains(link, F.lit(char))
    return keep


def link_target(link: Column) -> Column:
    """Page a bracketed piece points to.

    The target ends at the first ``#``, else at the first ``|``, else at the
    first ``]``; a ``#`` counts even when it stands behind a ``|``.
    """
    width = _bracket_width(link)
    end = (
        F.when(F.contains(link, F.lit("#")), F.instr(link, "#"))
        .when(F.contains(link, F.lit("|")), F.instr(link, "|"))
        .otherwise(F.instr(link, "]"))
    )
    target = F.substring(link, width + 1, end - 1 - width)
    return F.translate(target, WHITE_SPACE, "_" * len(WHITE_SPACE))
