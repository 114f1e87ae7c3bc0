"""Column functions for index terms."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Terms = str | Iterable[str]

# The characters that separate words (a line break is none), and
# the letters that are left in a term.
DELIMITERS = " '-"
LETTERS = "a-zA-Z"

# The same letters as a named class, which Java matches about twice as fast as ranges.
JAVA_LETTERS = r"\p{Alpha}"


def normalise_term(word: Column) -> Column:
    """Word without everything but ASCII letters, in lower case."""
    return F.lower(F.regexp_replace(word, f"[^{JAVA_LETTERS}]+", ""))


def split_terms(text: Column, delimiters: str = DELIMITERS) -> Column:
    """Normalised words of a text as an array, which may hold empty words.

    The dropped characters are neither letters nor delimiters, so they can go
    from the whole text in one pass before it is split.
    """
    if not delimiters or any(char.isalnum() for char in delimiters):
        raise ValueError("delimiters must be characters other than letters and digits")
    escaped = "".join("\\" + char for char in delimiters)
    kept = F.regexp_replace(text, f"[^{JAVA_LETTERS}{escaped}]+", "")
    return F.split(F.lower(kept), f"[{escaped}]+")


def query_terms(keywords: Terms, delimiters: str = DELIMITERS) -> list[str]:
    """Distinct terms of a keyword string or list, in order, cut and normalised like the text of an index."""
    texts = [keywords] if isinstance(keywords, str) else keywords
    words = (word for text in texts for word in re.split(f"[{re.escape(delimiters)}]+", text))
    terms = (re.sub(f"[^{LETTERS}]", "", word).lower() for word in words)
    return [term for term in dict.fromkeys(terms) if term]
