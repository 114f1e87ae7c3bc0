"""Quality rules: divergence of a document's character classes and common words from its language's reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.runtime import stored

# What separates words, and what counts as a symbol.
BLANKS = "\t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
# The histogram of characters. Letters are a-z and all beyond ASCII; these add their further bytes to the second bin.
CHARACTER_CLASSES = ("letters", "further_bytes", "upper", "digit", "space", "sentence", "symbol")
NOT_LETTERS = r"[^\x00-\x60\x7B-\x7F]+"
# Frequent words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "en": "the of and to in a is that it for was on with as be at".split(),
    "es": "de la que el en y a los se del las un por con no una".split(),
    "fr": "de la le et les des en un du une que est pour qui dans sur".split(),
}
OTHER = "other"
N_COMMON = 16  # length of each list

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Guards: below these lengths a histogram says too little, and its divergence is not judged.
MIN_CLASS_CHARS = 200
MIN_HISTOGRAM_WORDS = 100
MAX_CLASS_DIVERGENCE = 0.12
MAX_WORD_DIVERGENCE = 0.30
# The reference that decides: medians in steps of 1 / STEPS over at least MIN_REFERENCE_TEXTS different texts.
STEPS = 10_000
MIN_REFERENCE_TEXTS = 10


def _language(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(OTHER)


def _removed(text: str, what: str | Column) -> Column:
    """How many bytes go when ``what`` is deleted from the column ``text``."""
    what = F.lit(what) if isinstance(what, str) else what
    return F.octet_length(text) - F.octet_length(F.replace(text, what, F.lit("")))


def document_features(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with counts, character classes and common words of each text; null text as empty.

    A common word counts where it stands in lower case between blanks; of the same word twice in a row, once.
    Three-word windows are compared by 64-bit hashes.
    """
    text = F.coalesce("text", F.lit(""))
    digest = F.xxhash64(text)
    blanked = text
    for blank in BLANKS:
        blanked = F.replace(blanked, F.lit(blank), F.lit(" "))
    lists = F.create_map(*[x for lang in COMMON_WORDS for x in (F.lit(lang), F.array(*map(F.lit, COMMON_WORDS[lang])))])
    no_words = F.lit([""] * N_COMMON)
    base = documents.select(
        *keep,
        _language(F.col("lang")).alias("_lang"),
        F.col("lang").cast("string").alias("_own_lang"),
        digest.alias("_text"),
        F.filter(F.split(text, "\n"), lambda line: F.rtrim(F.translate(line, BLANKS, " " * 5)) != "").alias("_lines"),
        F.concat(F.lit(" "), blanked, F.lit(" ")).alias("_blanked"),
    )
    padded = base.select(
        *keep,
        "_lang",
        "_own_lang",
        "_text",
        "_blanked",
        F.array_remove(F.split("_blanked", " "), "").alias("_words"),
        F.replace("_blanked", F.lit(" "), F.lit("")).alias("_solid"),
        F.coalesce(lists[F.col("_lang")], no_words).alias("_list"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    words = F.col("_words")
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.when(F.size(words) >= 3, F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0))))
    found = [
        F.when(F.get("_list", F.lit(i)) == "", 0)
        .otherwise(
            _removed("_blanked", F.concat(F.lit(" "), F.get("_list", F.lit(i)), F.lit(" ")))
            / (F.octet_length(F.get("_list", F.lit(i))) + 2)
        )
        .cast("long")
        for i in range(N_COMMON)
    ]
    counted = padded.select(
        *keep,
        "_lang",
        "_own_lang",
        "_text",
        F.size(words).cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        "n_dup_lines",
        windows.alias("_windows"),
        F.array(*found).alias("_found"),
        (F.octet_length("_blanked") - F.octet_length("_solid") - 2).cast("long").alias("_space"),
        F.octet_length("_solid").cast("long").alias("_bytes"),
        F.regexp_replace("_solid", NOT_LETTERS, "").alias("_rest"),
    )
    # Equal windows are neighbours once sorted. Most texts have none, which the distinct count tells sooner.
    numbered = F.sort_array(F.arrays_zip(F.col("_windows").alias("h"), F.sequence(F.lit(1), F.size("_windows")).alias("i")))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rest = F.col("_rest")
    upper, digit, symbol = (F.regexp_replace(rest, f"[^{c}]+", "") for c in ("A-Z", "0-9", SYMBOLS[1:-1]))
    sentence = F.regexp_replace(rest, r"[^.,;:!?'\"()-]+", "")
    sized = counted.select(
        *keep,
        "_lang",
        "_own_lang",
        "_text",
        "n_words",
        "word_chars",
        "n_dup_lines",
        F.length(symbol).cast("long").alias("n_symbols"),
        F.when(again, numbered).alias("_sorted"),
        "_found",
        F.array(
            F.col("word_chars") - F.length(rest),
            F.col("_bytes") - F.col("word_chars"),
            F.length(upper).cast("long"),
            F.length(digit).cast("long"),
            F.col("_space"),
            F.length(sentence).cast("long"),
            F.length(rest).cast("long") - F.length(upper) - F.length(digit) - F.length(sentence),
        ).alias("_classes"),
    )
    neighbours = F.filter(
        F.arrays_zip(F.col("_sorted").alias("a"), F.slice("_sorted", 2, F.size("_sorted")).alias("b")),
        lambda pair: pair["a"]["h"] == pair["b"]["h"],
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                neighbours,
                lambda pair: F.array(*[pair[side]["i"] + k for side in "ab" for k in range(3)]),
            )
        )
    )
    common = F.aggregate("_found", F.lit(0).cast("long"), lambda a, b: a + b)
    return sized.select(
        *keep,
        "_lang",
        "_own_lang",
        "_text",
        "_classes",
        F.concat("_found", F.array(F.greatest(F.col("n_words") - common, F.lit(0).cast("long")))).alias("_common"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(F.when(F.col("_sorted").isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def robust_references(features: DataFrame) -> DataFrame:
    """The typical character classes and common words of each ``lang``: medians of the shares in its texts.

    Only rows that pass the base rules and whose histogram is long enough to be judged count, each different text once,
    so neither a long text nor many copies of one move a median. A median is found exactly, in steps of 1 / ``STEPS``,
    from counts per step, which are combined in each task; the shuffled rows are bounded by languages, bins and steps. A
    null language, and one of fewer than ``MIN_REFERENCE_TEXTS`` such texts, has no reference.
    """
    texts = features.where(~_base_failed() & F.col("_own_lang").isNotNull()).groupBy("_own_lang", "_text").agg(
        F.first("_classes").alias("_classes"),
        F.first("_common").alias("_common"),
        F.first("word_chars").alias("_chars"),
        F.first("n_words").alias("_n"),
    )

    def steps(counts: Column) -> Column:
        return F.transform(counts, lambda c: F.round(STEPS * F.try_divide(c, _total(counts))).cast("int"))

    def bins(kind: str, counts: str, judged: Column) -> Column:
        listed = F.transform(steps(F.col(counts)), lambda step, i: F.struct(F.lit(kind).alias("kind"), i.alias("bin"), step.alias("step")))
        return F.when(judged, listed).otherwise(F.slice(listed, 1, 0))

    both = F.concat(
        bins("class", "_classes", F.col("_chars") >= MIN_CLASS_CHARS),
        bins("word", "_common", F.col("_n") >= MIN_HISTOGRAM_WORDS),
    )
    key = ["_own_lang", "kind", "bin"]
    counted = texts.select("_own_lang", F.inline(both)).groupBy(*key, "step").agg(F.count(F.lit(1)).alias("n"))
    below = F.sum("n").over(Window.partitionBy(*key).orderBy("step"))
    ranked = counted.withColumn("below", below).withColumn("all", F.sum("n").over(Window.partitionBy(*key)))
    medians = ranked.where((F.col("all") >= MIN_REFERENCE_TEXTS) & (2 * F.col("below") >= F.col("all"))).groupBy(*key).agg(
        F.min("step").cast("long").alias("step")
    )

    def listed(kind: str) -> Column:
        found = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("bin", "step"))))
        return F.transform(found, lambda b: b["step"])

    return medians.groupBy("_own_lang").agg(listed("class").alias("_typical_classes"), listed("word").alias("_typical_common"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def jensen_shannon(left: Column, right: Column) -> Column:
    """Divergence in bits, 0 to 1, of two histograms of counts; null if one is empty."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    shares = F.zip_with(
        left,
        right,
        lambda a, b: F.struct(F.try_divide(a, _total(left)).alias("p"), F.try_divide(b, _total(right)).alias("q")),
    )
    terms = F.transform(shares, lambda s: part(s["p"], s["q"]) + part(s["q"], s["p"]))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2
    return F.when((_total(left) > 0) & (_total(right) > 0), divergence)


def judge_quality(
    documents: DataFrame,
    *,
    keep: list[str] | None = None,
    max_class_divergence: float = MAX_CLASS_DIVERGENCE,
    max_word_divergence: float = MAX_WORD_DIVERGENCE,
) -> DataFrame:
    """Counts, ``base_failed``, two distances and ``kept`` for each row of ``documents``.

    ``base_failed``: under ``MIN_WORDS`` words, or over ``MAX_REPEATED_PERCENT`` percent of the words in three-word
    windows found twice. Other rows are rejected if the histogram of character classes, or that of the frequent
    words of their language, is further from what is typical of the language (``robust_references``) than allowed:
    ``class_distance`` and ``word_distance``, null where there is no reference. Histograms of fewer than
    ``MIN_CLASS_CHARS`` characters or ``MIN_HISTOGRAM_WORDS`` words are not judged.

    Languages without a list are judged by character classes only, each by its own; null and those of few texts are
    not judged by histograms. A null text counts as empty and fails. Repeated rows are judged alike and stay. An empty
    table gives an empty result. ``keep`` (``doc_id`` unless given) names the columns to carry along.

    The features are stored once. The references have at most one row for every ``MIN_REFERENCE_TEXTS`` texts and in
    practice one a language.
    """
    keep = keep or ["doc_id"]
    features = stored(document_features(documents, keep), "quality")
    joined = features.join(stored(robust_references(features), "references"), "_own_lang", "left")
    judged = joined.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "_lang",
        jensen_shannon(F.col("_classes"), F.col("_typical_classes")).alias("class_distance"),
        jensen_shannon(F.col("_common"), F.col("_typical_common")).alias("word_distance"),
    )
    base_failed = _base_failed()
    far_classes = (F.col("word_chars") >= MIN_CLASS_CHARS) & (F.col("class_distance") > max_class_divergence)
    far_words = (
        (F.col("n_words") >= MIN_HISTOGRAM_WORDS)
        & (F.col("_lang") != OTHER)
        & (F.col("word_distance") > max_word_divergence)
    )
    rejected = base_failed | F.coalesce(far_classes, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return judged.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~rejected).alias("kept"),
        "class_distance",
        "word_distance",
    )
