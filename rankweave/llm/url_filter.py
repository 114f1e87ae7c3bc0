"""URL filter: longest match in a trie over reversed host labels and path segments."""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST_RULES = 200_000
VERDICTS = ("allow", "block")


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[str, str]:
    """``example.com/en/`` as host ``example.com`` and path ``/en/``."""
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def build_trie(rules: Iterable[tuple[str, str]]) -> dict:
    """``rules``: (verdict, rule). Nodes are dictionaries from host label, and below None from path segment, to node.

    What a rule's path has behind its last slash is a prefix of a segment; prefixes stand at their node under "", with
    their lengths, so that a segment is looked up once for each length and not compared with each rule.
    A rule given as allow and as block blocks.
    """
    root: dict = {}
    for verdict, rule in rules:
        if verdict not in VERDICTS:
            raise ValueError(f"no such verdict: {verdict}")
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(("host", label), {})
        node = node.setdefault(None, {})
        *segments, tail = path.split("/")
        for segment in segments:
            node = node.setdefault(("path", segment), {})
        tails, lengths = node.setdefault("", ({}, []))
        if len(tail) not in lengths:
            insort(lengths, len(tail), key=lambda length: -length)
        if tails.get(tail, ("", ""))[0] != "block":
            tails[tail] = (verdict, rule)
    return root


def _longest_in_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
    found = None
    for segment in segments:
        if "" in node:
            tails, lengths = node[""]
            for length in lengths:  # the longest first
                if length <= len(segment) and segment[:length] in tails:
                    found = tails[segment[:length]]
                    break
        node = node.get(("path", segment))
        if node is None:
            break
    return found


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Verdict and rule of the most labels of the host and, among those, of the longest path."""
    segments = path.split("/")
    found, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(("host", label))
        if node is None:
            break
        if None in node:
            found = _longest_in_path(node[None], segments) or found
    return found


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for each row of ``pages``.

    A rule fits its host, the subdomains and every path that starts with the rule's. The rule with the most host
    labels wins, then the one with the longest path, then block. Without a rule, ``rule`` is null and the verdict
    ``default``. A null url, or one without ``://``, has an empty host and path, which no rule with a host fits.
    Repeated rows stay; an empty table gives an empty result; other columns are not read.

    The trie is broadcast, up to ``MAX_BROADCAST_RULES`` rules. A longer list takes ``join_rules``, which has the
    same result.
    """
    urls = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if len(rules) > MAX_BROADCAST_RULES:
        return join_rules(urls, rules, id_col=id_col, default=default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [longest_match(trie.value, *url) or (default, None) for url in zip(host, path)]
        return pd.DataFrame({"rule": [rule for _, rule in found], "verdict": [verdict for verdict, _ in found]})

    judged = urls.withColumn("_judged", judge("host", "path"))
    return judged.select(id_col, "host", "path", "_judged.rule", "_judged.verdict")


def join_rules(urls: DataFrame, rules: list[tuple[str, str]], *, id_col: str, default: str) -> DataFrame:
    """The same by a join: each distinct url meets the rules on its host suffixes and path prefixes.

    Of its prefixes it meets only those of lengths that rules have there: at each slash, the lengths of what rules have
    behind it.
    """
    spark = urls.sparkSession
    rows = [(*split_rule(rule), verdict, rule) for verdict, rule in rules]
    table = spark.createDataFrame(rows, "rule_host string, rule_path string, verdict string, rule string")
    tail = F.length(F.substring_index("rule_path", "/", -1))
    table = table.withColumn("tail", tail)
    # The lengths of last parts that the rules of a place have: a url meets each place once for each.
    place = F.expr("substring(rule_path, 1, length(rule_path) - tail)")
    lengths = table.select("rule_host", place.alias("place"), "tail").distinct()
    best = F.max(F.struct(F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("length"), "verdict", "rule"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ends = F.filter(F.sequence(F.lit(0), F.length("path")), lambda n: (n == 0) | (F.substring("path", n, F.lit(1)) == "/"))
    distinct = urls.select("host", "path").distinct()
    met = distinct.withColumn("rule_host", F.explode(suffix)).withColumn("end", F.explode(ends))
    met = met.withColumn("place", F.expr("substring(path, 1, end)")).join(lengths, ["rule_host", "place"])
    met = met.where(F.col("end") + F.col("tail") <= F.length("path")).withColumn("rule_path", F.expr("substring(path, 1, end + tail)"))
    won = met.join(table.drop("tail"), ["rule_host", "rule_path"]).groupBy("host", "path").agg(best.alias("_best"))
    verdict = F.coalesce("_best.verdict", F.lit(default))
    return urls.join(won, ["host", "path"], "left").select(id_col, "host", "path", "_best.rule", verdict.alias("verdict"))
