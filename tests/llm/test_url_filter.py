from __future__ import annotations

import random

import pytest

from rankweave.llm import url_filter
from rankweave.llm.queries import URL_RULES

URLS = [
    "http://www.example.com/en/1", "https://a.example.com/en/2?x=/es/", "https://A.Example.NET/es/3#top", "http://b.example.net/fr/",
    "http://b.example.net/fr", "http://b.example.net/de/1", "http://example.com/en", "http://com", "http://notexample.com/en/1",
    "ftp://x.org/en/", "no scheme", "", None, "http://", "http:///path", "http://com.evil.org/en/", "http://xcom/en/", "://example.com/en/",
    "http://ÄB.COM/É", "http://a.com?u=http://b.net/es/", "http://example.com:80/en/1", "http://x.net//es/", "http://a\nb.com/x\ny?z",
]


def by_hand(url, rules):
    _, sign, rest = (url or "").partition("://")
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    if not sign:
        host = path = ""
    best = None
    for verdict, rule in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            best = max(best or (), (rule_host.count("."), len(slash + rule_path), verdict, rule))
    return (host, path, best[3] if best else None, best[2] if best else "allow")


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_a_scan_of_all_rules(spark, monkeypatch, broadcast):
    rng = random.Random(2)
    parts = ["a", "b", "com", "net", "x1"]
    rules = list(URL_RULES)
    for _ in range(60):
        host = ".".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
        path = "".join(rng.choice(["/en", "/e", "/", "/b/c"]) for _ in range(rng.randint(0, 2)))
        rules.append((rng.choice(["allow", "block"]), host + path))
    urls = URLS + [
        f"http://{'.'.join(rng.choice(parts) for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/en/', '/e', '/b/c/d', '//', '/en/b'])}" for _ in range(150)
    ]
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_RULES", 10_000 if broadcast else 1)
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*urls, URLS[0]])], "page_id bigint, url string, rule string, host string")
    found = {row["page_id"]: tuple(row)[1:] for row in url_filter.filter_urls(pages, rules).collect()}
    seen = {}
    for verdict, rule in rules:  # the same rule twice: block
        seen[rule] = max(seen.get(rule, ""), verdict)
    assert found == {i: by_hand(u, [(v, r) for r, v in seen.items()]) for i, u in enumerate([*urls, URLS[0]])}


def test_no_rows_and_bad_rules(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.filter_urls(empty, URL_RULES).collect() == []
    with pytest.raises(ValueError):
        url_filter.build_trie([("maybe", "com/")])


def test_many_rules_of_one_host_cost_a_url_little():
    import time

    rules = [("block" if i % 2 else "allow", f"example.com/a/page{i}x") for i in range(100_000)]
    trie = url_filter.build_trie(rules)
    start = time.perf_counter()
    found = [url_filter.longest_match(trie, "www.example.com", f"/a/page{i}xyz") for i in range(2000)]
    assert time.perf_counter() - start < 1
    assert found == [rules[i] for i in range(2000)]
