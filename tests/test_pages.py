"""Page scan, extraction and link rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import EDGES, dump_text, page_record, rows
from rankweave.functions import markup
from rankweave.operators.pages import extract_links, extract_pages
from rankweave.plans import table_inputs as inputs
from rankweave.sources.readers import read_pages


def links_of(text: str) -> list[str]:
    """The link rules for one text, step by step."""
    found = []
    for piece in re.findall("\\[[^\n\r\x85\u2028\u2029]+?\\]", text):
        width = 2 if piece.startswith("[[") else 1
        units = len(piece.encode("utf-16-be")) // 2
        if units < width + 2 or units > 100 or piece[width] in "#,.&'-{":
            continue
        if any(char in piece for char in ":,&"):
            continue
        end = next(piece.index(mark) for mark in "#|]" if mark in piece)
        target = re.sub("[ \t\n\x0b\f\r]", "_", piece[width:end])
        if target:
            found.append(target)
    return found


def pages_of(spark, path):
    return extract_pages(read_pages(spark, path))


def test_records_of_the_dump(spark, dump):
    values = [row.value for row in read_pages(spark, dump).collect()]
    assert len(values) == 6
    assert all(value.startswith("<page>") and "</page>" not in value for value in values)


def test_pages_of_the_dump(spark, dump):
    pages = dict(rows(pages_of(spark, dump)))
    assert set(pages) == {"Alpha", "Beta", "Gamma_Ray", "Café"}
    assert pages["Beta"] == "[[Alpha]] [[Café]] beta beta BETA\nline"


def test_edges_of_the_dump(spark, dump):
    assert rows(extract_links(pages_of(spark, dump))) == sorted(EDGES)


@pytest.mark.parametrize("split_bytes", [64, 211, 1000, 1 << 27])
def test_pages_survive_any_split(spark, tmp_path, conf, split_bytes):
    pages = [(f"Page {n}", "é" * (n % 50) + f" [[Page {n + 1}]]") for n in range(300)]
    (tmp_path / "dump.xml").write_text(dump_text(pages), encoding="utf-8")
    conf(files__maxPartitionBytes=split_bytes, files__openCostInBytes=0)
    found = pages_of(spark, str(tmp_path / "dump.xml"))
    assert found.rdd.getNumPartitions() > 1 or split_bytes > 1000
    assert rows(found) == sorted((title.replace(" ", "_"), text) for title, text in pages)


def test_dump_in_several_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"part-{n}.xml").write_text(dump_text([(f"Page {n}", "text")]), encoding="utf-8")
    assert rows(pages_of(spark, str(tmp_path))) == [(f"Page_{n}", "text") for n in range(3)]


def test_page_cut_off_in_its_text_is_dropped(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(page_record("Whole", "text") + "<page><title>Cut</title><text>abc")
    assert rows(pages_of(spark, str(tmp_path))) == [("Whole", "text")]


@pytest.mark.parametrize("split_bytes", [60, 10_000_000])
def test_a_last_page_without_an_end_tag_is_dropped(spark, tmp_path, conf, split_bytes):
    """Files that end at every byte of their last page, and one whose last page is longer than the bytes looked at."""
    conf(files__maxPartitionBytes=split_bytes)
    first, last = page_record("Whole", "text"), page_record("Last", "[[x]]").rstrip("\n")
    for n in range(0, len(last) + 1):
        (tmp_path / f"part {n}.xml").write_text(first + last[:n], encoding="utf-8")
    (tmp_path / "long.xml").write_text(first + "<page><title>Cut</title><text>" + "abc " * 3000 + "</text>", encoding="utf-8")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "ended.xml").write_text(dump_text([("Ended", "text")]) + "\n" * 6000, encoding="utf-8")
    found = rows(pages_of(spark, str(tmp_path)))
    assert found == sorted([("Whole", "text")] * (len(last) + 2) + [("Last", "[[x]]"), ("Ended", "text")])


def test_first_revision_only(spark):
    value = "<page><title>A</title><text a='b'>one</text><text>two</text>"
    raw = spark.createDataFrame([(value,)], "value string")
    assert rows(extract_pages(raw)) == [("A", "one")]


def test_records_without_title_or_text_are_skipped(spark):
    values = ["<page><text>one</text>", "<page><title>A</title>", "<page><title>B</title><text />", "<page>"]
    raw = spark.createDataFrame([(value,) for value in values], "value string")
    assert rows(extract_pages(raw)) == []


def test_extract_between(spark):
    texts = ["x(a)(b)", "x(a", "a)", "((a))", "(a\nb)", ""]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    found = [row.found for row in df.select(markup.extract_between(F.col("text"), "(", ")").alias("found")).collect()]
    assert found == ["a", "", "", "(a", "a\nb", ""]


def test_link_rules_on_edge_cases(spark):
    texts = [
        "[[]] [] [[|a]] [[a|]] [[ ]] []] []a|b] [[#a]] [[a#]] [[a]b] [a#b|c] [[a|b]] [[[a]]]",
        "[[a\nb]] [[a\u2028b]] [[a\x85b]] [[a\tb]] [[a\x0bb]] [[a\u00a0b]] [[😀 x]]",
        "[" + "a" * 98 + "] [" + "a" * 99 + "] [[" + "a" * 97 + "]]",
        "[" + "😀" * 49 + "] [" + "😀" * 50 + "] [" + "😀" * 48 + "ab]",
        "[[.a]] [[,a]] [[&a]] [['a]] [[-a]] [[{a]] [[a.b]] [[a'b]] [[a-b]] [[a,b]] [[a&b]] [[a:b]]",
    ]
    pages = spark.createDataFrame([(str(n), text) for n, text in enumerate(texts)], "page string, text string")
    expected = sorted((str(n), target) for n, text in enumerate(texts) for target in links_of(text))
    assert rows(extract_links(pages)) == expected


def test_link_rules_on_random_text(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices("[[[]]]|#:,&.-ab \t\n\u2028é😀", k=draw.randint(0, 120))) for _ in range(3000)]
    pages = spark.createDataFrame([(str(n), text) for n, text in enumerate(texts)], "page string, text string")
    expected = sorted((str(n), target) for n, text in enumerate(texts) for target in links_of(text))
    assert len(expected) > 1000
    assert rows(extract_links(pages)) == expected


def test_every_rule_drops_some_link(spark):
    found = inputs.rule_pages(spark, "/root/testdata/sf0.001").select(
        F.explode(markup.link_matches(F.col("text"))).alias("link")
    )
    links = [row["link"] for row in found.collect()]
    kept = {row["link"] for row in found.where(markup.is_page_link(F.col("link"))).collect()}
    dropped = [link for link in links if link not in kept]
    for char in markup.BAD_CHARS:
        assert any(char in link for link in dropped), char
    for char in ("#", ",", ".", "&", "'", "-", "{"):
        assert any(link.lstrip("[").startswith(char) for link in dropped), char
    assert any(len(link) > 100 for link in dropped) and any(len(link) <= 100 < len(link.encode("utf-16-le")) / 2 for link in dropped)
    assert "[[]" in dropped and any(link.startswith("[Doc") for link in kept)
