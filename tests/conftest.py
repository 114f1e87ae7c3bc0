from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# The micro fixture: title and body of each page.
PAGES = [
    ("Alpha", "[[Beta]] and [[Gamma Ray|the ray]] don't stop-me [[Beta]]"),
    ("Beta", "[[Alpha]] [[Café]] beta beta BETA\nline"),
    (
        "Gamma Ray",
        "[[Alpha#History|x]] [[File:z.png|thumb|see [[Beta]]]] [[A|b#c]] [[Paris|Paris, France]] "
        "[[AT&amp;T]] [1] [[-x]] [[ Delta ]]",
    ),
    ("Talk:Alpha", "[[Beta]]"),
    ("Café", "beta 42 naïve &quot;alpha&quot;"),
    ("Empty", None),
]

EDGES = [
    ("Alpha", "Beta"),
    ("Alpha", "Gamma_Ray"),
    ("Alpha", "Beta"),
    ("Beta", "Alpha"),
    ("Beta", "Café"),
    ("Gamma_Ray", "Alpha"),
    ("Gamma_Ray", "A|b"),
    ("Gamma_Ray", "1"),
    ("Gamma_Ray", "_Delta_"),
]

# Ranks after one, two and three rounds.
RANKS = {
    "Alpha": (0.691875, 0.501510416667, 0.453908203125),
    "Beta": (0.631666666667, 0.5420625, 0.434189236111),
    "Gamma_Ray": (0.390833333333, 0.34603125, 0.292094618056),
    "Café": (0.51125, 0.418458333333, 0.3803765625),
    "1": (0.330625, 0.233052083333, 0.223531640625),
    "A|b": (0.330625, 0.233052083333, 0.223531640625),
    "_Delta_": (0.330625, 0.233052083333, 0.223531640625),
}

TERMS = {
    "Alpha": "and beta:2 don gamma me ray raythe stop t",
    "Beta": "alpha beta:2 betaline caf",
    "Gamma_Ray": "abc alphahistoryx atampt beta delta filezpngthumbsee france parisparis x",
    "Café": "beta nave quotalphaquot",
}
POSTINGS = sorted(
    (term.split(":")[0], doc, int((term.split(":") + ["1"])[1])) for doc, terms in TERMS.items() for term in terms.split()
)


def page_record(title: str, body: str | None) -> str:
    text = "<text />" if body is None else f'<text xml:space="preserve">{body}</text>'
    return f"  <page>\n    <title>{title}</title>\n    <revision>{text}</revision>\n  </page>\n"


def dump_text(pages=PAGES) -> str:
    return "<mediawiki>\n" + "".join(page_record(*page) for page in pages) + "</mediawiki>\n"


def rows(df) -> list[tuple]:
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.checkpoint.compress", "true")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(dump_text(), encoding="utf-8")
    return str(path)


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, dst string")


@pytest.fixture
def postings(spark):
    return spark.createDataFrame(POSTINGS, "term string, doc string, tf bigint")
