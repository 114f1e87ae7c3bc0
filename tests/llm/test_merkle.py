from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rankweave.llm import merkle
from rankweave.llm.merkle import fold, leaf_hash, merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    texts = [None if v is None else str(v) for v in values]
    return digest("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(hashes):
    """The root, and of each leaf the siblings from below."""
    proofs, held, nodes = [""] * len(hashes), [[i] for i in range(len(hashes))], list(hashes)
    while len(nodes) > 1:
        above, under = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for side, other in ((0, 1), (1, 0)):
                if len(pair) == 2:
                    for k in held[i + side]:
                        proofs[k] += pair[other]
            above.append(digest("".join(pair)))
            under.append([k for h in held[i : i + 2] for k in h])
        nodes, held = above, under
    return nodes[0], proofs


def by_hand(rows):
    """Per row: its leaf, subroot, root and the siblings of both trees."""
    leaves = [(i, lang, leaf((i, source, lang, n, text))) for i, text, lang, source, n in rows]
    trees = {}
    for i, lang, h in sorted(leaves, key=lambda x: (x[0] is not None, x[0] or 0, x[2])):
        trees.setdefault(lang, []).append((i, h))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = [tree([h for _, h in trees[lang]]) for lang in langs]
    root, above = tree([b[0] for b in built])
    return sorted(
        (str(i), h, built[t][0], root, built[t][1][k] + above[t]) for t, lang in enumerate(langs) for k, (i, h) in enumerate(trees[lang])
    )


def found(rows):
    checked = fold(F.col("leaf"), F.col("place"), F.col("n"), F.col("siblings"))
    out = rows.withColumn("s", checked).withColumn("r", fold(F.col("s"), F.col("top_place"), F.col("top_n"), F.col("top_siblings"))).collect()
    assert all(r["s"] == r["subroot"] and r["r"] == r["root"] for r in out)
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["siblings"] + r["top_siblings"]) for r in out)


@pytest.mark.parametrize("levels", [(8, 8), (2, 1)])
def test_equals_trees_by_hand(spark, documents, monkeypatch, levels):
    """Trees of 1, 2, 3, 5, 64, 65 and 200 leaves, with blocks and join keys of the usual size and of a few nodes."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels[0])
    monkeypatch.setattr(merkle, "SPREAD_LEVELS", levels[1])
    rng = random.Random(3)
    sizes = {None: 5, "": 1, "de": 2, "en": 200, "é": 3, "zz": 64, "Z": 65}
    rows = [(lang, k) for lang, size in sizes.items() for k in range(size)]
    rng.shuffle(rows)
    rows = [(i, rng.choice([None, "", "text é " * rng.randint(1, 50)]), lang, rng.choice([None, "s1"])) for i, (lang, _) in enumerate(rows)]
    docs = documents(rows, extra=True)
    full = [(*row, len(row[1] or "")) for row in rows]
    assert found(merkle_manifest(docs, COLUMNS, tree="lang", order="doc_id")) == by_hand(full)


def test_nulls_repeats_and_long_texts(spark, documents):
    rows = [(None, None, None, None), (None, "a", None, None), (1, "x", "en", "s"), (1, "x", "en", "s"), (1, "y", "en", "s"), (-5, "long " * 400_000, "en", "s")]
    full = [(*row, len(row[1] or "")) for row in rows]
    assert found(merkle_manifest(documents(rows), COLUMNS, tree="lang", order="doc_id")) == by_hand(full)


def test_a_single_row_is_its_own_root(spark, documents):
    row = merkle_manifest(documents([(7, "x")]), COLUMNS, tree="lang", order="doc_id").first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["siblings"] == row["top_siblings"] == ""


def test_empty_table(spark, documents):
    assert merkle_manifest(documents([]), COLUMNS, tree="lang", order="doc_id").collect() == []


def test_a_changed_row_gives_another_root(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(20)])
    changed = leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    rows = merkle_manifest(docs, COLUMNS, tree="lang", order="doc_id", keep={"changed": changed})
    other = fold(F.col("changed"), F.col("place"), F.col("n"), F.col("siblings"))
    assert rows.where(other == F.col("subroot")).count() == 0
