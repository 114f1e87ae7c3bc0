from __future__ import annotations

import random
import re

import pytest

from rankweave.llm.components import connected_components
from rankweave.llm.jaccard import TREES, join_similar, matched_depth

WORD = re.compile("[^\x20\x09-\x0d]+")


def corpus():
    rng = random.Random(8)

    def fresh(n):
        return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    rows, base = [], fresh(120)
    for i in range(150):  # near copies of one text, at many similarities
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = fresh(1)[0]
        rows.append((i, " ".join(words)))
    rows += [(200 + i, "  ".join(base)) for i in range(30)]  # copies
    rows += [(300 + i, " ".join(fresh(rng.randint(1, 60)))) for i in range(100)]
    rows += [(500, None), (501, ""), (502, " "), (503, "a b"), (504, "a  b"), (505, "b a"), (506, "a b c d e"), (507, "a b c d e f")]
    rows += [(508, "x y " * 5000), (509, "x y " * 4000), (510, "z" * 100_000), (7, rows[7][1]), (8, "a b"), (None, rows[9][1]), (None, "lonely text of five words")]
    return rows


def by_hand(rows):
    def shingles(text):
        words = WORD.findall(text or "")
        return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(len(words), 1))))

    sets = [shingles(t) for _, t in rows]
    links = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                links[i].add(j)
                links[j].add(i)
    root = list(range(len(rows)))
    for i in range(len(rows)):
        todo, seen = [i], {i}
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        root[i] = min(ids) if ids else None
    return sorted(((rows[i][0], len(links[i]), root[i]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [256, 7])
def test_equals_brute_force(documents, block):
    rows = corpus()
    found = join_similar(documents(rows, extra=True), block=block).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in found), key=str) == by_hand(rows)
    heads = [r for r in found if r["kept"]]
    assert len({r["row"] for r in heads}) == len({(r["class_id"], r["row"] if r["class_id"] is None else 0) for r in found})


def test_empty_table(documents):
    assert join_similar(documents([])).collect() == []


def test_depth_reaches_the_target():
    depth = matched_depth(0.8, 0.999)
    assert 1 - (1 - 0.8**depth) ** TREES >= 0.999 > 1 - (1 - 0.8 ** (depth + 1)) ** TREES
    assert matched_depth(0.8, 1.0 - 1e-15) < depth < matched_depth(0.95, 0.9) + 1


def test_components(spark):
    rng = random.Random(3)
    path = list(range(1000, 1300))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1, 2), (2, 2), (2, 1), (5, 4), (4, 3)] + [(10, n) for n in range(20, 400)]
    found = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    expected = {n: 1000 for n in path} | {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 10: 10} | {n: 10 for n in range(20, 400)}
    assert found == expected
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
