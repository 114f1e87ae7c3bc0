from __future__ import annotations

import random

import pytest

from rankweave.llm.mixing import mix_sources


def by_hand(sizes):
    """Targets by repeated resharing of what is above a cap."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while rest > 1e-9 and free:
        whole = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / whole
        rest = 0.0
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        source = rng.choice(["a"] * 10 + ["b", "c", "d", "é", "Z", None])
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), "en", source))
    rows += [(5000 + i, "same text here", "en", "b") for i in range(400)] + [(9000, None, "en", "a"), (9001, "", "en", "empty"), (9002, " \n", "en", "empty")]
    return rows


def test_targets_and_words_taken(documents):
    rows = corpus()
    found = mix_sources(documents(rows, extra=True)).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    size = {i: len((t or "").split()) for i, t, _, _ in rows}
    sizes = {}
    for i, _, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    target = by_hand(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    largest = {s: max(size[i] for i, _, _, x in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-3 * target[s] for s in sizes)


def test_reruns_and_partitions_agree(documents, conf):
    df = documents(corpus())
    first = sorted(tuple(r) for r in mix_sources(df).select("doc_id", "taken").collect())
    conf(shuffle__partitions=3)
    assert sorted(tuple(r) for r in mix_sources(df.repartition(7)).select("doc_id", "taken").collect()) == first


def test_many_sources_and_rows_without_an_id(documents, conf):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(0, 9)), "en", f"s{rng.randrange(700)}") for i in range(1500)]
    rows += [(None, "some equal words", "en", "s1")] * 900
    df = documents(rows)
    found = mix_sources(df).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    target = by_hand(sizes)
    assert all(r["target"] == pytest.approx(target[r["source"]]) for r in found)
    taken = sum(r["taken"] for r in found if r["source"] == "s1")
    assert abs(taken - target["s1"]) <= 9 + 1e-3 * target["s1"]
    conf(shuffle__partitions=3)
    again = mix_sources(df.repartition(5)).select("doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mix_sources(df).select("doc_id", "taken").collect())


def test_small_tables(documents):
    assert mix_sources(documents([])).collect() == []
    (row,) = mix_sources(documents([(1, None)])).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)
    rows = [(1, "a b c", "en", "s")] * 4
    assert sum(r["taken"] for r in mix_sources(documents(rows)).collect()) == 18


def test_no_python_in_the_plan(documents):
    plan = mix_sources(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
