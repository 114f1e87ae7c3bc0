from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from rankweave.llm.substrings import _leftmost_smallest, dedup_substrings, super_kmers

WORD = re.compile("[^\x20\x09-\x0d]+")


def by_hand(rows, size):
    order = {i: (i is None, i) for i, _ in rows}
    first = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - size + 1):
            w = tuple(words[k : k + size])
            first[w] = min(first.get(w, order[i]), order[i])
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        keep = [True] * len(words)
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < order[i]:
                keep[k : k + size] = [False] * size
        kept = " ".join(w for w, k in zip(words, keep) if k)
        out.append((i, len(words), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(size):
    rng = random.Random(6)

    def fresh(n):
        return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    passage, long = fresh(size + 7), fresh(4 * size)
    rows = [(i, " ".join(fresh(rng.randint(0, 30)) + passage + fresh(rng.randint(0, 30)))) for i in range(40)]  # one hot passage
    rows += [(100 + i, "\t".join(long)) for i in range(4)] + [(90, " \n ".join(long[3:-2])), (200, " ".join(long[:size] + long[size + 1 :]))]
    rows += [(300 + i, " ".join(["same"] * (size + i))) for i in range(5)] + [(400, "a b " * size), (401, "b a " * size)]
    rows += [(500, None), (501, ""), (502, " \x0b "), (None, " ".join(long)), (None, " ".join(passage)), (7, rows[7][1]), (8, " ".join(long))]
    rows += [(600, "é\U0001f600 " + "x" * 200_000 + " " + " ".join(passage)), (601, " ".join(passage[: size - 1]))]
    return rows


@pytest.mark.parametrize(("size", "bucket"), [(50, 200), (50, 3), (12, 5)])
def test_equals_brute_force(documents, size, bucket):
    rows = corpus(size)
    found = dedup_substrings(documents(rows, extra=True), window=size, minimiser=4, bucket=bucket).collect()
    assert sorted(map(tuple, found), key=str) == by_hand(rows, size)


@pytest.mark.parametrize("bucket", [200, 3])
def test_rows_without_an_id_and_of_one_id(documents, bucket):
    """Each string of a document is fetched from one of its rows, and found in all."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    rows = [(None if i % 2 else i % 4, " ".join([f"a{i}"] * 3 + passage[: 30 + i % 11] + [f"b{i % 5}"] * 3)) for i in range(40)]
    rows += [(None, rows[1][1])] * 3 + [(-1, " ".join(["x"] + passage[4:33] + ["y"])), (0, rows[0][1])]
    rng.shuffle(rows)
    found = dedup_substrings(documents(rows), window=12, minimiser=4, bucket=bucket).collect()
    order = {i: (i is None, i) for i, _ in rows}
    assert sorted(map(tuple, found), key=str) == by_hand(rows, 12) and len(order) < len(rows)


def test_many_rows_without_an_id_take_time_in_proportion(documents):
    def seconds(count):
        rng = random.Random(10)
        passage = [f"p{i}" for i in range(60)]
        rows = [(None, " ".join([f"w{rng.randint(0, 10**6)}" for _ in range(20)] + passage[: rng.randint(50, 60)])) for _ in range(count)]
        start = time.perf_counter()
        assert dedup_substrings(documents(rows)).where("n_removed > 0").count() == 0
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20_000) < 5 * seconds(2_000) + 20


def test_empty_table(documents):
    assert dedup_substrings(documents([])).collect() == []


def test_leftmost_smallest():
    values = np.random.RandomState(0).randint(0, 5, 200)
    for width in (1, 2, 7, 43):
        found = _leftmost_smallest(values, width)
        assert found.tolist() == [k + int(np.argmin(values[k : k + width])) for k in range(200 - width + 1)]


def test_runs_cover_every_window_once():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)).encode() for n in (0, 3, 10, 11, 60, 200)]
    text, start, n, _, run = super_kmers(texts, 10, 4)
    seen = sorted((t, s + k) for t, s, count in zip(text, start, n) for k in range(count))
    assert seen == [(t, k) for t, value in enumerate(texts) for k in range(len(value.split()) - 9)]
    again = super_kmers([texts[5][4:]], 10, 4)
    assert set(again[4].tolist()) & set(run.tolist())
