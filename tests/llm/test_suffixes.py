from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from rankweave.llm import suffixes
from rankweave.llm.suffixes import anchors, common, decode_run, dedup_repeats, encode_run, merge_runs

SMALL = {"length": 20, "width": 10, "gram": 4}


def by_hand(rows, length=20):
    """Per row: bytes, removed bytes, spans, hash of what is left."""
    texts = [(text or "").encode() for _, text, *_ in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        left = bytes(c for c, g in zip(t, gone) if not g)
        spans = [p for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1])]
        out.append((str(i), len(t), sum(gone), len(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def found(df):
    rows = df.collect()
    for r in rows:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows)


def texts(seed, count=120):
    """Pieces that many texts share, cut and joined at random, some changed in a letter; runs of one letter; copies."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 60))) for _ in range(12)] + ["a" * 50, "ab" * 30]
    made = []
    for _ in range(count):
        text = "".join(rng.choice(pieces)[rng.randint(0, 8) :] for _ in range(rng.randint(0, 6)))
        if text and rng.random() < 0.5:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("xyz") + text[at + 1 :]
        made.append(text)
    return made + made[:10] + [None, "", "a" * 19, "a" * 20, "b" * 300]


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"run_bytes": 300}), (3, {"hot": 3}), (4, {"hot": 0, "run_bytes": 300})])
def test_equals_a_count_of_all_strings(spark, documents, seed, options):
    """One run, many runs, and with some or all entries grouped as those of a hot cluster."""
    rows = list(enumerate(texts(seed)))
    assert found(dedup_repeats(documents(rows, extra=True), **SMALL, **options)) == by_hand(rows)


def test_nulls_and_repeated_ids(spark, documents):
    shared = "the same thirty letters in all of them"
    rows = [(None, shared), (None, shared + " x"), (1, "y " + shared), (1, "y " + shared), (1, "no such string in the others")]
    assert found(dedup_repeats(documents(rows), **SMALL)) == by_hand(rows)


def test_usual_lengths(spark, documents):
    rng = random.Random(5)
    words = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "änderung"]) for _ in range(90)) for _ in range(30)]
    rows = [(i, words[i % 30][: rng.randint(300, 700)] + str(i) + words[(i * 7) % 30]) for i in range(60)]
    assert found(dedup_repeats(documents(rows))) == by_hand(rows, 400)


def test_long_texts_are_read_in_segments(spark, documents, monkeypatch):
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"ab") for _ in range(5000)), b"a" * 3000]
    whole = anchors(texts, 20, 10, 4)
    monkeypatch.setattr(suffixes, "_SEGMENT", 100)
    assert all((a == b).all() for a, b in zip(whole, anchors(texts, 20, 10, 4)))


def test_a_text_of_one_letter(spark, documents):
    rows = [(1, "a" * 300_000), (2, "b" * 400)]
    assert [r[2:4] for r in found(dedup_repeats(documents(rows)))] == [(300_000, 1), (0, 0)]


def test_empty_table(spark, documents):
    assert dedup_repeats(documents([])).collect() == []


@pytest.mark.parametrize("count", [0, 1, 2, 3, 8, 13])
def test_merging_keeps_the_order_and_the_shared_lengths(count):
    rng = random.Random(count)
    runs = []
    for _ in range(count):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40)))
        runs.append([(string, b"back", (1, 2, k) if k % 2 else None) for k, string in enumerate(strings)])
    merged = list(merge_runs([decode_run(encode_run(run)) for run in runs]))
    assert [m[1] for m in merged] == sorted(e[0] for run in runs for e in run)
    assert Counter((m[1], *m[2]) for m in merged) == Counter(e for run in runs for e in run)
    for before, after in zip(merged, merged[1:]):
        assert after[0] == common(before[1], after[1])


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """Runs whose entries share more and more: each byte is compared about once a run, not once a match."""
    looked = 0

    def counting(a, b, known=0):
        nonlocal looked
        at = common(a, b, known)
        looked += at - known + 1
        return at

    prefix = b"p" * 1000
    runs = [[(prefix + b"%04d" % (8 * i + r), b"", None) for i in range(50)] for r in range(8)]
    blobs = [encode_run(run) for run in runs]
    monkeypatch.setattr(suffixes, "common", counting)
    assert len(list(merge_runs([decode_run(blob) for blob in blobs]))) == 400
    assert looked < 8 * 1000 + 400 * 3 * 6
