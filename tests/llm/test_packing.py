from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from rankweave.llm.packing import Packer, Tokens, pack
from rankweave.llm.queries import tokenizer_files

FILES = tokenizer_files()


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILES["vocabulary"])
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers_file(reference):
    rng = random.Random(5)
    alphabet = list("aab'sé 1²Ⅷ.,-\n\t    　​\x1c\x85\r\x0b中ß\U0001f600ाी٣_") + ["'ll", "don't", " the", "  ", "Ünïcode", "\n\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "a <|endoftext|> b", "<|endoftext|>", " <|endoftext|><|endoftext|> x", "word " * 300, "z" * 3000, "a" * 70 + " b"]
    tokens = Tokens(**FILES)
    texts += [" ".join(rng.choice(["the", "rivers,", "don't", "é\nß", "\u3000x", "1²", "中"]) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    for text, ids in zip(texts, tokens.block(texts), strict=True):
        assert ids.tolist() == reference(text) == tokens(text).tolist(), repr(text)


@pytest.mark.parametrize("space", [" ", "\n", "\t", "\r\n", " \n", "\u3000", "a b", "ab", "9", "!"])
def test_a_million_of_the_same_characters(reference, space):
    """Runs of white space and of others, alone, between words, at an end, and beside ordinary texts in a block."""
    run = space * (1_000_000 // len(space))
    tokens = Tokens(**FILES)
    texts = ["a word", run, f"some words{run}and more", f"{run} x", f"x {run}"] if space.isspace() else ["a word", run]
    for text, ids in zip(texts, tokens.block(texts), strict=True):
        assert ids.tolist() == reference(text)


def check(found, rows, reference, window):
    found = [r.asDict() for r in found]
    expected = sorted((i is None, i or 0, [*reference(t or ""), 1]) for i, t in rows)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        padded = {r["padded_length"] for r in pieces}
        assert len(padded) == 1 and at <= padded.pop() <= window
    ids_of = {}
    for is_null, i, ids in expected:
        ids_of.setdefault(None if is_null else i, ids)
    for i, ids in ids_of.items():
        mine = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["start"])
        copies = sum(1 for n, k, _ in expected if (None if n else k) == i)
        assert {r["doc_tokens"] for r in mine} == {len(ids)} and sum(r["length"] for r in mine) == copies * len(ids)
        for r in mine:
            raw = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert zlib.crc32(raw) == r["ids_crc32"]
    return sum(max(r["padded_length"] for r in p) for p in by_sequence.values()) / sum(len(ids) for _, _, ids in expected) - 1


@pytest.mark.parametrize("partitions", [1, 6])
def test_round_trip(documents, reference, partitions):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(["the ", "of ", "Stone ", "rivers, ", "é\n"]) for _ in range(int(rng.paretovariate(0.9) * 20) % 9000))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "x " * 30_000), (5, rows[5][1]), (5, rows[5][1]), (None, "null id")]
    df = documents(rows, extra=True).repartition(partitions, "doc_id")
    assert check(pack(df, **FILES).collect(), rows, reference, 2048) < 0.01


def test_small_and_empty_tables(documents, reference):
    assert pack(documents([]), **FILES).collect() == []
    (row,) = pack(documents([(3, "")]), **FILES).collect()
    assert (row["length"], row["doc_tokens"], row["offset"], row["padded_length"]) == (1, 1, 0, 1)


def test_open_windows_are_bounded():
    packer = Packer(100, 4, 5)
    rng, placed, closed = random.Random(1), 0, 0
    for i in range(2000):
        n = rng.randint(1, 130)
        placed += n
        for pieces in packer.add(i, np.zeros(n, dtype="<u4")):
            size = sum(len(ids) for _, _, ids in pieces)
            assert 95 <= size <= 100
            closed += size
        assert len(packer.open) <= 4
    assert placed - closed == sum(100 - w[0] for w in packer.open)
