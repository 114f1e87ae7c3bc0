from __future__ import annotations

import random
import re

import numpy as np

from rankweave.llm.words import BLOCK_BYTES, split_words, text_blocks, windows

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_words_are_runs_between_the_six_blanks():
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \t\n\x0b\x0c\rabé  \x1c\U0001f600") for _ in range(n)) for n in range(60)]
    words = split_words([t.encode() for t in texts])
    for i, text in enumerate(texts):
        found = [
            words.data[a:b].tobytes().decode()
            for a, b in zip(words.starts[words.first[i] : words.first[i + 1]], words.ends[words.first[i] : words.first[i + 1]])
        ]
        assert found == WORD.findall(text)


def test_hashes_tell_words_apart():
    texts = [b"a b ab ba aa aaa a", b"", b"b", ("x" * 5000 + " " + "x" * 5001).encode()]
    words = split_words(texts)
    hashes = words.hashes()
    plain = [w for t in texts for w in t.split()]
    assert len({int(h) for h in hashes}) == len(set(plain))
    assert hashes[0] == hashes[6]


def test_windows():
    hashes = np.arange(1, 10, dtype=np.uint64)
    assert len(windows(hashes, 5)) == 5 and len(windows(hashes, 10)) == 0
    assert windows(hashes[:5], 5)[0] == windows(hashes, 5)[0]
    assert windows(hashes[:5][::-1], 5)[0] != windows(hashes, 5)[0]


def test_blocks_hold_whole_texts():
    import pyarrow as pa

    texts = ["a" * (BLOCK_BYTES // 3), None, "b" * (3 * BLOCK_BYTES), "c", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(5))], names=["text", "n"])
    blocks = list(text_blocks([batch]))
    assert [t for _, part in blocks for t in part] == [(t or "").encode() for t in texts]
    assert [n for part, _ in blocks for n in part.column("n").to_pylist()] == list(range(5))
    assert len(blocks) == 3
