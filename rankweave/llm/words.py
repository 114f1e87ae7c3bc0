"""Words of many texts at once: numpy over the bytes of a block of texts.

A word is a longest run of characters other than blank, tab, line feed, vertical tab, form feed and carriage
return. These six are single bytes in UTF-8 and occur in no other character, so bytes can be split directly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BLOCK_BYTES = 1 << 20  # texts are taken in blocks of about this size, or one at a time if longer

_random = np.random.RandomState(20240229)
_BYTE = _random.randint(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; distinct numbers stay distinct."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts: byte ranges in ``data``, and for text i the words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        heads = np.cumsum(lengths) - lengths
        within = np.arange(lengths.sum()) - np.repeat(heads, lengths)
        powers = np.ones(int(lengths.max()), dtype=np.uint64)
        powers[1:] = _POWER
        powers = np.multiply.accumulate(powers)
        values = _BYTE[self.data[within + np.repeat(self.starts, lengths)]] * powers[within]
        return mix(np.add.reduceat(values, heads))

    def text(self, begin: int, end: int) -> bytes:
        """Words ``begin`` to ``end`` joined by one blank."""
        return b" ".join(self.data[self.starts[begin] : self.ends[end - 1]].tobytes().split()) if end > begin else b""


def split_words(texts: list[bytes], spaces: np.ndarray = SPACES) -> Words:
    """``spaces`` tells for each byte whether it separates words; a blank always does."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
    space = spaces[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    borders = np.cumsum([1] + [len(text) + 1 for text in texts])
    return Words(data, starts, ends, np.searchsorted(starts, borders))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive entries; one with other texts inside is up to the caller."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    shift = 1
    for k in range(size):
        shift = (shift * int(_POWER) + 2 * k) % 2**64
        total += mix(hashes[k : k + count] + np.uint64(shift))
    return mix(total)


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8; null as empty."""
    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]


def text_blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches into blocks of whole texts, each of about ``BLOCK_BYTES`` or a single longer text."""
    for batch in batches:
        texts = byte_column(batch, text)
        begin = size = 0
        for i, value in enumerate(texts):
            if size and size + len(value) > BLOCK_BYTES:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(value)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]
