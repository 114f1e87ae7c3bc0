"""Packing token sequences: bounded-space online best-fit, with the leftovers of all partitions merged at the end."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.words import split_words
from rankweave.runtime import stored

WINDOW = 2048
END_ID = 1
OPEN_WINDOWS = 16
MAX_PADDING = 16  # a window with at most so many places left is emitted as it is
MERGE_PARTITIONS = 128  # the leftovers of so many partitions are merged by one task
BLOCK_CHARS = 2_000_000  # texts are encoded in blocks of about this size

OTHER_SPACE = re.compile(r"[^\S ]")
SPECIAL = "<|endoftext|>"
LONG_SPACE = re.compile(r"(?<!\s)\s{10000}")  # the faster encoder fails on a run of white space of some hundred thousand
ONLY_BLANK = np.zeros(256, dtype=bool)
ONLY_BLANK[32] = True


def blanks_part(text: str) -> bool:
    """Whether every blank stands alone between two characters that are not white space, and none of that is at an end."""
    if "  " in text or text[:1].isspace() or text[-1:].isspace():
        return False
    around = (text[m.start() - 1 : m.start() + 2 : 2] for m in OTHER_SPACE.finditer(text))
    return not any(" " in two for two in around)


class Tokens:
    """Ids of whole texts as the ``tokenizers`` file gives them.

    Its merges never cross a blank that stands alone between words, so the distinct words of a block of texts are
    encoded together, once, and told apart by the bytes of their ids. Texts with other white space around blanks are
    encoded whole. The rank file has the same vocabulary and is faster; a text with a special token or a very long run
    of white space in it goes through the other file.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self._bytes = np.zeros(max(merges.values()) + 1, dtype=np.int64)
        self._bytes[list(merges.values())] = [len(token) for token in merges]
        self._vocabulary = vocabulary
        self._whole = None

    def block(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [SPECIAL not in text and not LONG_SPACE.search(text) for text in texts]
        parted = [i for i, text in enumerate(texts) if text and plain[i] and blanks_part(text)]
        found = dict(zip(parted, self._by_words([texts[i] for i in parted])))
        return [found[i] if i in found else self._one(text, plain[i]) for i, text in enumerate(texts)]

    def _one(self, text: str, plain: bool) -> np.ndarray:
        if plain:
            return np.array(self._encode(text), dtype="<u4")
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._vocabulary)
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        words = split_words([text.encode() for text in texts], ONLY_BLANK)
        _, example, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        starts, ends = words.starts[example], words.ends[example]
        data = words.data.tobytes()
        # The byte before a word is a blank.
        joined = b"".join([data[a - 1 : b] for a, b in zip(starts.tolist(), ends.tolist())]).decode()
        ids = np.array(self._encode(joined), dtype="<u4")
        end = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(ends - starts + 1)) + 1
        begin = np.concatenate([[0], end[:-1]])
        count = (end - begin)[number]
        stop = np.cumsum(count)
        placed = ids[np.arange(stop[-1]) + np.repeat(begin[number] - (stop - count), count)]
        out = []
        for text, a, b in zip(texts, words.first, words.first[1:]):
            # The first word of a text has no blank before it.
            head = np.array(self._encode(text[: text.find(" ")] if " " in text else text), dtype="<u4")
            out.append(np.concatenate([head, placed[stop[a] : stop[b - 1]]]))
        return out

    def __call__(self, text: str) -> np.ndarray:
        return self.block([text])[0]


def text_groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``BLOCK_CHARS`` together, with the place of the first."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_CHARS or i == len(texts) - 1:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0


class Packer:
    """Keeps ``space`` open windows and hands full ones to ``emit``, each a list of pieces (key, start, ids)."""

    def __init__(self, window: int, space: int, max_padding: int):
        self.window, self.space, self.max_padding = window, space, max_padding
        self.open: list[list] = []  # [places left, pieces]

    def add(self, key, ids: np.ndarray, start: int = 0) -> Iterator[list]:
        """Place ids that belong together; yields the windows this closes.

        A document longer than a window fills windows of its own first. The rest goes to the open window that it fits
        best. If it fits none and no other may be opened, the fullest window is emitted, after the first part of the
        rest has filled it, unless it is as good as full.
        """
        while len(ids) >= self.window:
            yield [(key, start, ids[: self.window])]
            ids, start = ids[self.window :], start + self.window
        while len(ids):
            fitting = [w for w in self.open if w[0] >= len(ids)]
            if fitting:
                best = min(fitting, key=lambda w: w[0])
            elif len(self.open) < self.space:
                best = [self.window, []]
                self.open.append(best)
            else:
                best = min(self.open, key=lambda w: w[0])
                if best[0] <= self.max_padding:
                    self.open.remove(best)
                    yield best[1]
                    continue
            n = min(best[0], len(ids))
            best[1].append((key, start, ids[:n]))
            best[0] -= n
            ids, start = ids[n:], start + n
            if not best[0]:
                self.open.remove(best)
                yield best[1]


PIECE = (
    "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_FIELDS = [(n, pa.int64()) for n in ("key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
SCHEMA = pa.schema([*_FIELDS, ("ids", pa.binary())])


def _rows(sequence: int, pieces: list, with_ids: bool) -> Iterable[tuple]:
    offset = 0
    for (key, total), start, ids in pieces:
        raw = ids.tobytes()
        yield key, start, len(ids), zlib.crc32(raw), total, sequence, offset, raw if with_ids else None
        offset += len(ids)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def pack(
    documents: DataFrame,
    *,
    vocabulary: str,
    ranks: str,
    pattern: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    max_padding: int = MAX_PADDING,
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length``.

    Each document is its ids and ``end_id``; a null text counts as empty, so it is ``end_id`` alone. Every id lies in
    one piece. Pieces of a sequence follow each other from offset 0. ``padded_length`` is ``window``, or a smaller
    power of two where that holds the sequence. Repeated rows are documents of their own. An empty table gives an
    empty result.

    Each partition keeps ``open_windows`` windows, so a task's memory does not depend on its rows. What is open at its
    end is stored with its ids; the leftovers of ``MERGE_PARTITIONS`` partitions make one task, which packs them in the
    same way, so one window of these may stay half empty.
    """
    spark = documents.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = Tokens(vocabulary, ranks, pattern), Packer(window, open_windows, max_padding)
        sequence = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for begin, texts in text_groups([text or "" for text in batch.column("_text").to_pylist()]):
                rows: list[tuple] = []
                for key, found in zip(keys[begin:], tokens.block(texts)):
                    ids = np.append(found, np.array([end_id], dtype="<u4"))
                    for pieces in packer.add((key, len(ids)), ids):
                        rows += _rows(sequence, pieces, False)
                        sequence += 1
                yield _batch(rows)
        for _, pieces in packer.open:
            yield _batch(list(_rows(-1 - sequence, pieces, True)))  # below 0: not yet packed
            sequence += 1

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, open_windows, 0)
        sequence = (1 << 62) + (TaskContext.get().partitionId() << 32)
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype="<u4")
                for pieces in packer.add((row["key"], row["doc_tokens"]), ids, row["start"]):
                    rows += _rows(sequence, pieces, False)
                    sequence += 1
            yield _batch(rows)
        # What is still open is cut to fill the fullest windows first.
        rest = sorted(packer.open, key=lambda w: w[0])
        last = Packer(window, 1, 0)
        closed = [done for _, pieces in rest for key, start, ids in pieces for done in last.add(key, ids, start)]
        for pieces in [*closed, *(w[1] for w in last.open)]:
            yield _batch(list(_rows(sequence, pieces, False)))
            sequence += 1

    keyed = documents.select(F.col(doc_id).cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("_text"))
    dealt = stored(keyed.mapInArrow(deal, PIECE), "pieces")
    open_pieces = dealt.where("sequence_id < 0")
    # The number of the partition that left a piece is in its sequence id.
    group = F.shiftright(-1 - F.col("sequence_id"), 32 + MERGE_PARTITIONS.bit_length() - 1)
    grouped = open_pieces.withColumn("_group", group).repartition("_group")
    ordered = grouped.sortWithinPartitions("_group", F.col("sequence_id").desc(), "offset").drop("_group")
    merged = stored(ordered.mapInArrow(merge, PIECE), "merged")
    pieces = dealt.where("sequence_id >= 0").unionByName(merged).drop("ids")
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("_filled"))
    power = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_filled").cast("double")))).cast("long")
    return (
        pieces.join(filled, "sequence_id")
        .withColumnRenamed("key", "doc_id")
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
            F.least(power, F.lit(window)).alias("padded_length"),
        )
    )
