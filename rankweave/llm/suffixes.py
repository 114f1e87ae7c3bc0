"""Repeated byte strings by a distributed merge sort of suffixes that never re-compares a known common prefix.

Only suffixes at anchors are sorted. The anchor of a string of ``length`` bytes is the smallest hash of ``GRAM`` bytes
among its first ``width`` places, so equal strings have it at the same place. Strings that follow each other and share
their anchor are one entry: the bytes ``back`` before the anchor and ``forth`` from it on.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.groups import sorted_groups
from rankweave.llm.words import text_blocks
from rankweave.runtime import forget, shuffle_partitions, stored

LENGTH = 400
WIDTH = 200
GRAM = 16
HOT = 20_000  # entries with the same bytes from the anchor on that one task compares; the strings of more are grouped
RUN_BYTES = 16 << 20  # bytes of entries that are sorted at a time
RANGES_PER_PARTITION = 2
SAMPLES_PER_RANGE = 16

_SEGMENT = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)


def _smallest_places(data: np.ndarray, width: int, gram: int) -> np.ndarray:
    """For each place the smallest hash of ``gram`` bytes starting in the ``width`` places from there, the leftmost of equal ones."""
    padded = np.zeros(len(data) + 32, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.empty(len(data) + 16, dtype=np.uint64)
    for j in range(8):
        part = eight[j::8]
        part[:] = np.frombuffer(padded, dtype="<u8", count=len(part), offset=j)
    low = eight[: len(data)]
    if gram < 8:
        low = low & np.uint64((1 << 8 * gram) - 1)
    value = low * np.uint64(0x9E3779B97F4A7C15)
    if gram > 8:
        value ^= eight[gram - 8 : gram - 8 + len(data)] * np.uint64(0xC2B2AE3D27D4EB4F)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value &= ~_PLACE
    value |= np.arange(len(data), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        value, span = np.minimum(value[:-span], value[span:]), span * 2
    if width > span:
        value = np.minimum(value[: span - width], value[width - span :])
    return (value & _PLACE).astype(np.int64)


def anchors(texts: list[bytes], length: int, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """The entries of some texts, as arrays: text, first string's start, number of strings, anchor; places within the text."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    whole = np.ones(len(data), dtype=bool)
    for text, end in zip(texts, ends.tolist()):
        whole[max(end - len(text), end - length + 1) : end] = False
    found = []
    for begin in range(0, len(data), _SEGMENT):
        # The strings that start in this segment, and all that they hold.
        segment = data[begin : begin + _SEGMENT + length]
        starts = np.flatnonzero(whole[begin : begin + _SEGMENT])
        if len(starts):
            found.append((starts + begin, _smallest_places(segment, width, gram)[starts] + begin))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    starts, at = (np.concatenate(x) for x in zip(*found))
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first = starts[new]
    text = np.searchsorted(ends, first, side="right")
    base = np.concatenate([[0], ends])[text]
    return text, first - base, np.diff(np.append(new, len(starts))), at[new] - base


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings, of which ``known`` bytes are known to be equal."""
    end, step = min(len(a), len(b)), 16
    while known < end:
        stop = min(known + step, end)
        if a[known:stop] == b[known:stop]:
            known, step = stop, step * 2
        elif stop == known + 1:
            break
        else:
            step = (stop - known) // 2
            end = stop
    return known


def merge_runs(runs: list[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """Merge sorted runs of ``(common prefix with the entry before, string, rest)`` into one of the same form.

    A loser tree: each inner node keeps the loser of its match with the length of the prefix it shares with the winner.
    Of two entries that share different lengths with the last winner the longer one is smaller, without a look at the
    strings. Only where the lengths are equal are they compared, from that length on.
    """
    size = 1 << max(len(runs) - 1, 0).bit_length()
    strings, shared, rests = [b""] * size, [-1] * size, [()] * size  # a finished run shares -1 and loses every match

    def advance(i: int) -> None:
        entry = next(runs[i], None) if i < len(runs) else None
        shared[i], strings[i], rests[i] = entry or (-1, b"", ())

    def match(i: int, j: int) -> tuple[int, int]:
        if shared[i] != shared[j] or shared[i] < 0:
            return (i, j) if shared[i] >= shared[j] else (j, i)
        a, b = strings[i], strings[j]
        known = common(a, b, shared[i])
        winner, loser = (i, j) if known == len(a) or (known < len(b) and a[known] < b[known]) else (j, i)
        shared[loser] = known
        return winner, loser

    losers, winners = [0] * size, [0] * size + list(range(size))
    for i in range(size):
        advance(i)
        shared[i] = min(shared[i], 0)
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = match(winners[2 * node], winners[2 * node + 1])
    winner = winners[1] if size > 1 else 0
    while shared[winner] >= 0:
        yield shared[winner], strings[winner], rests[winner]
        advance(winner)
        node = (winner + size) // 2
        while node:
            winner, losers[node] = match(winner, losers[node])
            node //= 2


_ENTRY, _OWNER = "<iii?", "<qqq"  # shared, further and earlier bytes, without an owner; text, text, start


def encode_run(entries: list[tuple[bytes, bytes, tuple | None]]) -> bytes:
    """A sorted run front-coded: of each ``(forth, back, owner)`` the bytes of ``forth`` beyond its prefix shared with the last."""
    parts, last = [], b""
    for forth, back, owner in entries:
        known = common(last, forth)
        parts += [struct.pack(_ENTRY, known, len(forth) - known, len(back), owner is None), forth[known:], back]
        if owner is not None:
            parts.append(struct.pack(_OWNER, *owner))
        last = forth
    return b"".join(parts)


def decode_run(blob: bytes) -> Iterator[tuple[int, bytes, tuple]]:
    at, forth = 0, b""
    while at < len(blob):
        known, tail, behind, many = struct.unpack_from(_ENTRY, blob, at)
        at += struct.calcsize(_ENTRY)
        forth = forth[:known] + blob[at : at + tail]
        back = blob[at + tail : at + tail + behind]
        at += tail + behind
        owner = None
        if not many:
            owner, at = struct.unpack_from(_OWNER, blob, at), at + struct.calcsize(_OWNER)
        yield known, forth, (back, owner)


def repeats(cluster: list[tuple[int, bytes, tuple]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Which strings of entries that share their first bytes occur twice: ``(text, text, start, number of strings)``.

    The cluster is sorted, with shared prefixes. An entry without an owner is known to occur twice. The string that
    starts ``o`` bytes before the anchor is the last ``o`` bytes of ``back`` and the first ``length - o`` of ``forth``.
    How entries fall into classes of equal strings changes only at a few values of ``o``, which the shared lengths give.
    """
    owners: dict[tuple[bytes, bytes], list] = {}
    shared, smallest = [], length
    for known, forth, (back, owner) in cluster:
        smallest = min(smallest, known)
        if (forth, back) not in owners:
            owners[forth, back] = []
            shared.append(smallest)
            smallest = length
        owners[forth, back].append(owner)
    entries = list(owners.items())
    several = [len(found) > 1 or found[0] is None for _, found in entries]
    for ((forth, back), found), known in zip(entries, several):
        if known:
            for owner in found:
                if owner is not None:
                    yield *owner, len(back) + len(forth) - length + 1
    if len(entries) == 1 or all(several):
        return
    first = [length - len(forth) for (forth, _), _ in entries]
    last = [len(back) for (_, back), _ in entries]
    behind = sorted(back[::-1] for (_, back), _ in entries)
    changes = {*first, *(o + 1 for o in last), *(length - s for s in shared[1:]), *(common(a, b) + 1 for a, b in zip(behind, behind[1:]))}
    points = sorted(o for o in changes if min(first) <= o <= max(last) + 1)
    for o, end in zip(points, points[1:]):
        classes: dict[tuple[int, bytes], list[int]] = {}
        number = 0
        for i, ((_, back), _) in enumerate(entries):
            number += i > 0 and shared[i] < length - o
            if first[i] <= o <= last[i]:
                classes.setdefault((number, back[len(back) - o :]), []).append(i)
        for members in classes.values():
            if len(members) > 1:
                for i in members:
                    if not several[i]:
                        text, other, start = entries[i][1][0]
                        yield text, other, start + last[i] - (end - 1), end - o


def _arrays(kinds: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [pa.field(name, types[kind]) for name, kind in map(str.split, kinds.split(", "))]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


LIGHT = "k1 long, k2 long, n_bytes long, sha256 string, anchors array<int>, hashes array<long>"
PIECE = "range int, run binary, k1 long, k2 long, start long, n long, cluster long, back binary, forth binary"
COVER = "k1 long, k2 long, start long, n long"
SPANS = "array<struct<start:bigint,end:bigint>>"
CUT = f"k1 long, k2 long, n_removed long, spans {SPANS}, cut_sha256 string"
EMPTY = hashlib.sha256().hexdigest()


def dedup_repeats(
    documents: DataFrame, *, length: int = LENGTH, width: int = WIDTH, gram: int = GRAM, hot: int = HOT, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256`` for each row of ``documents``.

    Each byte covered by a string of ``length`` bytes that also starts elsewhere goes, whether in another text or the
    same; occurrences may overlap, and all are judged on the input. ``spans`` are the longest runs of removed bytes,
    as start and end in the UTF-8 text. A null text is empty. Null and repeated ids change nothing: rows are told apart
    as rows, so equal texts repeat each other. Other columns are ignored. No rows give no rows. Very long texts are
    read in segments, and their entries are spread like all others.

    Equal texts, by a 128-bit hash, are one text that is known to repeat. An entry can only repeat if the ``length -
    width + 1`` bytes from its anchor on do; their hashes are counted first, and entries that are alone in theirs do
    not travel. The others are sorted in each task, front-coded, exchanged by ranges of suffixes that a sample gives,
    and merged by loser trees. Entries of one task that are equal travel once. Where entries share more than
    ``length - width`` bytes from the anchor on, the shared lengths forwards and backwards tell which strings are
    equal. More than ``hot`` entries of this kind would be a hot task: their strings are grouped by all their bytes.
    """
    if width + gram - 1 > length or not 1 <= gram <= 16:
        raise ValueError("an anchor must lie within a string")
    spark = documents.sparkSession
    ahead = length - width + 1
    keyed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            data = b"".join(texts)
            text, _, _, anchor = anchors(texts, length, width, gram)
            base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            places = (base[text] + anchor).tolist()
            hashes = np.array([xxhash.xxh3_64_intdigest(data[a : a + ahead]) for a in places], dtype=np.uint64)
            offsets = np.searchsorted(text, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    _lists(offsets, anchor.astype(np.int32), pa.int32()), _lists(offsets, hashes.view(np.int64), pa.int64()),
                ],
                names=["doc_id", "k1", "k2", "n_bytes", "sha256", "anchors", "hashes"],
            )

    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    rows = stored(keyed.select("doc_id", "k1", "k2", "text").mapInArrow(light, f"doc_id {kind}, {LIGHT}"), "rows")
    texts = rows.where(F.col("n_bytes") >= length).groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"), F.first("anchors").alias("anchors"), F.first("hashes").alias("hashes")
    )
    texts = stored(texts, "texts")

    # Anchors whose bytes ahead occur at two places.
    placed = texts.select("k1", "k2", "copies", F.explode(F.arrays_zip("anchors", "hashes")).alias("at")).select(
        "k1", "k2", "copies", F.col("at.anchors").alias("anchor"), F.col("at.hashes").alias("cluster")
    )
    place = F.xxhash64("k1", "k2", "anchor")
    counted = placed.groupBy("cluster").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("entries"))
    shared = stored(counted.where("low < high").select("cluster", (F.col("entries") > hot).alias("hot")), "shared")
    wanted = (
        placed.join(shared, "cluster")
        .groupBy("k1", "k2")
        .agg(F.max("copies").alias("copies"), F.collect_list(F.struct("anchor", "cluster", "hot")).alias("wanted"))
    )
    first = keyed.where(F.octet_length("text") >= length).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    asked = stored(first.join(wanted, ["k1", "k2"]), "asked")

    # Ranges of suffixes from a sample, whose size is bounded by the number of shuffle partitions.
    ranges = RANGES_PER_PARTITION * shuffle_partitions(spark)
    total = asked.agg(F.sum(F.size("wanted"))).first()[0] or 0
    share = max(1, total // (ranges * SAMPLES_PER_RANGE))
    sample = asked.select("k1", F.encode("text", "utf-8").alias("bytes"), F.explode("wanted").alias("at")).where(
        F.pmod(F.xxhash64("k1", "at.anchor"), F.lit(share)) == 0
    )
    drawn = sorted(row[0] for row in sample.select(F.expr(f"substring(bytes, at.anchor + 1, {ahead})")).limit(2 * ranges * SAMPLES_PER_RANGE).collect())
    borders = sorted({bytes(drawn[i * len(drawn) // ranges]) for i in range(1, ranges)}) if drawn else []
    split = spark.sparkContext.broadcast(borders)

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = split.value
        held: dict[tuple, tuple | None] = {}
        covers: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ordered = sorted((forth, back, owner) for (forth, back, cluster), owner in held.items() if cluster is None)
            begin = 0
            for r in range(len(borders) + 1):
                end = len(ordered)
                if r < len(borders):
                    end = bisect_left(ordered, borders[r], begin, key=lambda entry: entry[0][:ahead])
                if end > begin:
                    run = encode_run(ordered[begin:end])
                    yield _arrays(PIECE, [(r, run, None, None, None, None, None, None, None)])
                begin = end
            spread = [
                (None, None, *(owner or (None, None, None)), None, cluster, back, forth)
                for (forth, back, cluster), owner in held.items()
                if cluster is not None
            ]
            for rows in (spread, [(None, None, *cover, None, None, None) for cover in covers]):
                if rows:
                    yield _arrays(PIECE, rows)

        for batch, texts in text_blocks(batches):
            text, start, n, anchor = anchors(texts, length, width, gram)
            k1, k2, copies = (batch.column(c).to_pylist() for c in ("k1", "k2", "copies"))
            asked_for = batch.column("wanted")
            at = asked_for.flatten()
            of_text = np.repeat(np.arange(len(texts)), asked_for.value_lengths().to_numpy())
            clusters = dict(
                zip(
                    zip(of_text.tolist(), at.field("anchor").to_pylist()),
                    (c if h else None for c, h in zip(at.field("cluster").to_pylist(), at.field("hot").to_pylist())),
                )
            )
            for t, s, count, a in zip(text.tolist(), start.tolist(), n.tolist(), anchor.tolist()):
                if (t, a) not in clusters:
                    continue
                whole = texts[t]
                entry = (whole[a : s + count - 1 + length], whole[s:a], clusters[t, a])
                owner = (k1[t], k2[t], s) if copies[t] == 1 else None
                if entry not in held:
                    held[entry] = owner
                    size += len(entry[0]) + len(entry[1])
                else:
                    # Twice in this task: settled here, and it travels without an owner.
                    covers += [(*known, count) for known in (held[entry], owner) if known is not None]
                    held[entry] = None
            if size > run_bytes:
                yield from flush()
                held, covers, size = {}, [], 0
        yield from flush()

    pieces = stored(asked.select("k1", "k2", "copies", "wanted", "text").mapInArrow(sort_runs, PIECE), "pieces")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in sorted_groups(batches, ["range"]):
            covers: list[tuple] = []
            cluster: list[tuple] = []
            for entry in merge_runs([decode_run(run) for run in table.column("run").to_pylist()]):
                if entry[0] < ahead and cluster:
                    covers += repeats(cluster, length) if len(cluster) > 1 else ()
                    cluster = []
                    if len(covers) > 10_000:
                        yield _arrays(COVER, covers)
                        covers = []
                cluster.append(entry)
            covers += repeats(cluster, length) if len(cluster) > 1 else ()
            yield _arrays(COVER, covers)

    runs = pieces.where("run is not null").select("range", "run").repartition(shuffle_partitions(spark), "range")
    merged = runs.sortWithinPartitions("range").mapInArrow(merge, COVER)

    # Strings of hot clusters, grouped by their bytes on both sides of those that the cluster shares.
    spread = pieces.where("forth is not null").withColumn("o", F.explode(F.sequence(F.lit(length) - F.length("forth"), F.length("back"))))
    string = F.expr(f"concat(substring(back, length(back) - o + 1, o), substring(forth, {ahead + 1}, {length - ahead} - o))")
    spread = spread.select(
        "cluster", F.xxhash64(F.expr(f"substring(forth, 1, {ahead})")).alias("middle"), "o", string.alias("string"),
        "k1", "k2", (F.col("start") + F.length("back") - F.col("o")).alias("start"),
    )
    string_of = ["cluster", "middle", "o", "string"]
    twice = spread.groupBy(*string_of).agg(
        F.count(F.lit(1)).alias("entries"), F.count("start").alias("owned")
    )
    twice = stored(twice.where("entries > 1 and owned > 0").select(*string_of), "twice")
    grouped = spread.where("start is not null").join(twice, string_of).select("k1", "k2", "start", F.lit(1).cast("long").alias("n"))

    covers = pieces.where("n is not null").select("k1", "k2", "start", "n").unionByName(merged).unionByName(grouped)
    covered = stored(covers.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("covers")), "covers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests = [], [], []
            for text, covers in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("covers").to_pylist()):
                spans.append(join_spans([(c["start"], c["start"] + c["n"] - 1 + length) for c in covers]))
                removed.append(sum(end - start for start, end in spans[-1]))
                digests.append(hashlib.sha256(without(text, spans[-1])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"), batch.column("k2"), pa.array(removed, pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(digests, pa.string()),
                ],
                names=["k1", "k2", "n_removed", "spans", "cut_sha256"],
            )

    single = asked.where("copies = 1").select("k1", "k2", "text").join(covered, ["k1", "k2"])
    several = texts.where("copies > 1").select("k1", "k2", F.lit(-1).cast("long").alias("n_removed"), F.lit(None).cast(SPANS).alias("spans"), F.lit(EMPTY).alias("cut_sha256"))
    outcome = stored(single.mapInArrow(cut, CUT).unionByName(several), "outcome")
    for table in (texts, shared, asked, pieces, twice, covered):
        forget(table)
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    gone = F.col("n_removed") == -1
    return rows.select("doc_id", "k1", "k2", "n_bytes", "sha256").join(outcome, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, all_of).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
    )


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as the longest runs."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside of joined spans."""
    places = [0, *(at for span in spans for at in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(places[::2], places[1::2]))
