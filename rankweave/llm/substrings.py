"""Substring dedup: windows of words that also start in a smaller document, by super-k-mer partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.groups import sorted_groups
from rankweave.llm.words import byte_column, mix, split_words, text_blocks, windows
from rankweave.runtime import shuffle_partitions, stored

WINDOW = 50
MINIMISER = 8
BUCKET = 200  # distinct packed strings that one bucket sorts; windows of larger ones are dealt by their own hashes

_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each slice of ``values``, which does not depend on its place."""
    n = len(values) + 1
    forth, back = np.full(n, _STEP), np.full(n, _BACK)
    forth[0] = back[0] = 1
    forth, back = np.multiply.accumulate(forth), np.multiply.accumulate(back)
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum(values * forth[:-1], out=sums[1:])
    return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` consecutive values is, the leftmost of equal ones."""
    at, span = np.arange(len(values)), 1

    def better(left, right):
        return np.where(values[left] <= values[right], left, right)

    while span * 2 <= width:
        at, span = better(at[: len(at) - span], at[span:]), span * 2
    shift = width - span
    return better(at[: len(at) - shift], at[shift:]) if shift else at


def super_kmers(texts: list[bytes], window: int, size: int):
    """Runs of consecutive windows with their minimiser at the same place.

    Returns arrays: text, first word within its text, number of windows, minimiser, hash of the run's words.
    """
    words = split_words(texts)
    hashes = words.hashes()
    empty = np.zeros(0, dtype=np.int64)
    if len(hashes) < window:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = windows(hashes, size)
    place = _leftmost_smallest(grams, window - size + 1)
    counts = np.diff(words.first)
    text_of = np.repeat(np.arange(len(texts)), counts)
    starts = np.flatnonzero(text_of[: len(place)] == text_of[window - 1 :][: len(place)])
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    at = place[starts]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    length = np.diff(np.append(new, len(starts)))
    first = starts[new]
    run = _ranges(mix(hashes), first, first + length + window - 1)
    text = text_of[first]
    return text, first - words.first[text], length, grams[at[new]], run


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


RUN = "row long, doc long, start long, n long, minimiser long, run long"
PIECE = "row long, doc long, start long, n long, minimiser long, run long, at long, packed binary, w1 long, w2 long"
COVER = "row long, doc long, start long, n long, minimiser long, run long, at long"


def _batch(names: str, columns: list) -> pa.RecordBatch:
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [pa.field(name, types[kind]) for name, kind in map(str.split, names.split(", "))]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def dedup_substrings(documents: DataFrame, *, window: int = WINDOW, minimiser: int = MINIMISER, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``documents``.

    A word goes if a window of ``window`` consecutive words that covers it has the same words as one that starts in a
    document of smaller id. All windows are judged on the input. A null text counts as empty. Null ids are larger than
    all others, and not smaller than each other. Rows of one id are one document, so they remove nothing from each
    other. An empty table gives an empty result.

    The run of windows that share a minimiser, the smallest hash of ``minimiser`` words in them, is one super-k-mer.
    First only hashes of super-k-mers are counted. An equal one in a smaller document settles all windows of a
    super-k-mer. Those of one minimiser that differ travel, one packed string of each, to the minimiser's bucket, where
    their windows are sorted as words. A bucket of over ``bucket`` strings would be a hot task: its windows are dealt
    by 128-bit hashes of their own and reduced to the smallest document before they move.
    """
    spark = documents.sparkSession
    keyed = documents.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
    ).withColumn("row", F.xxhash64("doc", "text"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            text, start, n, smallest, run = super_kmers(texts, window, minimiser)
            row, doc = (batch.column(c).to_numpy()[text] for c in ("row", "doc"))
            yield _batch(RUN, [_signed(c) for c in (row, doc, start, n, smallest, run)])

    light = stored(keyed.select("row", "doc", "text").mapInArrow(runs, RUN), "runs")
    owners = light.groupBy("minimiser", "run").agg(
        F.min(F.struct("doc", "row")).alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("times")
    )
    owners = stored(owners.select("minimiser", "run", F.col("first.doc").alias("owner"), F.col("first.row").alias("from"), "last", "times"), "owners")

    # Equal super-k-mers in a smaller document.
    copied = owners.where("owner < last").select("minimiser", "run", "owner", "times")
    # Fewer super-k-mers than partitions can be in more rows than an average partition has: these are broadcast.
    average = light.count() / shuffle_partitions(spark)
    frequent = stored(copied.where(F.col("times") > average).drop("times"), "frequent")
    met = light.join(F.broadcast(frequent.withColumnRenamed("owner", "known")), ["minimiser", "run"], "left")
    everywhere = met.where("known is not null").withColumnRenamed("known", "owner")
    elsewhere = met.where("known is null").drop("known").join(copied.drop("times"), ["minimiser", "run"])
    whole = everywhere.unionByName(elsewhere).where("doc > owner").select("row", "start", (F.col("n") + window - 1).alias("n"))

    # Different ones of one minimiser: one string of each is fetched from a row of its smallest document.
    buckets = stored(owners.groupBy("minimiser").agg(F.count(F.lit(1)).alias("strings")).where("strings > 1"), "buckets")
    wanted = (
        owners.join(buckets, "minimiser")
        .groupBy("from")
        .agg(F.collect_list(F.struct("minimiser", "run", (F.col("strings") > bucket).alias("hot"))).alias("wanted"))
    )
    # Equal rows are one before they move.
    each = keyed.groupBy("row").agg(F.first("doc").alias("doc"), F.first("text").alias("text"))
    fetching = each.join(wanted.withColumnRenamed("from", "row"), "row")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            rows, docs = batch.column("row").to_pylist(), batch.column("doc").to_pylist()
            asked = [{(w["minimiser"], w["run"]): w["hot"] for w in want} for want in batch.column("wanted").to_pylist()]
            text, start, n, smallest, run = super_kmers(texts, window, minimiser)
            keys = zip(text.tolist(), start.tolist(), n.tolist(), smallest.view(np.int64).tolist(), run.view(np.int64).tolist())
            packed, hot = [], []
            last, words = -1, []
            for t, s, count, small, whole_run in keys:
                found = asked[t].get((small, whole_run))
                if found is None:
                    continue
                if t != last:
                    last, words = t, texts[t].split()
                if found:
                    for k in range(s, s + count):
                        digest = hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest()
                        halves = np.frombuffer(digest, dtype=np.int64)
                        hot.append((rows[t], docs[t], k, 1, small, whole_run, k - s, None, int(halves[0]), int(halves[1])))
                else:
                    packed.append((rows[t], docs[t], s, count, small, whole_run, 0, b" ".join(words[s : s + count + window - 1]), None, None))
            found_rows = packed + hot
            if found_rows:
                yield _batch(PIECE, list(zip(*found_rows)))

    pieces = stored(fetching.mapInArrow(fetch, PIECE), "pieces")

    def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covers: list[tuple] = []
        for _, table in sorted_groups(batches, ["minimiser"]):
            listed = []
            for row in table.to_pylist():
                words = row["packed"].split()
                listed += [
                    (b" ".join(words[k : k + window]), row["doc"], row["row"], row["start"] + k, row["minimiser"], row["run"], k)
                    for k in range(row["n"])
                ]
            listed.sort()
            current, smallest = None, 0
            for words, doc, row, start, small, run, k in listed:
                if words != current:
                    current, smallest = words, doc
                elif doc > smallest:
                    covers.append((row, doc, start, window, small, run, k))
            if len(covers) > 10_000:
                yield _batch(COVER, list(zip(*covers)))
                covers = []
        if covers:
            yield _batch(COVER, list(zip(*covers)))

    strings = pieces.where("packed is not null").select("row", "doc", "start", "n", "minimiser", "run", "packed")
    sorted_strings = strings.repartition("minimiser").sortWithinPartitions("minimiser")
    in_buckets = sorted_strings.mapInArrow(sort_bucket, COVER)

    hot = pieces.where("packed is null").select("row", "doc", "start", "minimiser", "run", "at", "w1", "w2")
    first = stored(
        hot.groupBy("w1", "w2").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner < last").drop("last"),
        "windows",
    )
    in_hot = hot.join(first, ["w1", "w2"]).where("doc > owner").withColumn("n", F.lit(window).cast("long")).drop("w1", "w2", "owner")
    fetched = stored(in_buckets.unionByName(in_hot), "fetched")

    # A string is fetched from one row; other rows of the same document may have the same one.
    several = light.groupBy("doc").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("doc")
    same = fetched.select("doc", "minimiser", "run", "at", "n", F.col("row").alias("from"))
    others = light.select("row", "doc", "start", "minimiser", "run").join(stored(several, "several"), "doc")
    others = others.join(same, ["doc", "minimiser", "run"]).where(F.col("row") != F.col("from"))

    covers = whole.unionByName(fetched.select("row", "start", "n")).unionByName(
        others.select("row", (F.col("start") + F.col("at")).alias("start"), "n")
    )
    covered = stored(
        covers.groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias("covers")), "covers"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, covers in zip(byte_column(batch, "text"), batch.column("covers").to_pylist()):
                words = text.split()
                removed = 0
                if covers:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, [c["start"] for c in covers], 1)
                    np.add.at(change, [c["start"] + c["n"] for c in covers], -1)
                    keep = np.cumsum(change)[:-1] == 0
                    removed = int(len(words) - keep.sum())
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    kept = words
                out.append((len(words), removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
            n_words, n_removed, digests = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    joined = keyed.select("doc_id", "row", "text").join(covered, "row", "left").select("doc_id", "text", "covers")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
