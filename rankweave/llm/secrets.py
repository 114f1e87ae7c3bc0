"""Secret scans with the ownership frequency of every candidate over the whole corpus."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import stored

# Patterns and lengths of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
# What the method adds: long tokens that look random. They count only if few owners and few repositories have them.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
OWNED = "owned"
KINDS = (*BASE_KINDS, OWNED)
MIN_ENTROPY = 3.0
MAX_OWNERS = 2
MAX_REPOSITORIES = 10


def looks_random(token: str) -> bool:
    """Letters and at least three digits, mixed, with ``MIN_ENTROPY`` bits a character."""
    if sum(c.isdigit() for c in token) < 3 or not any(c.isalpha() for c in token):
        return False
    counts = Counter(token).values()
    return -sum(n / len(token) * math.log2(n / len(token)) for n in counts) >= MIN_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """Start, place in ``KINDS``, end and secret value; base kinds leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    starts, ends = [], []
    for start, _, end, _ in sorted(found):
        if ends and start <= ends[-1]:
            ends[-1] = max(end, ends[-1])
        else:
            starts.append(start)
            ends.append(end)
    for m in TOKEN.finditer(text):
        # The first of the joined spans that ends behind the token's start.
        i = bisect_right(ends, m.start())
        inside = i < len(starts) and starts[i] < m.end()
        if not inside and looks_random(m[0]):
            found.append((m.start(), 3, m.end(), m[0]))
    return sorted(found)


CANDIDATE = "struct<start:int,kind:int,end:int,hash:string>"
COUNTED = "struct<start:int,kind:int,end:int,live:boolean,n_owners:bigint,n_repositories:bigint>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))
    for batch in batches:
        rows = []
        for text in batch.column("_text").to_pylist():
            rows.append(
                [
                    {"start": start, "kind": k, "end": end, "hash": hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()}
                    for start, k, end, value in candidates(text or "")
                ]
            )
        kept = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
        names = [batch.schema.names[i] for i in kept]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in kept), pa.array(rows, kind)], names=[*names, "_candidates"]
        )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each ``hash``; ``found`` has hash, repository and owner. Nulls count as one each."""

    def distinct(column: str, name: str) -> DataFrame:
        return found.select("hash", column).distinct().groupBy("hash").agg(F.count(F.lit(1)).alias(name))

    return distinct("repository", "n_repositories").join(distinct("owner", "n_owners"), "hash")


def _spans(found: Column, *more: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.sort_array(found), lambda s: F.concat_ws(":", names[s["kind"]], *[s[c].cast("string") for c in ("start", "end", *more)])
    )
    return F.array_join(parts, ",")


def scan_secrets(
    documents: DataFrame,
    *,
    keep: list[str] | None = None,
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """The columns ``keep`` (``doc_id`` unless given) with the secrets of each row's whole text.

    ``n_assign``, ``n_access``, ``n_hex`` and ``base_sha256`` are about the base kinds, which always stay. ``spans``
    also has the kind ``owned``: random-looking tokens outside base spans with at most ``max_owners`` owners and at most
    ``max_repositories`` repositories in all of ``documents``. A token of more is an example that was copied, also if one
    owner copied it. ``n_live`` and ``n_copied`` divide all candidates in the same way. Spans are in code points, by
    start, then kind, and end before ``end``. ``frequencies`` has all candidates, those copied too, in the same order
    and form, each followed by its numbers of owners and repositories.

    A null text counts as empty and has no spans. Repeated rows are scanned alike and stay; repositories and owners are
    counted once however often they repeat, null among them. An empty table gives an empty result.

    The texts are scanned once and never shuffled: what is found is stored, counted by hash and joined back to it.
    """
    keep = keep or ["doc_id"]
    chosen = documents.select(
        *[F.col(c) for c in keep], F.col(repository).alias("_repository"), F.col(owner).alias("_owner"), F.col(text).alias("_text")
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text"]
        + [f"_candidates array<{CANDIDATE}>"]
    )
    scanned = stored(chosen.mapInArrow(_scan, schema).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    found = scanned.select("_row", F.col("_repository").alias("repository"), F.col("_owner").alias("owner"), F.explode("_candidates").alias("c"))
    counts = stored(ownership(found.select(F.col("c.hash").alias("hash"), "repository", "owner")), "ownership")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    owned = (
        found.select("_row", "c", F.col("c.hash").alias("hash"))
        .join(counts, "hash")
        .select("_row", F.struct("c.start", "c.kind", "c.end", live.alias("live"), "n_owners", "n_repositories").alias("c"))
        .groupBy("_row")
        .agg(F.collect_list("c").alias("_found"))
    )
    found_all = F.coalesce("_found", F.array().cast(f"array<{COUNTED}>"))
    # Rows without a candidate need no join.
    matched = scanned.where(F.size("_candidates") > 0).join(owned, "_row")
    unmatched = scanned.where(F.size("_candidates") == 0)
    joined = matched.unionByName(unmatched, allowMissingColumns=True).withColumn("_all", found_all)
    base = F.filter("_all", lambda c: c["kind"] < len(BASE_KINDS))
    spans = F.filter("_all", lambda c: (c["kind"] < len(BASE_KINDS)) | c["live"])

    def count(condition) -> Column:
        return F.size(F.filter("_all", condition)).cast("long")

    return joined.select(
        *keep,
        count(lambda c: c["kind"] == 0).alias("n_assign"),
        count(lambda c: c["kind"] == 1).alias("n_access"),
        count(lambda c: c["kind"] == 2).alias("n_hex"),
        F.sha2(_spans(base).cast("binary"), 256).alias("base_sha256"),
        _spans(spans).alias("spans"),
        count(lambda c: c["live"]).alias("n_live"),
        count(lambda c: ~c["live"]).alias("n_copied"),
        _spans(F.col("_all"), "n_owners", "n_repositories").alias("frequencies"),
    )


PLACEHOLDER = "[secret]"


def redact(text: str, spans: str, placeholder: str = PLACEHOLDER) -> str:
    """Replace each span, and overlapping ones together."""
    parts, end = [], 0
    for begin, stop in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s):
        if begin >= end:
            parts += [text[end:begin], placeholder]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def redacted(text: Column, spans: Column) -> Column:
    """``redact`` as a column; texts without spans are passed by."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([redact(t, s) if s else t for t, s in zip(texts, found)], dtype=object)

    return F.when(spans == "", text).otherwise(replace(text, spans))
