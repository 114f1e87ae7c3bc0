"""Near-duplicate embeddings: inverted lists with product-quantised residuals, then exact cosine similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from rankweave.llm.components import connected_components
from rankweave.llm.groups import local_roots
from rankweave.runtime import forget, shuffle_partitions, shuffles_removed, stored

THRESHOLD = 0.9
SAMPLE = 20_000  # vectors that the quantiser is fitted on, at most
LIST_SIZE = 200  # vectors per inverted list aimed at
MAX_LISTS = 8192
PROBES = 12  # lists that a vector in a sparse part asks, of up to PROBED_LISTS; in dense parts a bound decides
PROBED_LISTS = 500
ROWS = 100  # vectors that are measured against all centroids at a time
SUBSPACES = 8
CODES = 64  # centroids per subspace
ROUNDS = 4
BLOCK = 4096  # vectors of a list that one task compares with all that ask it
CELLS = 1 << 17  # pairs that are looked up at a time
CLOSE = 1e-9  # cosines that are this near to the threshold are computed once more
PASS_BYTES = 128_000_000  # what a pass over the lists may move if all vectors have less
ROW_BYTES = 40  # what a row that is moved has besides its vector or sketch


def probes_of(lists: int, probes: int = PROBES) -> int:
    """Lists to ask out of so many: their number grows with the square root, as nearby vectors are spread over more."""
    return int(np.ceil(probes * max(1.0, (lists / PROBED_LISTS) ** 0.5)))


def link_distance(threshold: float) -> float:
    """The largest distance of two unit vectors with a cosine of at least ``threshold``."""
    return float(np.sqrt(2 - 2 * threshold))


@dataclass
class Quantiser:
    """Coarse centroids (centroids x dimensions) and residual centroids (subspaces x codes x dimensions of a subspace).

    ``merged`` has the list of each coarse centroid: the centroid that leads it, itself unless merged. ``blocks`` has the
    number of parts that each list is dealt into, one unless it is long.
    """

    coarse: np.ndarray
    fine: np.ndarray
    cuts: np.ndarray
    merged: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def probed_lists(self, unit: np.ndarray, probes: int, threshold: float) -> list[np.ndarray]:
        """The lists that each row asks, its own first.

        These are the ``probes`` nearest and, for a row within the link distance r of its centroid, all with a centroid
        within r more than that. Of two linked rows, let y be no nearer to its centroid than x to its own, c. Then
        |y - c| <= |y - x| + |x - c| is at most r more than y's distance to its own centroid, so y asks the list of x.
        """
        found, counts = self.probed(unit, probes, threshold)
        return np.split(found, np.cumsum(counts)[:-1])

    def probed(self, unit: np.ndarray, probes: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """``probed_lists`` of all rows one after the other, and the number of lists of each."""
        parts = [self._probed(unit[begin : begin + ROWS], probes, threshold) for begin in range(0, len(unit), ROWS)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _probed(self, unit: np.ndarray, probes: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        merged = np.arange(len(self.coarse)) if self.merged is None else self.merged
        far = self._distances(unit, self.coarse)
        for centroid in np.flatnonzero(merged != np.arange(len(merged))):
            leader = far[:, merged[centroid]]
            np.minimum(leader, far[:, centroid], out=leader)
        leaders = np.unique(merged)
        far = far[:, leaders]
        probes = min(probes_of(len(leaders), probes), len(leaders))
        near = np.sort(np.argpartition(far, probes - 1, axis=1)[:, :probes], axis=1)
        home, link = far.argmin(1), link_distance(threshold)
        closest = far[np.arange(len(unit)), home]
        counts = np.full(len(unit), probes)
        dense = np.flatnonzero((closest <= link**2 + 1e-9) | ~(near == home[:, None]).any(1))
        if len(dense):
            asked = np.zeros((len(dense), len(leaders)), dtype=bool)
            np.put_along_axis(asked, near[dense], True, axis=1)
            first = np.sqrt(np.maximum(closest[dense], 0))[:, None]
            asked |= (first <= link) & (np.sqrt(np.maximum(far[dense], 0)) <= first + link + 1e-6)
            asked[np.arange(len(dense)), home[dense]] = True
            counts[dense] = asked.sum(1)
        own = np.cumsum(counts) - counts
        found = np.empty(counts.sum(), dtype=np.int64)
        wide = np.zeros(len(unit), dtype=bool)
        wide[dense] = True
        wide = np.repeat(wide, counts)
        found[~wide] = np.delete(near, dense, axis=0).ravel()
        if len(dense):
            found[wide] = np.nonzero(asked)[1]
        # The own list goes first: those before it move up by one.
        row = np.repeat(np.arange(len(unit)), counts)
        order = np.lexsort((found, found != home[row], row))
        return leaders[found[order]], counts

    def dealt(self, found: np.ndarray, counts: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``probed`` lists as parts of lists (part << 20 | list) and their number for each row.

        A row has its place in one part of its own list, which ``key`` chooses and which comes first, and asks all parts
        of all its lists.
        """
        blocks = np.ones(len(self.coarse), dtype=np.int64) if self.blocks is None else self.blocks
        times = blocks[found]
        part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start = np.zeros(len(found), dtype=np.int64)
        own = np.cumsum(counts) - counts
        start[own] = key % times[own]
        part = (part + np.repeat(start, times)) % np.repeat(times, times)
        return (part << 20) | np.repeat(found, times), np.add.reduceat(times, own)

    @staticmethod
    def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        return (x**2).sum(1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(1)[None, :]

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A code per subspace, and how far the vector is from what its codes stand for."""
        codes = np.empty((len(residual), len(self.fine)), dtype=np.uint8)
        error = np.zeros(len(residual))
        for s, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            centroids = self.fine[s][:, : b - a]
            codes[:, s] = self._distances(residual[:, a:b], centroids).argmin(1)
            error += ((residual[:, a:b] - centroids[codes[:, s]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def lookup(self, rows: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances to what the codes in the list ``place`` stand for, by table look-up: codes x ``rows``.

        They are in single precision, off by less than ``slack``.
        """
        residual = (rows - self.coarse[place]).astype(np.float32)
        whole = (residual * residual).sum(1)
        near = other = None
        for s, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            centroids = self.fine[s][:, : b - a].astype(np.float32)
            table = centroids @ (-2 * residual[:, a:b].T)
            table += (centroids * centroids).sum(1)[:, None]
            if s == 0:
                table += whole
                near = table.take(codes[:, s], axis=0)
                other = np.empty_like(near)
            else:
                table.take(codes[:, s], axis=0, out=other, mode="clip")
                near += other
        return near


def slack(width: int) -> float:
    """A bound of the rounding of sums of so many products in single precision, for vectors of a length up to 2."""
    return 1e-5 + 1e-6 * width


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row."""
    return np.concatenate([Quantiser._distances(x[begin : begin + ROWS], centroids).argmin(1) for begin in range(0, len(x), ROWS)])


def _kmeans(x: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        home = _nearest(x, centroids)
        count = np.bincount(home, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    return centroids


def merge_lists(unit: np.ndarray, coarse: np.ndarray, home: np.ndarray, link: float) -> np.ndarray:
    """The leader of each centroid: itself, or in a dense part a centroid of more vectors within the distance ``link``.

    A dense group of vectors has centroids in proportion to its size, and each vector has links in the lists of all. A
    list is dense if its vectors are on average (root mean square) within ``link`` of its centroid. Nothing is merged
    in turn with what was merged, so a list does not spread along a chain of centroids.
    """
    count = np.bincount(home, minlength=len(coarse))
    spread = np.bincount(home, weights=((unit - coarse[home]) ** 2).sum(1), minlength=len(coarse))
    dense = (count > 0) & (spread <= link**2 * count)
    merged, free = np.arange(len(coarse)), dense.copy()
    for leader in np.argsort(-count, kind="stable"):
        if free[leader]:
            near = free & (((coarse - coarse[leader]) ** 2).sum(1) <= link**2)
            merged[near], free[near] = leader, False
    return merged


def fit_quantiser(
    unit: np.ndarray, lists: int, threshold: float = THRESHOLD, *, rows: int | None = None, block: int = BLOCK
) -> Quantiser:
    """A quantiser of so many lists; with ``block`` vectors in each part of a list if it is used for ``rows``, not ``unit`` alone."""
    rng = np.random.RandomState(5)
    coarse = _kmeans(unit, max(1, min(lists, len(unit))), rng)
    home = _nearest(unit, coarse)
    merged = merge_lists(unit, coarse, home, link_distance(threshold))
    residual = unit - coarse[merged[home]]
    cuts = np.linspace(0, unit.shape[1], min(SUBSPACES, unit.shape[1]) + 1).astype(int)
    widest = int(np.diff(cuts).max())
    fine = np.full((len(cuts) - 1, CODES, widest), 0.0)
    for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
        found = _kmeans(residual[:, a:b], CODES, rng)
        fine[s, : len(found), : b - a] = found
    share = np.bincount(merged[home], minlength=len(coarse)) / len(unit)
    blocks = np.maximum(np.ceil(share * (len(unit) if rows is None else rows) / block - 1e-9), 1).astype(np.int64)
    return Quantiser(coarse, fine, cuts, merged, blocks)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one length, without nulls, as the rows of a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _units(raw: np.ndarray) -> np.ndarray:
    """The rows divided by their norm, in double precision and with the sum of squares taken in order as Spark takes it."""
    values = raw.astype(np.float64)
    squares = np.zeros(len(values))
    for column in values.T:
        squares += column * column
    return values / np.sqrt(squares)[:, None]


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as strings of bytes."""
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1] * matrix.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _rows(column: pa.Array | pa.ChunkedArray, dtype: type, width: int) -> np.ndarray:
    """What ``_binary`` made, as a matrix again."""
    whole = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    _, ends, data = whole.buffers()
    begin = np.frombuffer(ends, dtype=np.int64)[whole.offset]
    return np.frombuffer(data, dtype=dtype, count=len(whole) * width, offset=begin).reshape(len(whole), width)


def sketch(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as whole numbers up to 127, what these are multiplied by, and a bound of how far the result is from the row."""
    scale = (np.maximum(np.abs(unit).max(1), 1e-30) / 127).astype(np.float32)
    whole = np.rint(unit / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    off = np.sqrt(((unit - whole * scale[:, None].astype(np.float64)) ** 2).sum(1))
    return whole, scale, (off * (1 + 1e-6) + 1e-6).astype(np.float32)


CODED = (
    "hash long, cls long, copies long, smallest long, vector binary, lists array<long>, "
    "codes binary, error double, sketch binary, scale float, off float"
)
NEAR = "cls long, list long"
LINKS = "row long, links long, root long"


def _coder(quantisers, probes: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = {width: (number, Quantiser(*q)) for number, (width, q) in enumerate(quantisers.value)}
        for batch in batches:
            widths = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                some = batch.filter(pa.array(widths == width))
                raw = _matrix(some.column("vector"), width)
                if width in fitted:
                    number, q = fitted[width]
                    unit = _units(raw)
                    found, counts = q.probed(unit, probes, threshold)
                    codes, error = q.encode(unit - q.coarse[found[np.cumsum(counts) - counts]])
                    lists, counts = q.dealt(found, counts, some.column("cls").to_numpy())
                    lists += number << 40
                    small, scale, off = sketch(unit)
                else:
                    # Nothing to compare it with.
                    lists, counts = np.zeros(0, dtype=np.int64), np.zeros(len(raw), dtype=np.int64)
                    codes = small = np.zeros((len(raw), 0), dtype=np.uint8)
                    error, scale, off = np.zeros(len(raw)), *np.zeros((2, len(raw)), dtype=np.float32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(c) for c in ("hash", "cls", "copies", "smallest")),
                        _binary(raw),
                        pa.ListArray.from_arrays(offsets, pa.array(lists)),
                        _binary(codes),
                        pa.array(error),
                        _binary(small),
                        pa.array(scale),
                        pa.array(off),
                    ],
                    names=[c.split()[0] for c in CODED.split(", ")],
                )

    return run


def candidates(
    near: np.ndarray, limit: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs up to ``limit`` in ``near`` whose rows of ``left`` and ``right`` have a product of ``least`` or more, and the product."""
    found = near <= limit
    count = np.count_nonzero(found)
    if count * 32 > found.size:
        dot = left @ right.T
        found &= dot >= least[:, None]
        i, j = np.nonzero(found)
        return i, j, dot[i, j]
    i, j = np.nonzero(found)
    dot = np.einsum("ij,ij->i", left[i], right[j])
    found = dot >= least[i]
    return i[found], j[found], dot[found]


def linked_in_list(q: Quantiser, place: int, queries: np.ndarray, entries: np.ndarray, codes: np.ndarray, error: np.ndarray, threshold: float):
    """Positions of query and entry with a cosine of at least ``threshold``.

    The table look-up gives the distance to what an entry's codes stand for, which is off by at most its coding error;
    whatever can still be near enough is compared exactly.
    """
    parts = [(np.zeros(0, dtype=np.int64),) * 2]
    limit = ((link_distance(threshold) + error) ** 2 + slack(queries.shape[1])).astype(np.float32)[:, None]
    least = np.full(len(entries), threshold - CLOSE)
    for begin, end in _steps(len(queries), len(entries)):
        some = queries[begin:end]
        y, x, dot = candidates(q.lookup(some, place, codes), limit, entries, some, least)
        # Products of matrices are summed in another order, which can matter next to the threshold alone.
        linked = dot >= threshold + CLOSE
        for at in np.array_split(np.flatnonzero(~linked), 1 + len(x) // CELLS):
            linked[at] = np.einsum("ij,ij->i", some[x[at]], entries[y[at]]) >= threshold
        parts.append((x[linked] + begin, y[linked]))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _steps(queries: int, entries: int) -> list[tuple[int, int]]:
    """Ranges of queries that have about ``CELLS`` pairs with so many entries."""
    step = max(64, CELLS // max(1, entries))
    return [(begin, min(begin + step, queries)) for begin in range(0, queries, step)]


def in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table | None, pa.RecordBatch | None]]:
    """Rows sorted by ``list``, those with ``entry`` first: the entries of each list once, together, then its queries.

    Lists without entries are left out. Queries come as they were read, so a task holds only the entries of one list.
    """
    place, parts, given = None, [], True
    for batch in batches:
        lists, entry = batch.column("list").to_numpy(), batch.column("entry").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((lists[1:] != lists[:-1]) | (entry[1:] != entry[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lists)]):
            if begin == end:
                continue
            if lists[begin] != place:
                if not given:
                    yield place, pa.Table.from_batches(parts), None
                place, parts, given = int(lists[begin]), [], True
            if entry[begin]:
                parts.append(batch.slice(begin, end - begin))
                given = False
            elif parts:
                yield place, None if given else pa.Table.from_batches(parts), batch.slice(begin, end - begin)
                given = True
    if not given:
        yield place, pa.Table.from_batches(parts), None


def _sieve(quantisers, threshold: float):
    """Rows and lists in which they may have a link, by the sketches of the rows that ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = [(width, Quantiser(*q)) for width, q in quantisers.value]
        held = None

        def read(table):
            cls, scale, off = (table.column(c).to_numpy() for c in ("cls", "scale", "off"))
            return cls, _rows(table.column("sketch"), np.int8, width) * scale[:, None], off

        def meet(x, x_off):
            """Which rows of x may be linked to an entry; marks the entries."""
            met = np.zeros(len(x), dtype=bool)
            for begin, end in _steps(len(x), len(y)):
                some, furthest = x[begin:end], float(x_off[begin:end].max())
                limit = ((link_distance(threshold) + error + furthest) ** 2 + slack(width)).astype(np.float32)[:, None]
                least = (threshold - furthest - y_off * (1 + furthest) - slack(width)).astype(np.float32)
                j, i, _ = candidates(q.lookup(some, place & 0xFFFFF, codes), limit, y, some, least)
                if x is y:
                    i, j = i[i + begin != j], j[i + begin != j]
                met[i + begin] = held[j] = True
            return met

        def chosen(rows, marks):
            found = rows[marks]
            lists = np.full(len(found), last)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (found, lists)], names=["cls", "list"])

        for place, entries, queries in in_lists(batches):
            if entries is not None:
                if held is not None and held.any():
                    yield chosen(rows, held)
                last = place
                width, q = fitted[place >> 40]
                rows, y, y_off = read(entries)
                codes = _rows(entries.column("codes"), np.uint8, len(q.fine))
                error = entries.column("error").to_numpy()
                held = np.zeros(len(rows), dtype=bool)
                held |= meet(y, y_off)
            if queries is not None:
                asking, x, x_off = read(queries)
                met = meet(x, x_off)
                if met.any():
                    yield chosen(asking, met)
        if held is not None and held.any():
            yield chosen(rows, held)

    return run


def _comparer(quantisers, threshold: float, dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = [(width, Quantiser(*q)) for width, q in quantisers.value]

        def read(table):
            lists = table.column("lists")
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            unit = _units(_rows(table.column("vector"), dtype, width))
            cls, copies, home = (table.column(c).to_numpy() for c in ("cls", "copies", "home"))
            return cls, copies, unit, home, lists.flatten().to_numpy(), owner

        def links_of(rows, links, root, met):
            return pa.RecordBatch.from_arrays([pa.array(c[met], pa.int64()) for c in (rows, links, root)], names=["row", "links", "root"])

        def meet(asking, x_copies, x, x_home):
            """Links and roots of the rows that ask, after they have met the entries; both of the entries are kept."""
            links, root = np.zeros(len(asking), dtype=np.int64), asking.copy()
            if x is not y:
                homes, home = np.unique(x_home, return_inverse=True)
                asks = np.zeros((len(y), len(homes)), dtype=bool)
                at = np.searchsorted(homes, lists).clip(max=len(homes) - 1)
                asks[owner[homes[at] == lists], at[homes[at] == lists]] = True
            for begin, end in _steps(len(asking), len(y)):
                i, j = linked_in_list(q, place & 0xFFFFF, x[begin:end], y, codes, error, threshold)
                i += begin
                # Both are at home here: count once. Else the pair may also meet in the list of the other, if that is among
                # the lists of the entry, which are those that the sieve left: count in the first.
                once = rows[j] > asking[i] if x is y else ~asks[j, home[i]] | (place < x_home[i])
                i, j = i[once], j[once]
                if not len(i):
                    continue
                here = links if x is not y else held
                here += np.bincount(i, weights=copies[j], minlength=len(links)).astype(np.int64)
                held[:] += np.bincount(j, weights=x_copies[i], minlength=len(held)).astype(np.int64)
                if x is y:
                    yield from joined(local_roots(roots, i, j))
                else:
                    both = local_roots(np.concatenate([roots, root]), i + len(roots), j)
                    root = both[len(roots) :]
                    yield from joined(both[: len(roots)])
            if x is not y and (links > 0).any():
                yield links_of(asking, links, root, links > 0)

        def joined(new):
            """Keep the new roots of the entries, and say which roots are joined."""
            old = roots.copy()
            roots[:] = new
            moved = np.unique(np.stack([old, new])[:, (old != new) & (old != rows)], axis=1)
            if moved.shape[1]:
                yield links_of(moved[0], np.zeros(moved.shape[1], dtype=np.int64), moved[1], slice(None))

        held = None
        for place, entries, queries in in_lists(batches):
            if entries is not None:
                if held is not None and (held > 0).any():
                    yield links_of(rows, held, roots, held > 0)
                width, q = fitted[place >> 40]
                rows, copies, y, _, lists, owner = read(entries)
                codes = _rows(entries.column("codes"), np.uint8, len(q.fine))
                error = entries.column("error").to_numpy()
                held, roots = np.zeros(len(rows), dtype=np.int64), rows.copy()
                yield from meet(rows, copies, y, None)
            if queries is not None:
                asking, x_copies, x, x_home, *_ = read(queries)
                yield from meet(asking, x_copies, x, x_home)
        if held is not None and (held > 0).any():
            yield links_of(rows, held, roots, held > 0)

    return run


def _in_passes(
    bytes_moved: float, most: float, step: Callable[[Callable[[Column], Column]], DataFrame], name: str
) -> list[DataFrame]:
    """What ``step`` gives for each share of the lists, stored; it gets the condition of a list's being in the share.

    Shares are so many that none moves more than ``most`` bytes, about: shuffled rows are on disk only while their pass
    lasts.
    """
    passes = max(1, int(np.ceil(bytes_moved / most)))

    def in_share(share: int) -> Callable[[Column], Column]:
        return lambda place: F.pmod(place + F.shiftright(place, 20), F.lit(passes)) == share

    return [stored(step(in_share(share)), name) for share in range(passes)]


def link_embeddings(
    embeddings: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    probes: int = PROBES,
    list_size: int = LIST_SIZE,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``embeddings``.

    Vectors are linked if their cosine in double precision is at least ``threshold``. Null and zero vectors and those
    with null, infinite or NaN components are linked with nothing. Vectors of different lengths are not compared; each
    length has a quantiser and lists of its own. ``n_links`` counts other rows. Repeated
    vectors, also under one id, are linked with each other. ``component_id`` is the smallest id that links lead to. A
    row with a null id counts in the others' links and is the smallest of nothing. No rows give no rows.

    Equal vectors are one class. A quantiser is fitted on at most ``SAMPLE`` classes, chosen by a hash; it has a list
    for every ``list_size`` vectors, up to ``MAX_LISTS``, so its size is bounded and it is broadcast. Every class is
    coded in its nearest list and asks the ``probes`` nearest ones, more of many lists (``probes_of``); in dense parts near lists are merged and a class asks
    all that its links can be in (``Quantiser.probed_lists``). A list of more than ``block`` classes is dealt into parts,
    each with lists of its own from here on.

    Lists are compared twice. At first the classes that ask a list come as a sketch of a byte a component: table look-up,
    then the product of the sketches, both with bounds that leave out no link, tell which classes may have one in which
    lists. Only there do whole vectors meet, by table look-up and exactly. Either is done in as many passes over the
    lists as keep the rows that are moved at a time below 1.5 times the size of all vectors. Lists return the number of links
    of each class and the smallest class that it is joined to, never pairs.

    A link is found for certain if both vectors are within the link distance of their centroids. Where one is not, it
    is in a sparse part, and its links are found in the lists that the two ask: nearly all, but without a guarantee.
    """
    spark = embeddings.sparkSession
    with shuffles_removed(spark):
        return _linked(embeddings, vec_id, vector, threshold, probes, list_size, block)


def _linked(embeddings: DataFrame, vec_id: str, vector: str, threshold: float, probes: int, list_size: int, block: int) -> DataFrame:
    spark = embeddings.sparkSession
    values = F.transform(F.col(vector), lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v))
    fine = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kind = embeddings.select(vector).schema[0].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    raw = F.col(vector) if single else values
    chosen = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), raw.alias("raw"), values.alias("v"))
    chosen = chosen.select("vec_id", "raw", "v", norm.alias("norm"), fine.alias("fine"))
    usable = F.coalesce(F.col("fine") & (F.col("norm") > 0) & (F.col("norm") < float("inf")), F.lit(False))
    last_id = F.coalesce("vec_id", F.lit(2**63 - 1))
    # Vectors are kept as they were given, which is half of their size as doubles; equal ones are told by the unit vector.
    unit = F.when(usable, F.transform("v", lambda x: x / F.col("norm")))
    given = stored(
        chosen.select("vec_id", last_id.alias("id"), F.when(usable, F.col("raw")).alias("vector"), unit.alias("unit")).select(
            "vec_id",
            "id",
            "vector",
            F.when(F.col("unit").isNotNull(), F.xxhash64("unit")).alias("hash"),
            F.when(F.col("unit").isNotNull(), F.xxhash64("unit", F.lit(1))).alias("cls"),
        ),
        "vectors",
    )
    classes = given.where("vector is not null").groupBy("hash", "cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("smallest"), F.first("vector").alias("vector")
    )
    classes = stored(classes.withColumn("width", F.size("vector")), "classes")
    rows = stored(given.select("vec_id", "id", "hash"), "rows")
    forget(given)
    # One row for each length of vectors; a length of one class has no links but those of its copies.
    widths = classes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("width").collect()
    fitted = []
    for width, n in widths:
        same = classes.where(F.col("width") == width)
        share = min(1.0, SAMPLE / n)
        drawn = same.where(F.pmod(F.xxhash64("cls"), F.lit(1_000_000)) < int(1_000_000 * share) + (share == 1.0))
        sample = drawn.orderBy("cls").limit(SAMPLE).select("vector").toArrow()
        lists = min(MAX_LISTS, -(-n // list_size))
        q = fit_quantiser(_units(_matrix(sample.column("vector"), width)), lists, threshold, rows=n, block=block)
        fitted.append((width, (q.coarse, q.fine, q.cuts, q.merged, q.blocks)))
    quantiser = spark.sparkContext.broadcast(fitted)
    coded = stored(classes.mapInArrow(_coder(quantiser, probes, threshold), CODED), "coded")
    forget(classes)

    size, asks = F.octet_length("vector"), F.size("lists")
    total, moved = coded.agg(F.sum(size), F.sum((F.octet_length("sketch") + ROW_BYTES) * asks)).first()
    most = max(PASS_BYTES, 1.5 * (total or 0))

    def by_list(dealt):
        # The number is given as tasks are not to be merged by their bytes: a few long lists are little to read and much to compare.
        return dealt.repartition(shuffle_partitions(spark), "list").sortWithinPartitions("list", F.desc("entry"))

    def sieved(in_share):
        asked = F.explode(F.filter("lists", in_share)).alias("list")
        asking = coded.select("cls", "lists", "codes", "error", "sketch", "scale", "off", asked)
        asking = asking.withColumn("entry", F.col("list") == F.col("lists")[0])
        at_home = [F.when(F.col("entry"), F.col(c)).alias(c) for c in ("codes", "error")]
        dealt = asking.select("list", "entry", "cls", "sketch", "scale", "off", *at_home)
        return by_list(dealt).mapInArrow(_sieve(quantiser, threshold), NEAR)

    parts = _in_passes(moved or 0, most, sieved, "near")
    needed = reduce(DataFrame.unionByName, parts).groupBy("cls").agg(F.collect_list("list").alias("lists"))
    needed = stored(needed, "needed")
    for part in parts:
        forget(part)
    moved = needed.agg(F.sum(asks * ((total or 0) / max(1, coded.count()) + 8 * asks + 2 * ROW_BYTES))).first()[0]

    def compared(in_share):
        here = needed.withColumn("here", F.filter("lists", in_share)).where(F.size("here") > 0)
        own = coded.select("cls", "copies", "vector", "codes", "error", F.col("lists")[0].alias("home"))
        asking = here.join(own, "cls").withColumn("list", F.explode("here")).withColumn("entry", F.col("list") == F.col("home"))
        return by_list(asking.drop("here")).mapInArrow(_comparer(quantiser, threshold, np.float32 if single else np.float64), LINKS)

    links = reduce(DataFrame.unionByName, _in_passes(moved or 0, most, compared, "links"))
    classes = stored(coded.select("hash", "cls", "copies", "smallest"), "classes")
    forget(coded)
    forget(needed)

    roots = connected_components(links.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")))
    counts = stored(links.groupBy("row").agg(F.sum("links").alias("links")), "counts")
    placed = (
        classes.join(counts.withColumnRenamed("row", "cls"), "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    placed = stored(placed, "placed")
    heads = stored(placed.groupBy("root").agg(F.min("smallest").alias("head")), "heads")
    result = stored(
        placed.join(heads, "root").select(
            F.col("hash").alias("h"), "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")
        ),
        "result",
    )
    component = F.coalesce("head", "id")
    return rows.select("vec_id", "id", "hash").join(result, rows["hash"] == result["h"], "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(2**63 - 1)).alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )
