"""Exact similarity join of documents on word shingles, by count-vector R-trees.

A document is the set of its shingles of some words, three unless asked otherwise, as 64-bit
hashes. Two documents with sets A and B link when ``100 |A n B| >= p |A u B|``, p being 90 unless
asked otherwise.

* Equal sets are collapsed first: one representative, the least id, per class.
* **Cells.** Shingles are hashed into groups. Sets that link differ in at most
  ``|A| (100 - p) / p`` elements (A the smaller), so with more groups than that at least one
  group holds the same shingles in both: documents that share such a group, within
  neighbouring size bands, meet in a cell, and no link can be missed. A group holds
  about eight shingles at 90 and three at 80, so that passages or lines that many documents share
  seldom make a cell.
* **Below 90** such groups would hold too few shingles to tell documents apart. Cells are then single
  shingles: each document's rarest, so many that two linked sets must share one of them. How rare a shingle is
  is counted over all rows in hash buckets. Any order that is the same for all loses no link; the counts keep
  what many documents share out of the cells.
* **Hubs.** In every cell each document is first paired with the cell's least one;
  each document's pair with its least hub is verified. Verified links make components.
  A cell that lies within one component has nothing more to say.
* **Trees.** The other cells' documents become points, the counts of their shingles in
  64 hash groups, in a packed R-tree per cell. The overlap of two
  sets is at most the sum of their counts' minima, and of a point and a box at most the
  sum of the minima with the box's upper corner; pairs of different components that this bound
  lets pass are verified. A cell with many documents is split into blocks, and each pair
  of blocks is a task's work of its own.
* Count vectors of a few groups let most pairs of long documents pass. All pairs are therefore bounded a second
  time, by vectors with a group for every four shingles; what is left is verified by intersecting the
  sorted hash arrays.

Set hashes are 128 bits and shingle hashes 64, so equality holds but for odds of 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import NOT_SPACE, U64, Words, give_back, mix, sort_rows, word_chunks
from tidemark.llm.common import stored
from tidemark.llm.links import components

GROUPS = 64
COARSE = 16  # groups merged for a first, cheaper look at a pair
NODE = 16  # points of a tree node
BUCKETS = 1 << 20  # in which shingles are counted
BUCKET_PARTS = 16
BLOCK = 4096  # documents of a cell that one task compares with as many others
QUERIES = 64  # points searched for at a time
SLICE = 50_000  # pairs looked at together
PER_GROUP = 4  # shingles to a group of a fine vector, about
PAIRS = 10_000  # that one task looks at by fine vectors, about


@dataclass(frozen=True)
class Likeness:
    """What links two documents: ``percent`` of the shingles of ``shingle`` words that either has."""

    shingle: int = 3
    percent: int = 90

    def __post_init__(self):
        if self.shingle < 1 or not 50 <= self.percent < 100:
            raise ValueError(f"no such likeness: {self}")

    @property
    def least_size(self) -> int:
        """Smaller sets link with equal ones only."""
        return -(-self.percent // (100 - self.percent))

    def largest(self, n):
        """Size of the largest set that can link with one of n."""
        return 100 * n // self.percent

    def differing(self, n):
        """How many elements a set of at most n and a linked one that is not smaller differ in at most."""
        return (100 - self.percent) * n // self.percent

    def spare(self, differ: np.ndarray) -> np.ndarray:
        """Groups beyond ``differ`` + 1, so many that a set seldom leaves more than these empty."""
        empty = differ * np.exp(-self.percent**2 / (100 - self.percent) / 100)
        return np.maximum(1, np.ceil(2 * empty + 4 * np.sqrt(empty))).astype(np.int64)

    def needed(self, n, m):
        """Least overlap at which sets of these sizes link: 100 i >= p (n + m - i)."""
        return -(-(self.percent * (n + m)) // (100 + self.percent))

    def least_overlap(self, n, m=None):
        """Overlap needed with a set of size m, or, if unknown, with any set that can link."""
        return self.needed(n, m) if m is not None else -(-(self.percent * n) // 100)


OWN = Likeness()


def shingle_sets(words: Words, shingle: int = OWN.shingle) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after another, and the edges."""
    h = words.hashes()
    edges = words.edges
    n = words.count
    per = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(n.dtype))
    to = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
    at = np.arange(to[-1]) - np.repeat(to[:-1] - edges[:-1], per)  # first word of each
    length = np.minimum(np.repeat(n, per), shingle)
    value = np.zeros(to[-1], U64)
    for k in range(shingle):
        own = k < length
        value[own] = mix(value[own] * U64(0x9E3779B97F4A7C15) + h[at[own] + k] + U64(k + 1))
    sort_rows(value, to)
    keep = np.ones(len(value), bool)
    keep[1:] = value[1:] != value[:-1]
    keep[to[:-1][to[:-1] < len(value)]] = True
    row = np.repeat(np.arange(len(n)), per)[keep]
    sizes = np.bincount(row, minlength=len(n))
    return value[keep], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def set_keys(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each row's set."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate([[U64(0)], np.cumsum(mix(values ^ U64(salt * 0x632BE59BD9B4E019)))])
        out.append(mix(sums[edges[1:]] - sums[edges[:-1]]).view(np.int64))
    return out[0], out[1]


def size_bands(largest: int, like: Likeness = OWN) -> np.ndarray:
    """Least set size of each band: a set links only within its own or a neighbouring band."""
    bands = [like.least_size]
    while bands[-1] <= largest:
        bands.append(like.largest(bands[-1]) + 1)
    bands.append(like.largest(bands[-1]) + 1)
    return np.array(bands)


def differing(band: np.ndarray, bands: np.ndarray, like: Likeness = OWN) -> np.ndarray:
    """How many elements two linked sets differ in at most, the smaller being in ``band``."""
    return like.differing(bands[band + 1] - 1)


def cell_keys(values: np.ndarray, edges: np.ndarray, like: Likeness = OWN) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit key of every cell that a row's set lies in.

    Sets under ``like.least_size`` shingles link with equal ones only and get none. A set meets those of its own
    band and the next as the smaller, and those of the band below as the larger one. Where a
    set leaves so many groups empty that the shared ones may all be, its empty groups
    make cells too.
    """
    size = np.diff(edges)
    bands = size_bands(int(size.max(initial=0)), like)
    band = np.searchsorted(bands, size, "right") - 1
    rows, keys = [], []
    high = (values >> U64(32)).astype(np.int64)
    mixed = mix(values + U64(0x9E3779B97F4A7C15))
    for lower in (0, 1):
        use = band - lower
        valid = use >= 0
        differ = differing(np.maximum(use, 0), bands, like)
        spare = like.spare(differ)
        groups = np.where(valid, differ + 1 + spare, 0)
        per = size * valid
        if not per.sum():
            continue
        index = np.flatnonzero(np.repeat(valid, size))
        row = np.repeat(np.arange(len(size)), per)
        # Values are sorted, so the groups, equal ranges of the hash, are runs.
        group = (high[index] * groups[row]) >> 32
        first = np.ones(len(index), bool)
        first[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
        at = np.flatnonzero(first)
        sums = np.add.reduceat(mixed[index], at)
        who, which = row[at], group[at]
        base = mix((use[who].astype(U64) << U64(32)) + which.astype(U64) + U64(1))
        rows.append(who)
        keys.append(mix(sums ^ base))
        filled = np.bincount(who, minlength=len(size))
        for r in np.flatnonzero(valid & (groups - filled > spare)):
            empty = np.setdiff1d(np.arange(groups[r]), which[who == r])
            rows.append(np.full(len(empty), r))
            keys.append(mix((U64(use[r]) << U64(32)) + empty.astype(U64) + U64(0xE000000000000001)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def rare_keys(
    values: np.ndarray, edges: np.ndarray, counts: np.ndarray, like: Likeness
) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every cell that a row's set lies in: its rarest shingles.

    Of n shingles, two linked sets share at least ``least_overlap(n)``. The first one they share, in an order
    common to all, is therefore among the first n - least_overlap(n) + 1 of either.
    """
    size = np.diff(edges)
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((values, counts[values & U64(BUCKETS - 1)], row))
    most = np.where(size >= like.least_size, size - like.least_overlap(size) + 1, 0)
    use = np.arange(len(values)) - edges[row] < most[row]
    return row[use], values[order[use]].view(np.int64)


def _bucket_counts(like: Likeness):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words in word_chunks(batch.column(0), NOT_SPACE):
                values, _ = shingle_sets(words, like.shingle)
                counts += np.bincount((values & U64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        if counts.any():
            parts = [p.tobytes() for p in np.split(np.minimum(counts, 2**32 - 1).astype(np.uint32), BUCKET_PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BUCKET_PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "counts"]
            )

    return counted


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each part's counts; all rows of a part come to one task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
            sums[part] = sums.get(part, 0) + own
    if sums:
        parts = [np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], names=["part", "counts"]
        )


def shingle_counts(texts: DataFrame, like: Likeness) -> np.ndarray:
    """How many rows hold a shingle of each hash bucket: 4 MB a task, and on the driver."""
    schema = "part int, counts binary"
    rows = texts.select("text").mapInArrow(_bucket_counts(like), schema)
    counts = np.zeros((BUCKET_PARTS, BUCKETS // BUCKET_PARTS), np.uint32)
    for part, own in rows.repartition("part").mapInArrow(_added, schema).collect():
        counts[part] = np.frombuffer(bytes(own), np.uint32)
    return counts.ravel()


def count_vectors(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many of each row's shingles fall in each of the hash groups."""
    size = np.diff(edges)
    row = np.repeat(np.arange(len(size)), size)
    group = (mix(values ^ U64(0xA5A5A5A5A5A5A5A5)) & U64(GROUPS - 1)).astype(np.int64)
    return np.bincount(row * GROUPS + group, minlength=len(size) * GROUPS).reshape(-1, GROUPS)


def fine_vectors(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Counts of each row's shingles in so many groups that one holds about four, a byte each.

    The number of groups is a power of two times ``GROUPS``, and the groups of a shorter vector are sums of those of a
    longer one, so rows of all sizes can be compared.
    """
    hashed, out = mix(values ^ U64(0xA5A5A5A5A5A5A5A5)), []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        groups = GROUPS
        while True:
            if groups * PER_GROUP >= b - a:
                counts = np.bincount((hashed[a:b] & U64(groups - 1)).astype(np.int64), minlength=groups)
                if counts.max() < 256:  # else a finer one, so that no count is cut off
                    break
            groups *= 2
        out.append(counts.astype(np.uint8).tobytes())
    return out


def overlap_bounds(fine: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows the sum of their counts' minima, at the shorter vector's groups; and each row's size."""
    length = np.array([len(f) for f in fine])
    place, tables = np.zeros(len(fine), np.int64), {}
    for groups in np.unique(length).tolist():
        own = np.flatnonzero(length == groups)
        place[own] = np.arange(len(own))
        tables[groups] = np.frombuffer(b"".join(fine[k] for k in own.tolist()), np.uint8).reshape(-1, groups)
    sizes = np.zeros(len(fine), np.int64)
    for groups, table in tables.items():
        sizes[length == groups] = table.sum(axis=1, dtype=np.int64)
    bound = np.zeros(len(i), np.int64)
    for left in tables:
        for right in tables:
            pairs = np.flatnonzero((length[i] == left) & (length[j] == right))
            groups = min(left, right)
            step = max(1, 2_000_000 // max(left, right))
            for k in range(0, len(pairs), step):
                at = pairs[k : k + step]
                a = tables[left][place[i[at]]].reshape(len(at), -1, groups).sum(axis=1, dtype=np.int32)
                b = tables[right][place[j[at]]].reshape(len(at), -1, groups).sum(axis=1, dtype=np.int32)
                bound[at] = np.minimum(a, b).sum(axis=1)
    return bound, sizes


CELLS = "doc_id long, n long, key1 long, key2 long, cell array<long>"


def _cell_rows(like: Likeness, counts=None):
    """Cells by groups, or by rare shingles if broadcast ``counts`` are given."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0)
            for words in word_chunks(batch.column(1), NOT_SPACE):
                values, edges = shingle_sets(words, like.shingle)
                one, two = set_keys(values, edges)
                row, key = cell_keys(values, edges, like) if counts is None else rare_keys(values, edges, counts.value, like)
                # Copies within a task lie in the same cells; those of the first one with an id are enough.
                fresh = np.zeros(words.rows, bool)
                known = ids.slice(words.first, words.rows).is_valid().to_numpy(zero_copy_only=False)
                for i, pair in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
                    if known[i] and pair not in seen:
                        fresh[i] = True
                        if len(seen) < 2_000_000:
                            seen.add(pair)
                use = fresh[row]
                row, key = row[use], key[use]
                order = np.argsort(row, kind="stable")
                lists = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=words.rows))])
                cells = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(key[order]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(words.first, words.rows), pa.array(np.diff(edges)), pa.array(one),
                     pa.array(two), cells],
                    names=["doc_id", "n", "key1", "key2", "cell"],
                )
        seen.clear()
        give_back()

    return rows


SETS = "doc_id long, n long, counts binary, fine binary, shingles binary"


def _set_rows(like: Likeness):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for words in word_chunks(batch.column(1), NOT_SPACE):
                values, edges = shingle_sets(words, like.shingle)
                counts = count_vectors(values, edges).astype(np.uint32)
                blobs = [values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(words.first, words.rows), pa.array(np.diff(edges)),
                     pa.array([c.tobytes() for c in counts], pa.binary()), pa.array(fine_vectors(values, edges), pa.binary()),
                     pa.array(blobs, pa.binary())],
                    names=["doc_id", "n", "counts", "fine", "shingles"],
                )
                del words, values, edges, counts, blobs
                give_back()

    return rows


def _verified(like: Likeness):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the pairs given with both sets, those that link."""
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2)]
            sa, sb = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                a = np.frombuffer(sa[i].as_buffer(), U64)
                b = np.frombuffer(sb[i].as_buffer(), U64)
                both = np.concatenate([a, b])
                both.sort()
                if int((both[1:] == both[:-1]).sum()) >= like.needed(len(a), len(b)):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[i] for i in keep], pa.int64()) for c in cols], names=["a", "b"]
            )
            del sa, sb, batch
            give_back()

    return verified


def _likely(like: Likeness):
    def likely(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        """Of the pairs, those whose fine vectors let them link; an id can have several rows, any of which may."""
        a, b = (pairs.column(c).to_numpy() for c in ("a", "b"))
        ids = vectors.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, fine = ids[order], vectors.column("fine").take(pa.array(order)).to_pylist()
        first = {c: np.searchsorted(ids, v, "left") for c, v in (("a", a), ("b", b))}
        times = {c: np.searchsorted(ids, v, "right") - first[c] for c, v in (("a", a), ("b", b))}
        each = times["a"] * times["b"]
        pair = np.repeat(np.arange(len(a)), each)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        i, j = first["a"][pair] + turn // times["b"][pair], first["b"][pair] + turn % times["b"][pair]
        bound, sizes = overlap_bounds(fine, i, j)
        keep = np.unique(pair[bound >= like.needed(sizes[i], sizes[j])])
        del fine, pair, turn, i, j, bound
        give_back()
        return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})

    return likely


class PackedTree:
    """An R-tree over count vectors, packed bottom-up in sort order.

    Only upper corners are kept: they are all that the overlap bound needs. Searching
    takes many points at once, level by level.
    """

    def __init__(self, points: np.ndarray):
        # Neighbours in size and then along the widest coordinates share leaves.
        spread = np.argsort(points.std(axis=0))[-3:]
        self.order = np.lexsort([points[:, k] for k in spread] + [points.sum(axis=1) // 8])
        self.levels = [points[self.order]]
        while len(self.levels[-1]) > NODE:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), NODE), axis=0))

    def search(self, points: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose overlap bound reaches ``least(queries, upper sums)``."""
        top = len(self.levels[-1])
        query = np.repeat(np.arange(len(points)), top)
        node = np.tile(np.arange(top), len(points))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner = self.levels[depth][node]
            bound = np.minimum(points[query], corner).sum(axis=1)
            exact = corner.sum(axis=1) if depth == 0 else None
            passed = bound >= least(points[query].sum(axis=1), exact)
            query, node = query[passed], node[passed]
            if depth:
                size = len(self.levels[depth - 1])
                child = node[:, None] * NODE + np.arange(NODE)
                there = child < size
                query = np.repeat(query, there.sum(axis=1))
                node = child[there]
        return query, self.order[node]


def _pairs_in(ids, comp, points, side, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components whose overlap bound lets them link.

    Both kinds of rows of the most frequent component have nothing to say to each other, so
    the others are searched for among all, from either side.
    """
    names, back, times = np.unique(comp, return_inverse=True, return_counts=True)
    few = back != np.argmax(times)
    coarse = points.reshape(len(points), COARSE, -1).sum(axis=2, dtype=np.int32)
    sizes = points.sum(axis=1)
    found = [np.zeros((2, 0), np.int64)]
    for left, right in (((side != 2) & few, side != 1), ((side != 2) & ~few, (side != 1) & few)):
        left, right = np.flatnonzero(left), np.flatnonzero(right)
        if not len(left) or not len(right):
            continue
        tree = PackedTree(coarse[right])
        for k in range(0, len(left), QUERIES):
            q = left[k : k + QUERIES]
            at, hit = tree.search(coarse[q], like.least_overlap)
            i, j = q[at], right[hit]
            ok = (comp[i] != comp[j]) & (ids[i] != ids[j])
            i, j = i[ok], j[ok]
            for n in range(0, len(i), SLICE):
                a, b = i[n : n + SLICE], j[n : n + SLICE]
                ok = np.minimum(points[a], points[b]).sum(axis=1) >= like.needed(sizes[a], sizes[b])
                found.append(np.stack([np.minimum(ids[a], ids[b])[ok], np.maximum(ids[a], ids[b])[ok]]))
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def _cell_pairs(like: Likeness):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs within each block pair of each cell; rows come sorted by cell and blocks.

        side: 0 in both blocks of a pair (one block with itself), 1 in the first, 2 in the second.
        """
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            col = lambda c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            points = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint32)
            a, b = _pairs_in(col("doc_id"), col("comp"), points.reshape(-1, GROUPS).astype(np.int32), col("side"), like)
            if len(points) >= BLOCK * GROUPS // 16:  # a large group
                give_back()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                key = tuple(keys[:, a])
                if held and key != last:
                    yield flush()
                    held = []
                last = key
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()
        held.clear()
        give_back()

    return pairs


def _chunked(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) that link, by a look at both sets."""
    of = lambda s: sets.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"s{s}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(_verified(like), "a long, b long").distinct()


def _bounded(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) that can link, by their fine vectors; whole sets are sent for those only.

    Ids are dealt into blocks on either side, and each pair of blocks gets the vectors named in it once,
    however many pairs name them. Vectors are a thirtieth of the sets.
    """
    blocks = max(1, int(np.ceil(np.sqrt(pairs.count() / PAIRS))))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    keyed = pairs.select("a", "b", block("a").alias("low"), block("b").alias("high"))
    named = keyed.select(F.col("a").alias("doc_id"), "low", "high").union(keyed.select("b", "low", "high")).distinct()
    vectors = named.join(sets.select("doc_id", "fine"), "doc_id").select(
        F.col("low").alias("own_low"), F.col("high").alias("own_high"), "doc_id", "fine"
    )
    meeting = keyed.groupBy("low", "high").cogroup(vectors.groupBy("own_low", "own_high"))
    return meeting.applyInArrow(_likely(like), "a long, b long")


def _sets_of(docs: DataFrame, ids: DataFrame, like: Likeness, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Shingle sets of the documents named in ``ids``; broadcast if few enough (8 bytes each)."""
    few = ids.limit(broadcast_rows + 1).count() <= broadcast_rows
    side = F.broadcast(ids) if few else ids
    return stored(docs.join(side, "doc_id", "left_semi").mapInArrow(_set_rows(like), SETS), "sets")


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", like: Likeness = OWN
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    component_id is the least id reachable by links, the document's own included. A null or empty text, or one
    without words, has an empty set and links with nothing. Rows with the same
    id count as one document that has the links of each of them. Rows with a null id
    keep their count and get a null component. Other columns are not read. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    counts = None
    if like.percent < 90:
        counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(texts, like))
    rows = stored(texts.mapInArrow(_cell_rows(like, counts), CELLS), "cells")
    known = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # Stored, so that the join below is one Spark can split where a class has very many rows.
    classes = known.groupBy("n", "key1", "key2").agg(
        F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")
    ).filter("rep < last").drop("last")
    copies = known.select("doc_id", "n", "key1", "key2").join(stored(classes, "classes"), ["n", "key1", "key2"])
    same = copies.filter("doc_id > rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    in_cells = known.filter(F.size("cell") > 0).select(F.explode("cell").alias("cell"), "doc_id")
    alike = Window.partitionBy("cell")
    both_ends = in_cells.withColumn("hub", F.min("doc_id").over(alike)).withColumn("last", F.max("doc_id").over(alike))
    meet = stored(both_ends.filter("hub < last").drop("last"), "meetings")
    firsts = meet.filter("doc_id > hub").groupBy("doc_id").agg(F.min("hub").alias("hub"))
    firsts = stored(firsts.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")), "hubs")
    sets = _sets_of(texts, stored(meet.select("doc_id").distinct(), "met"), like)
    likely = stored(_bounded(firsts, sets, like), "likely")
    linked = stored(_chunked(likely, sets, like), "links")
    found = components(linked.union(same))

    # Cells that do not lie within one component.
    inside = meet.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "cell", "doc_id", F.coalesce("component", "doc_id").alias("comp")
    )
    open_cells = inside.groupBy("cell").agg(
        F.min("comp").alias("__low"), F.max("comp").alias("__high"), F.count(F.lit(1)).alias("__rows")
    )
    open_cells = open_cells.filter("__low < __high").select("cell", F.expr(f"cast(ceil(__rows / {BLOCK}) as int)").alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    facing = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = (
        inside.join(open_cells, "cell").withColumn("own", block).withColumn("other", facing)
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("low") == F.col("high"), 0).when(F.col("own") == F.col("low"), 1).otherwise(2))
    )
    points = spread.join(sets.select("doc_id", "counts"), "doc_id").select(
        "cell", "low", "high", "side", "doc_id", "comp", "counts"
    )
    pairs = (
        points.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_cell_pairs(like), "a long, b long").distinct()
    )
    likely = stored(_bounded(stored(pairs, "pairs"), sets, like), "likely")
    more = stored(_chunked(likely, sets, like), "links")
    labels = components(found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more))
    return (
        rows.select("doc_id", "n").join(labels, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", like: Likeness = OWN
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document stays.

    Of each group of linked documents the one with the least id stays, and of several rows with
    that id those with the least text, once. Documents without words and rows without an id stay.
    """
    found = stored(jaccard_components(docs, id_column, text_column, like), "components")

    def among(ids: DataFrame) -> DataFrame:
        """The ids, broadcast if they are few enough (8 bytes each)."""
        few = ids.limit(2_000_001).count() <= 2_000_000
        return F.broadcast(ids) if few else ids

    gone = found.filter(F.col("component_id") != F.col("doc_id"))
    gone = stored(gone.select(F.col("doc_id").alias("__id")).distinct(), "gone")
    same = F.col(id_column) == F.col("__id")
    kept = docs.join(among(gone), same, "left_anti")
    times = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
    several = stored(times.count().filter("count > 1").select("__id"), "several")
    if several.isEmpty():
        return kept
    least = F.min_by(F.struct(*docs.columns), F.struct(text_column))
    once = kept.join(among(several), same, "left_semi").groupBy(id_column).agg(least.alias("__row"))
    return kept.join(among(several), same, "left_anti").union(once.select("__row.*"))
