"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Arrow hands a task the bytes of all texts of a batch in one buffer. Finding word
edges and hashing words are then a few array operations for a few megabytes of
text, without an object per word. Texts are always taken whole; a chunk holds
as many rows as fit a byte target, at least one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 2_000_000
HASH_BYTES = 250_000  # hashed at a time, since that takes fifty times as much memory


def byte_class(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_class([0x20, *range(0x09, 0x0E)])
# Everything but ASCII whitespace; and letters, digits and all beyond ASCII.
NOT_SPACE = ~SPACE
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_PLAIN = np.arange(256, dtype=U64)
_LOWER = np.where((_PLAIN >= 0x41) & (_PLAIN < 0x5B), _PLAIN + U64(32), _PLAIN)
# A random number for each byte, with and without letter case.
_CODES = {low: mix(b + U64(0x9E3779B97F4A7C15)) for low, b in ((False, _PLAIN), (True, _LOWER))}
_POWERS = [np.ones(1, U64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        base = np.full(max(n, 256), 0xD6E8FEB86659FD93, U64)
        base[0] = 1
        _POWERS[0] = np.cumprod(base)
    return _POWERS[0]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    offs = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


@dataclass
class Words:
    """The words of the rows ``first`` to ``first + rows`` of a batch, in order."""

    first: int
    rows: int
    data: np.ndarray  # bytes of the chunk
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    row: np.ndarray  # of each word, from 0 in the chunk
    count: np.ndarray  # words of each row
    offs: np.ndarray  # of each row, in data

    @property
    def edges(self) -> np.ndarray:
        """Index of each row's first word, and the number of all words."""
        return np.concatenate([[0], np.cumsum(self.count)]).astype(np.int64)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """64-bit hash of each word, of its lower-cased ASCII letters if asked."""
        size = self.end - self.start
        sums = np.empty(len(size), U64)
        for first, last in _between(np.concatenate([[0], np.cumsum(size)]), HASH_BYTES):
            n = size[first:last]
            before = np.cumsum(n) - n
            place = np.arange(n.sum(), dtype=np.int64) - np.repeat(before, n)
            index = np.repeat(self.start[first:last], n) + place
            code = _CODES[lower][self.data[index]] * _powers(int(n.max()) + 1)[place]
            sums[first:last] = np.add.reduceat(code, before)
        return mix(sums + size.astype(U64))


def _between(offs: np.ndarray, target: int) -> Iterator[tuple[int, int]]:
    first, n = 0, len(offs) - 1
    while first < n:
        last = int(np.searchsorted(offs, offs[first] + target, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def word_chunks(column: pa.Array, members: np.ndarray, target: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column: maximal runs of bytes in ``members``."""
    data, offs = text_buffer(column)
    for first, last in _between(offs, target):
        own = offs[first : last + 1] - offs[first]
        part = data[offs[first] : offs[last]]
        inside = members[part]
        before = np.empty(len(part), bool)
        after = np.empty(len(part), bool)
        if len(part):
            before[1:], before[0] = inside[:-1], False
            after[:-1], after[-1] = inside[1:], False
            starts = own[:-1][own[:-1] < len(part)]
            before[starts] = False
            ends = own[1:][own[1:] > 0] - 1
            after[ends] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        row = np.searchsorted(own, start, "right") - 1
        count = np.bincount(row, minlength=last - first)
        yield Words(first, last - first, part, start, end, row, count, own)


def give_back() -> None:
    """Return freed memory to the system; a worker lives on after its task and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def sort_rows(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sort ``values`` within each row, in place."""
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    return values
