"""Token counts by byte-pair merging, all sequences of a batch at once.

Texts are cut where no piece of the vocabulary can reach across, which gives
short pre-tokens. The distinct ones of a batch are held as one ragged numpy array of
symbols. A round finds each sequence's best-ranked pair and merges all its
occurrences, in every sequence at the same time; a sequence without pairs is
done and leaves the array. What survives is counted.

Merging all occurrences at once equals merging them one by one from the left unless a
merge makes a pair that ranks as high. That is looked for in every round, and a
sequence it happens to is merged in strict order instead.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import U64, mix

SPACE_MARK = "▁"  # what stands for a space in pieces
SEGMENT = 500_000  # code points merged at a time
IN_ORDER = 20_000  # longer sequences are merged in strict order, whose time does not grow with rounds
SLOT_BITS = 20
NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class MergeTable:
    """A vocabulary as arrays; symbols are pieces, then single characters that only occur within pieces.

    ``rank`` is lower for what is merged earlier; pairs are ``left * symbols + right``, sorted.
    ``near`` holds which of the known characters can be neighbours in a piece.
    """

    symbols: int
    cost: np.ndarray  # tokens of each symbol left over
    chars: np.ndarray  # code points that are symbols, sorted
    char_symbol: np.ndarray
    pairs: np.ndarray
    pair_symbol: np.ndarray
    pair_rank: np.ndarray
    near: np.ndarray  # flat index into a square of known characters


def merge_table(model_file: str) -> MergeTable:
    """The merges of a sentencepiece BPE model that falls back to bytes.

    Only what this module can reproduce is accepted: texts unchanged but for a space mark in front
    and in place of spaces, and no pieces given by the user.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    probe = "a  ÅÅＡ ́b "
    if model.normalize(probe) != SPACE_MARK + probe.replace(" ", SPACE_MARK):
        raise ValueError("the model changes texts before it merges")
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    if any(model.is_unused(i) for i in ids) or sum(model.is_byte(i) for i in ids) != 256:
        raise ValueError("the model has unused pieces or no bytes to fall back to")
    score = {model.id_to_piece(i): model.get_score(i) for i in plain}
    names = list(score)
    extra = sorted({c for p in names for c in p} - set(names))
    number = {p: k for k, p in enumerate([*names, *extra])}
    order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
    n = len(number)
    found = []
    for piece in names:
        for cut in range(1, len(piece)):
            left, right = number.get(piece[:cut]), number.get(piece[cut:])
            if left is not None and right is not None:
                found.append((left * n + right, number[piece], order[score[piece]]))
    found.sort()
    table = np.array(found, np.int64).reshape(-1, 3)
    chars = sorted(ord(p) for p in number if len(p) == 1)
    place = {c: k for k, c in enumerate(chars)}
    near = sorted({place[ord(a)] * len(chars) + place[ord(b)] for p in names for a, b in zip(p, p[1:])})
    return MergeTable(
        n,
        np.array([1] * len(names) + [len(c.encode()) for c in extra], np.int32),
        np.array(chars, np.int64),
        np.array([number[chr(c)] for c in chars], np.int32),
        table[:, 0].copy(),
        table[:, 1].astype(np.int32),
        table[:, 2].astype(np.int32),
        np.array(near, np.int64),
    )


class Merger:
    """Counts the tokens of batches of texts with one table."""

    def __init__(self, table: MergeTable):
        self.table = table
        known = len(table.chars)
        self.place = np.full(0x110000, known, np.int32)  # unknown characters come last
        self.place[table.chars] = np.arange(known, dtype=np.int32)
        self.near = np.zeros((known + 1) * (known + 1), bool)
        self.near[table.near // max(known, 1) * (known + 1) + table.near % max(known, 1)] = True
        self.width = known + 1
        # The pairs hashed into a sparse table, so that most are found, or missed, at the first place.
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        left = np.arange(len(table.pairs))
        at = _slot(table.pairs)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; a rank of NONE where they do not merge."""
        t = self.table
        rank, into = np.full(len(left), NONE, np.int32), np.zeros(len(left), np.int32)
        if not len(t.pairs):
            return rank, into
        key = left.astype(np.int64) * t.symbols + right
        at, open_ = _slot(key), None
        while True:
            found = self.slots[at]
            there = found >= 0
            same = there & (t.pairs[found] == key)
            hit = np.flatnonzero(same)
            put = hit if open_ is None else open_[hit]
            rank[put], into[put] = t.pair_rank[found[hit]], t.pair_symbol[found[hit]]
            on = np.flatnonzero(there & ~same)
            if not len(on):
                return rank, into
            open_ = on if open_ is None else open_[on]
            key, at = key[on], (at[on] + 1) & (len(self.slots) - 1)

    def in_order(self, symbols: np.ndarray) -> int:
        """Tokens of one sequence, its best pair merged again and again, the leftmost of equals first."""
        sym, n = symbols.tolist(), len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, merged = self._looked_up(symbols[:-1], symbols[1:])
        heap = [(r, i, m, sym[i], sym[i + 1]) for i, (r, m) in enumerate(zip(rank.tolist(), merged.tolist())) if r != NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def offer(i: int, j: int) -> None:
            pair = sym[i], sym[j]
            if pair not in known:
                r, m = self._looked_up(np.array(pair[:1]), np.array(pair[1:]))
                known[pair] = int(r[0]), int(m[0])
            r, m = known[pair]
            if r != NONE:
                heapq.heappush(heap, (r, i, m, *pair))

        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of the two has been merged since
            sym[i], sym[j] = made, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)
        return int(sum(self.table.cost[s] for s in sym if s >= 0))

    def merged_counts(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each sequence of known symbols; ``sizes`` are their lengths, all above 0."""
        counts = np.zeros(len(sizes), np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        apart = [int(k) for k in np.flatnonzero(sizes > IN_ORDER)]
        own = np.repeat(np.arange(len(sizes)), sizes)
        stay = np.repeat(sizes <= IN_ORDER, sizes)
        sym, seq = symbols[stay], own[stay]
        rank, into = self._ranks(sym, seq)
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            size = np.diff(np.concatenate([starts, [len(seq)]]))
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                over = np.repeat(done, size)
                counts += np.bincount(seq[over], self.table.cost[sym[over]], len(counts)).astype(np.int64)
                sym, seq, rank, into = sym[~over], seq[~over], rank[~over], into[~over]
                best, size = best[~done], size[~done]
                if not len(sym):
                    break
            goal = np.repeat(best, size)
            # Of pairs that overlap, every other one from the left.
            hit = np.flatnonzero(rank == goal)
            breaks = np.concatenate([[True], np.diff(hit) != 1])
            first = np.maximum.accumulate(np.where(breaks, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            level, made = goal[hit], into[hit]
            # The right neighbour as it is before it is merged itself.
            after = np.minimum(hit + 2, len(sym) - 1)
            inside = (hit + 2 < len(sym)) & (seq[after] == seq[hit])
            r, _ = self._looked_up(made, sym[after])
            unsure = inside & (r <= level)
            sym[hit] = made
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            moved = hit - np.arange(len(hit))  # places once the right halves are gone
            sym, seq, rank, into = sym[keep], seq[keep], rank[keep], into[keep]
            changed = np.zeros(len(sym), bool)
            changed[moved] = True
            changed[moved[moved > 0] - 1] = True
            self._update(sym, seq, rank, into, np.flatnonzero(changed))
            before = np.maximum(moved - 1, 0)
            unsure |= (moved > 0) & (seq[before] == seq[moved]) & (rank[before] <= level)
            if unsure.any():
                strict = np.unique(seq[moved[unsure]])
                apart.extend(strict.tolist())
                stay = ~np.isin(seq, strict)
                sym, seq, rank, into = sym[stay], seq[stay], rank[stay], into[stay]
        for k in apart:
            counts[k] = self.in_order(symbols[edges[k] : edges[k + 1]])
        return counts

    def _ranks(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
        self._update(sym, seq, rank, into, np.arange(len(sym)))
        return rank, into

    def _update(self, sym, seq, rank, into, at: np.ndarray) -> None:
        """Look up the pairs that begin at some places anew."""
        last = at == len(sym) - 1
        rank[at[last]] = NONE
        at = at[~last]
        r, m = self._looked_up(sym[at], sym[at + 1])
        rank[at] = np.where(seq[at] == seq[at + 1], r, NONE)
        into[at] = m

    def segment_counts(self, codes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Tokens of each row of a segment; ``codes`` are its code points and ``row`` says whose each is."""
        if not len(codes):
            return np.zeros(rows, np.int64)
        place = self.place[codes]
        known = place < self.width - 1
        # Characters outside the vocabulary become their bytes.
        spelt = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        out = np.bincount(row[~known], spelt[~known], rows).astype(np.int64)
        joins = self.near[place[:-1].astype(np.int64) * self.width + place[1:]] & (row[:-1] == row[1:])
        starts = np.flatnonzero(np.concatenate([[True], ~joins]))
        starts = starts[known[starts]]
        ends = np.flatnonzero(np.concatenate([~joins, [True]])) + 1
        ends = ends[known[ends - 1]]
        if not len(starts):
            return out
        sizes = ends - starts
        index = _ragged(starts, sizes)
        flat = self.table.char_symbol[place[index]]
        offs = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        which, back = _distinct(flat, offs, sizes)
        counts = self.merged_counts(flat[_ragged(offs[which], sizes[which])], sizes[which])
        return out + np.bincount(row[starts], counts[back], rows).astype(np.int64)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for first, parts in self._segments(texts):
            codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            codes[codes == 0x20] = ord(SPACE_MARK)
            row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            out[first : first + len(parts)] += self.segment_counts(codes, row, len(parts))
        return out

    def _segments(self, texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
        """Runs of texts of some size together; a long text is cut where no piece reaches across."""
        parts, size, first = [], 0, 0
        for k, text in enumerate(texts):
            text = " " + text if text else ""
            if size and size + len(text) > SEGMENT:
                yield first, parts
                parts, size, first = [], 0, k
            start = 0
            while len(text) - start > SEGMENT:
                cut = self._border(text, start + SEGMENT)
                yield k, [text[start:cut]]
                start = cut
                # Whatever was gathered before this text has been handed out above.
                parts, size, first = [], 0, k
            parts.append(text[start:])
            size += len(text) - start
        if parts:
            yield first, parts

    def _border(self, text: str, at: int, step: int = 4096) -> int:
        """The first place from ``at`` on where the text may be cut."""
        while at < len(text):
            codes = np.frombuffer(text[at - 1 : at + step].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            codes[codes == 0x20] = ord(SPACE_MARK)
            place = self.place[codes].astype(np.int64)
            free = np.flatnonzero(~self.near[place[:-1] * self.width + place[1:]])
            if len(free):
                return at + int(free[0])
            at += step
        return len(text)


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - SLOT_BITS)).astype(np.int64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of runs, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def _distinct(flat: np.ndarray, offs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each distinct run, and for every run which of those it equals.

    Runs are compared by a hash and then symbol by symbol; one that only shares the hash counts as distinct.
    """
    place = np.arange(len(flat)) - np.repeat(offs, sizes)
    base = np.full(int(sizes.max()), 0xD6E8FEB86659FD93, U64)
    base[0] = 1
    code = mix(flat.astype(U64) + U64(0x9E3779B97F4A7C15)) * np.cumprod(base)[place]
    hashed = mix(np.add.reduceat(code, offs) + sizes.astype(U64))
    _, which, back = np.unique(hashed, return_index=True, return_inverse=True)
    same = sizes == sizes[which][back]
    index = _ragged(offs[which][back][same], sizes[same])
    differs = flat[_ragged(offs[same], sizes[same])] != flat[index]
    same[np.flatnonzero(same)[np.unique(np.repeat(np.arange(int(same.sum())), sizes[same])[differs])]] = False
    odd = np.flatnonzero(~same)
    back[odd] = len(which) + np.arange(len(odd))
    return np.concatenate([which, odd]), back


def token_count(text: Column, table: MergeTable) -> Column:
    """Tokens of a text; a null or empty text has none. The table is a few megabytes, sent to each task."""
    parts, made = vars(table), []

    def counted(column: pa.Array) -> pa.Array:
        if not made:  # once per task
            made.append(Merger(MergeTable(**parts)))
        return pa.array(made[0].counts(column.to_pylist()))

    return F.arrow_udf(counted, "long")(text)


def token_report(docs: DataFrame, table: MergeTable, limit: int) -> DataFrame:
    """Id, UTF-8 bytes and tokens of every document, and whether it has more than ``limit`` tokens.

    A null text is as an empty one: no bytes, no tokens. Texts are counted whole, however long; repeated rows and
    null ids give rows of their own; an empty table gives none. Other columns are not read.
    """
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col("text"), table).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
