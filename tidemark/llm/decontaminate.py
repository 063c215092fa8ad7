"""Benchmark decontamination with an FM-index per shard of training text.

Every task cuts its documents into shards of a megabyte and builds an FM-index over the
words of each. Test phrases, ten consecutive words of an item (or the whole of a
shorter one), are searched in it backwards, all phrases at once, with ranks from a wavelet
matrix over the Burrows-Wheeler transform. Occurrences are located by walking back to
the next sampled suffix position, and the words they cover are merged into spans for removal.

An index holds about a million words. Longer shards, such as one very long text, are cut into
stretches that overlap by all but one word of the longest phrase, so that every occurrence lies whole in one.

The index's alphabet is the words of the phrases. Any other word ends a run, since no
phrase can span it, and a run shorter than the shortest phrase is left out. Texts are
searched whole and nothing is shuffled. Phrases reach the tasks in blocks of bounded
size, however large the benchmark; with several blocks the documents' spans are united.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import ALNUM, Words, give_back, word_chunks
from tidemark.llm.common import stored, unused

PHRASE = 10
SAMPLE = 8  # every so many positions of a run are kept for locating
SHARD_BYTES = 1_000_000  # a task holds some 25 times as much while it indexes one
INDEX_WORDS = 1 << 20  # positions of one index; what it takes of memory does not grow with a text


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit per symbol and level."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        at = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = ((at >> level) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(at) - int(self.ones[-1][-1]))
            at = np.concatenate([at[~bit], at[bit]])
        # Where the run of each symbol begins on the last level.
        self.origin = self._walk(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.depth - 1, -1, -1)):
            ones = self.ones[k][place]
            place = np.where((symbol >> level) & 1, self.zeros[k] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``place``."""
        return self._walk(symbol, place) - self.origin[symbol]


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; a suffix ends with its run.

    ``left`` is how many words the run still has at each position, 0 at separators.
    Prefix doubling: ranks by the first 1, 2, 4, ... words, each round one sort of
    packed (rank, rank further on, position), or of two keys where the three do not fit 64 bits.
    """
    n = len(text)
    bits = max(1, int(n).bit_length())
    place = np.arange(n, dtype=np.uint64)
    rank = np.unique(text, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    rank[left == 0] = 0
    reach, longest = 1, int(left.max(initial=0))
    order = None
    while True:
        further = np.zeros(n, np.uint64)
        inside = np.flatnonzero(left > reach)
        further[inside] = rank[inside + reach]
        if 3 * bits <= 64:
            packed = (((rank << np.uint64(bits)) | further) << np.uint64(bits)) | place
            packed.sort()
            order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
            packed >>= np.uint64(bits)
            differs = packed[1:] != packed[:-1]
        else:
            order = np.lexsort((further, rank))  # stable: equal ones stay in order of position
            one, two = rank[order], further[order]
            differs = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        reach *= 2
        if reach >= longest:
            return order
        fresh = np.concatenate([[0], np.cumsum(differs)]).astype(np.uint64)
        rank = np.empty(n, np.uint64)
        rank[order] = fresh + np.uint64(1)
        rank[left == 0] = 0


class FmIndex:
    """An FM-index over runs of symbols from 1 up, each run followed by a 0."""

    def __init__(self, text: np.ndarray, left: np.ndarray, largest: int):
        order = suffix_order(text, left)
        before = np.where(order > 0, text[order - 1], 0)
        self.ranks = WaveletMatrix(before, largest)
        self.before = before
        counts = np.bincount(text, minlength=largest + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])[: largest + 2]
        # Starts of runs are sampled too, so that no walk leaves its run.
        index = np.arange(len(text))
        self.sampled = (before == 0) | (order % SAMPLE == 0)
        self.position = np.where(self.sampled, order, -1)
        self.size = len(index)

    def search(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray):
        """The interval of suffixes that begin with each phrase, last word first."""
        low = np.zeros(len(start), np.int64)
        high = np.full(len(start), self.size, np.int64)
        live = np.arange(len(start))
        for step in range(int(length.max(initial=0))):
            live = live[(length[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            c = symbols[start[live] + length[live] - 1 - step]
            low[live] = self.first[c] + self.ranks.rank(c, low[live])
            high[live] = self.first[c] + self.ranks.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking back to sampled ones."""
        out = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            done = self.sampled[at]
            out[left[done]] = self.position[at[done]] + steps
            left, at = left[~done], at[~done]
            c = self.before[at]
            at = self.first[c] + self.ranks.rank(c, at)
            steps += 1
        return out


@dataclass
class Phrases:
    """The words of some items, and the phrases as stretches of them."""

    vocabulary: np.ndarray  # sorted hashes; a word's symbol is its place plus 1
    symbols: np.ndarray  # of all words of all items
    start: np.ndarray
    length: np.ndarray
    item: np.ndarray  # index into names
    names: list[str]


def phrases_of(names: list[str], texts: list[str | None], length: int = PHRASE) -> Phrases:
    hashes, counts = [], []
    for words in word_chunks(pa.array(texts, pa.string()), ALNUM):
        hashes.append(words.hashes())
        counts.append(words.count)
    all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    vocabulary, symbols = np.unique(all_hashes, return_inverse=True)
    per = np.where(n >= length, n - length + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])[:-1]
    item = np.repeat(np.arange(len(n)), per)
    nth = np.arange(per.sum()) - np.repeat(np.concatenate([[0], np.cumsum(per)])[:-1], per)
    return Phrases(
        vocabulary, symbols.astype(np.int64) + 1, begin[item] + nth, np.minimum(n[item], length), item, names
    )


def phrase_runs(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shard's text for the index: symbols, words left in the run, and each word's index."""
    h = words.hashes()
    at = np.minimum(np.searchsorted(phrases.vocabulary, h), len(phrases.vocabulary) - 1)
    symbol = np.where(phrases.vocabulary[at] == h, at + 1, 0)
    known = symbol > 0
    joined = np.zeros(len(h), bool)
    joined[1:] = known[1:] & known[:-1] & (words.row[1:] == words.row[:-1])
    first = np.flatnonzero(known & ~joined)
    ends = np.flatnonzero(known & ~np.concatenate([joined[1:], [False]])) + 1
    use = ends - first >= phrases.length.min()
    first, size = first[use], (ends - first)[use]
    to = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
    place = np.arange(to[-1]) - np.repeat(to[:-1], size + 1)
    left = np.repeat(size, size + 1) - place
    index = np.repeat(first, size + 1) + place
    text = np.where(left > 0, symbol[np.minimum(index, len(symbol) - 1)], 0)
    return text, left, index


def stretches(
    text: np.ndarray, left: np.ndarray, overlap: int, most: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First position, symbols and words left in the run, of stretches for one index each.

    ``most`` positions and ``overlap`` further ones: any ``overlap`` + 1 words of a run lie whole in one.
    """
    for first in range(0, len(text), most):
        last = min(first + most + overlap, len(text))
        own = np.minimum(left[first:last], last - np.arange(first, last))
        yield first, np.append(text[first:last], 0), np.append(own, 0)


def found_in(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word whether a phrase covers it, and the distinct (row, item) pairs."""
    hit = np.zeros(len(words.start) + 1, np.int64)
    none = np.zeros(0, np.int64)
    if not len(words.start) or not len(phrases.start):
        return hit[:-1] > 0, none, none
    text, left, index = phrase_runs(words, phrases)
    if not len(text):
        return hit[:-1] > 0, none, none
    pairs = []
    # What is found twice, where stretches overlap, covers the same words.
    for first, symbols, rest in stretches(text, left, int(phrases.length.max()) - 1, INDEX_WORDS):
        fm = FmIndex(symbols, rest, len(phrases.vocabulary))
        low, high = fm.search(phrases.symbols, phrases.start, phrases.length)
        many = np.flatnonzero(high > low)
        # A few million occurrences at a time.
        for part in np.split(many, np.flatnonzero(np.diff(np.cumsum((high - low)[many]) // 2_000_000)) + 1):
            count = (high - low)[part]
            if not len(part):
                continue
            which = np.repeat(part, count)
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which]
            at = index[first + fm.locate(rows)]
            hit += np.bincount(at, minlength=len(hit))
            hit -= np.bincount(at + phrases.length[which], minlength=len(hit))
            pairs.append(np.unique(words.row[at] * len(phrases.names) + phrases.item[which]))
    both = np.unique(np.concatenate(pairs)) if pairs else none
    return np.cumsum(hit[:-1]) > 0, both // len(phrases.names), both % len(phrases.names)


SPAN = "struct<first:long,last:long,start:long,end:long>"
FOUND = f"n_words long, spans array<{SPAN}>, items array<string>"


def _spans(words: Words, hit: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of every run of hit words, and its words and code points within the row."""
    edge = np.zeros(len(hit), bool)
    edge[1:] = words.row[1:] != words.row[:-1]
    begins = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge))
    stops = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | np.concatenate([edge[1:], [True]])))
    row = words.row[begins]
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    zero = chars[words.offs[row]]
    first = words.edges[row]
    return row, [
        begins - first, stops + 1 - first,
        chars[words.start[begins]] - zero, chars[words.end[stops]] - zero,
    ]


def _lists(row: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(**shared.value)
        names = pa.array(phrases.names, pa.string())
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for words in word_chunks(text, ALNUM, SHARD_BYTES):
                hit, row, item = found_in(words, phrases)
                at, parts = _spans(words, hit)
                spans = pa.StructArray.from_arrays(
                    [pa.array(p, pa.int64()) for p in parts], names=["first", "last", "start", "end"]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(words.first, words.rows) for i in range(batch.num_columns - 1)]
                    + [pa.array(words.count, pa.int64()), _lists(at, words.rows, spans),
                       _lists(row, words.rows, names.take(pa.array(item, pa.int64())))],
                    names=batch.schema.names[:-1] + ["n_words", "spans", "items"],
                )
                del words, hit, row, item, at, parts, spans
                give_back()

    return search


def united(spans: Column) -> Column:
    """Overlapping or touching spans of one document made one."""
    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"),
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
        )
        return F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["last"] >= s["first"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)),
        ).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.expr(f"cast(array() as array<{SPAN}>)"), add)


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[tuple[list, list]]:
    """Items in blocks of about ``chars`` characters; one longer item is a block of its own."""
    names, texts, held = [], [], 0
    for item, text in benchmark.toLocalIterator():
        names.append("" if item is None else str(item))
        texts.append(text)
        held += len(text or "")
        if held >= chars:
            yield names, texts
            names, texts, held = [], [], 0
    if names:
        yield names, texts


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    block_chars: int = 8_000_000,
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with n_words, spans and items.

    spans are the merged runs of words that test phrases cover, as word numbers (first,
    last) and code points (start, end), ends exclusive; items the ids, as text, of the
    items with a phrase in the text. A null or empty text has no words and no
    spans. An item without words is never found, one with a null id is named by the empty text, and
    items with the same id count once. Repeated rows are searched as often as they occur.
    Benchmark text reaches tasks in blocks of at most ``block_chars`` characters or one item.
    """
    sc = docs.sparkSession.sparkContext
    names = {c: f"__{i}" for i, c in enumerate(keep)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(text_column).alias("__text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "__text"}

    def searched(source: DataFrame, block: tuple[list, list], extra: str = "") -> DataFrame:
        schema = ", ".join([*(f"{n} {k}" for n, k in kinds.items()), *([extra] if extra else []), FOUND])
        return source.mapInArrow(_searcher(sc.broadcast(vars(phrases_of(*block)))), schema)

    blocks = _blocks(benchmark.select(item_column, item_text), block_chars)
    first = next(blocks, ([], []))
    second = next(blocks, None)
    if second is None:
        out = searched(rows, first)
    else:
        numbered = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        numbered = numbered.select(*kinds, "__row", "__text")
        parts = None
        for block in [first, second]:
            parts = _more(parts, searched(numbered, block, "__row long"))
        for block in blocks:
            parts = _more(parts, searched(numbered, block, "__row long"))
        out = parts.groupBy("__row").agg(
            *[F.first(n).alias(n) for n in kinds],
            F.first("n_words").alias("n_words"),
            united(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    return out.select(
        *[F.col(n).alias(c) for c, n in names.items()],
        "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"),
    )


def _more(parts: DataFrame | None, new: DataFrame) -> DataFrame:
    new = stored(new, "found")
    return new if parts is None else parts.union(new)


def report(found: DataFrame) -> DataFrame:
    """Counts and the digest of item ids in place of spans and items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that no test phrase occurs in."""
    found = contaminated_spans(docs, benchmark, docs.columns, text_column)
    return found.filter(F.size("spans") == 0).select(*docs.columns)


def without_spans(text: Column, spans: Column) -> Column:
    """A text with its spans cut out, for those who would rather keep the rest."""
    after = F.transform(
        spans,
        lambda s, i: F.substring(
            text, (s["end"] + 1).cast("int"),
            (F.coalesce(F.get(spans, i + 1)["start"], F.length(text)) - s["end"]).cast("int"),
        ),
    )
    before = F.substring(text, F.lit(1), F.coalesce(F.get(spans, F.lit(0))["start"], F.length(text)).cast("int"))
    return F.when(F.size(spans) > 0, F.concat(before, F.array_join(after, ""))).otherwise(text)
