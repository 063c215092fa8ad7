"""Documents scored by cross-entropy difference of two word-bigram models.

A target model is counted over documents labelled good, a background model over all
documents; both have the same vocabulary (all words of the corpus), the same order and the
same smoothing. A document's score is the mean difference of its words' losses, target less
background: the lower, the more it reads like the target. Each document is left out of the counts
that judge it, so labelled documents are scored like any other.

Counts cover all words of all documents and are never gathered in one place. Tasks tokenise their
documents into blocks and keep those in the shared folder. The distinct words and
bigrams of each block, with their counts, are dealt by ranges of their hash; each range sums them over
all blocks and sends every block its sums back, in the block's own order. A block is then
scored on its own. What is shuffled are arrays: one row per block and range, so that even the most frequent
word is one number per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import ALNUM, U64, mix, word_chunks
from tidemark.llm.common import partitions_for, stored

BLOCK_WORDS = 250_000
RANGES = 4  # ranges of the hash for each shuffle partition, so that a range is small in memory
END = U64(0x5BF03635DB3A1F29)  # stands for both ends of a text
BLOCKS = "block long, words binary, vocabulary binary, sizes binary, ids array<long>, target array<boolean>, n_words long, n_target long"
PIECES = "block long, bucket int, keys binary, every binary, target binary"
SUMS = "block long, bucket int, every binary, target binary, distinct long"


@dataclass(frozen=True)
class Smoothing:
    """Pseudo-counts: ``word`` per word of the vocabulary, ``history`` per history."""

    word: float = 0.1
    history: float = 20.0


def packed(values: np.ndarray) -> bytes:
    """The bytes of numbers, all first bytes together, then all second ones, and so on.

    Counts and sorted hashes differ little in their high bytes; put together, compression takes those
    away. The block store and both shuffles are compressed by Spark.
    """
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def unpacked(data, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _block_rows(limit: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple] = []
        task, number, words_held = TaskContext.get().partitionId(), 0, 0

        def flush() -> pa.RecordBatch:
            hashes = np.concatenate([h[0] for h in held])
            sizes = np.concatenate([h[1] for h in held])
            vocabulary, words = np.unique(hashes, return_inverse=True)
            flags = pa.concat_arrays([h[3] for h in held])
            own = np.array([bool(x) for x in flags.to_pylist()], bool)
            columns = [
                pa.array([(task << 24) + number]), pa.array([packed(words.astype(np.int32))], pa.binary()),
                pa.array([packed(vocabulary)], pa.binary()), pa.array([packed(sizes.astype(np.int64))], pa.binary()),
                pa.array([pa.concat_arrays([h[2] for h in held]).to_pylist()], pa.list_(pa.int64())),
                pa.array([own.tolist()], pa.list_(pa.bool_())),
                pa.array([len(words)]), pa.array([int(sizes[own].sum())]),
            ]
            names = ["block", "words", "vocabulary", "sizes", "ids", "target", "n_words", "n_target"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for chunk in word_chunks(batch.column(2), ALNUM):
                sizes = chunk.count + 1
                hashes = np.full(int(sizes.sum()), END, U64)
                last = np.cumsum(sizes) - 1
                inner = np.ones(len(hashes), bool)
                inner[last] = False
                hashes[inner] = chunk.hashes()
                part = slice(chunk.first, chunk.first + chunk.rows)
                held.append((hashes, sizes, batch.column(0)[part], batch.column(1)[part]))
                words_held += len(hashes)
                if words_held >= limit:
                    yield flush()
                    held, words_held, number = [], 0, number + 1
        if held:
            yield flush()

    return rows


@dataclass
class Block:
    """A block's words as indexes into its sorted vocabulary; every text ends with ``END``."""

    number: int
    words: np.ndarray
    vocabulary: np.ndarray
    sizes: np.ndarray
    target: np.ndarray  # per text

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @property
    def before(self) -> np.ndarray:
        """The word before each, END at the beginning of a text."""
        out = np.empty_like(self.words)
        out[1:] = self.words[:-1]  # a text ends with END, so the next one begins after it
        out[:1] = np.searchsorted(self.vocabulary, END)
        return out

    def bigrams(self) -> np.ndarray:
        h = self.vocabulary
        return mix(h[self.before] * U64(0x9E3779B97F4A7C15) + mix(h[self.words] + U64(0x3C6EF372FE94F82B)))


def _block(words: bytes, vocabulary: bytes, sizes: bytes, target: list[bool], number: int) -> Block:
    return Block(
        number, unpacked(words, np.int32), unpacked(vocabulary, U64), unpacked(sizes, np.int64),
        np.array(target, bool),
    )


def _ranges(keys: np.ndarray, buckets: int) -> list[int]:
    """Where in sorted keys each of ``buckets`` equal ranges of the hash begins, and the end."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=U64)
    return [0, *np.searchsorted(keys, edges).tolist(), len(keys)]


def _piece_rows(buckets: int):
    """Distinct words (even buckets) and bigrams (odd ones) of each block, by range."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = _block(r["words"], r["vocabulary"], r["sizes"], r["target"], r["block"])
                good = block.target[block.text]
                bigrams = block.bigrams()
                keys, back = np.unique(bigrams, return_inverse=True)
                sides = (
                    (0, block.vocabulary, block.words),
                    (1, keys, back),
                )
                out: list[tuple] = []
                for odd, distinct, at in sides:
                    every = np.bincount(at, minlength=len(distinct)).astype(np.uint32)
                    target = np.bincount(at[good], minlength=len(distinct)).astype(np.uint32)
                    cuts = _ranges(distinct, buckets)
                    out += [
                        (block.number, 2 * k + odd, packed(distinct[a:b]), packed(every[a:b]), packed(target[a:b]))
                        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
                    ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.int32()),
                     *(pa.array([o[k] for o in out], pa.binary()) for k in (2, 3, 4))],
                    names=["block", "bucket", "keys", "every", "target"],
                )

    return rows


def _summed(group: pa.Table) -> pa.Table:
    """Sums over all blocks of one range, for each block in its own order."""
    read = lambda c, kind: [unpacked(x.as_buffer(), kind) for x in group.column(c)]
    keys = read("keys", U64)
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    out = []
    for c in ("every", "target"):
        sums = np.bincount(back, weights=np.concatenate(read(c, np.uint32)), minlength=len(distinct)).astype(np.uint64)
        out.append(pa.array([packed(x) for x in np.split(sums[back], cuts)], pa.binary()))
    words = len(distinct) if group.column("bucket")[0].as_py() % 2 == 0 else 0
    pa.default_memory_pool().release_unused()
    return pa.table({
        "block": group.column("block"), "bucket": group.column("bucket"), "every": out[0], "target": out[1],
        "distinct": pa.array([words] + [0] * (group.num_rows - 1), pa.int64()),
    })


def _own_counts(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often the text of each word has the word's key."""
    pair = mix(key.astype(U64) ^ mix(text.astype(U64) + U64(1)))
    _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
    return times[back]


def block_losses(block: Block, sums: dict, totals: dict, smoothing: Smoothing) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss of each text's words under the target and the background model.

    ``sums`` has the counts of the block's words and bigrams in all documents and in those of the
    target, in the block's order.
    """
    text, before = block.text, block.before
    bigrams = block.bigrams()
    _, at = np.unique(bigrams, return_inverse=True)
    own_word, own_pair = _own_counts(text, block.words), _own_counts(text, bigrams)
    # A history occurs as often as it is a word, END as often as there are texts.
    history_own = _own_counts(text, before)
    out = []
    for side in ("target", "every"):
        mine = block.target[text] if side == "target" else np.ones(len(text), bool)
        words, pairs = sums[(side, 0)].astype(float), sums[(side, 1)].astype(float)
        size = totals[side] - block.sizes[text] * mine
        single = (words[block.words] - own_word * mine + smoothing.word) / (size + smoothing.word * totals["distinct"])
        joint = pairs[at] - own_pair * mine
        history = words[before] - history_own * mine
        loss = -np.log((joint + smoothing.history * single) / (history + smoothing.history))
        out.append(np.bincount(text, weights=loss, minlength=len(block.sizes)) / block.sizes)
    return out[0], out[1]


def _scorer(totals: dict, smoothing: Smoothing):
    def score(group: pa.Table) -> pa.Table:
        buckets = group.column("bucket").to_pylist()
        own = group.slice(buckets.index(None), 1).to_pylist()[0]
        block = _block(own["words"], own["vocabulary"], own["sizes"], own["flags"], own["block"])
        order = sorted((b, i) for i, b in enumerate(buckets) if b is not None)
        sums = {
            (side, odd): np.concatenate([
                unpacked(group.column(side)[i].as_buffer(), np.uint64) for b, i in order if b % 2 == odd])
            for side in ("every", "target") for odd in (0, 1)
        }
        target, every = block_losses(block, sums, totals, smoothing)
        pa.default_memory_pool().release_unused()
        return pa.table({
            "doc_id": pa.array(own["ids"], pa.int64()), "n_tokens": pa.array(block.sizes),
            "loss_target": pa.array(target), "loss_background": pa.array(every),
        })

    return score


def cross_entropy_difference(
    docs: DataFrame,
    target_ids: DataFrame,
    smoothing: Smoothing = Smoothing(),
    block_words: int = BLOCK_WORDS,
    buckets: int | None = None,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background and ce_diff of every document.

    ``target_ids`` names the target's documents in a column doc_id. Words are lower-cased runs of letters
    and digits; the end of a text is a token too, so a null or empty text has one. A target without documents
    gives every word the same loss. Repeated rows are documents of their own; a null id is never in the target.
    An empty table gives no rows. Columns besides doc_id and text are not read.
    """
    ids = target_ids.select(F.col("doc_id").cast("long").alias("__id")).filter("__id is not null").distinct()
    if ids.limit(broadcast_rows + 1).count() <= broadcast_rows:
        ids = F.broadcast(ids)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    flagged = own.join(ids, F.col("doc_id") == F.col("__id"), "left").select(
        "doc_id", F.col("__id").isNotNull().alias("target"), "text"
    )
    blocks = stored(flagged.mapInArrow(_block_rows(block_words), BLOCKS), "blocks")
    count = buckets or RANGES * partitions_for(docs)
    pieces = blocks.mapInArrow(_piece_rows(count), PIECES)
    sums = stored(pieces.groupBy("bucket").applyInArrow(_summed, SUMS), "sums")
    n_words, n_target = blocks.agg(F.sum("n_words"), F.sum("n_target")).first()
    distinct = sums.agg(F.sum("distinct")).first()[0]
    totals = {"every": n_words or 0, "target": n_target or 0, "distinct": distinct or 0}
    missing = lambda kind: F.lit(None).cast(kind)
    parts = blocks.select(
        "block", missing("int").alias("bucket"), "words", "vocabulary", "sizes", "ids", F.col("target").alias("flags"),
        missing("binary").alias("every"), missing("binary").alias("target"),
    ).union(sums.select(
        "block", "bucket", *[missing("binary").alias(c) for c in ("words", "vocabulary", "sizes")],
        missing("array<bigint>").alias("ids"), missing("array<boolean>").alias("flags"), "every", "target",
    ))
    scored = parts.groupBy("block").applyInArrow(
        _scorer(totals, smoothing), "doc_id long, n_tokens long, loss_target double, loss_background double"
    )
    return scored.withColumn("ce_diff", F.col("loss_target") - F.col("loss_background"))
