"""A quality score by Bradley-Terry pairwise ranking.

Documents are described by how their text is written: lengths, letter case, symbols,
repetition. A score that is linear in these is learnt from preference pairs, a
document labelled good over one labelled bad, by logistic loss on the difference of
their features. The scores of the labelled rows then set a threshold at the quantile that
equals the share of bad ones, and a slope, so that 0.5 separates the classes. All labelled rows take
part in each of these; their numbers stay in Spark tables, and only sums over them reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.blocks import NOT_SPACE, U64, Words, byte_class, mix, word_chunks
from tidemark.llm.common import stored
from tidemark.llm.training import known_labels, sigmoid

PAIRS = 60_000  # at least so many preference pairs; of more labelled rows each is in one or more
BROADCAST_LABELS = 2_000_000  # up to so many labelled ids are sent to the texts
BROADCAST_EXAMPLES = 50_000  # up to so many rows of the rarer class are sent to the other
_PARTS = 1024  # rows are numbered within so many parts, whatever the cluster

_CLASSES = [
    byte_class(b"#*$%&|<>"), byte_class(b".,;:"), byte_class(b"!?"), byte_class(range(0x41, 0x5B)),
    byte_class(range(0x61, 0x7B)), byte_class(range(0x30, 0x3A)), byte_class(range(0x80, 0x100)),
    byte_class(b"\n"), byte_class(b"()[]{}\"'/\\@=+-_~`^"),
]
FEATURES = 2 * (len(_CLASSES) + 4) + 5


def _repeated(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Share of each row's keys that occur in it more than once."""
    if not len(keys):
        return np.zeros(rows)
    pair = mix(keys ^ mix(row.astype(U64) + U64(1)))
    _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
    many = np.bincount(row, weights=times[back] > 1, minlength=rows)
    return many / np.maximum(1, np.bincount(row, minlength=rows))


def features(words: Words) -> np.ndarray:
    """A row of numbers for each text of a chunk."""
    rows, row, n = words.rows, words.row, words.count
    size = np.diff(words.offs)
    text_row = np.repeat(np.arange(rows), size)
    kinds = np.full(256, len(_CLASSES))
    for k, members in enumerate(_CLASSES):
        kinds[members] = k
    width = len(_CLASSES) + 1
    counts = np.bincount(text_row * width + kinds[words.data], minlength=rows * width).reshape(rows, width)
    rates = counts[:, :-1] / np.maximum(1, size)[:, None]
    h = words.hashes()
    length = (words.end - words.start).astype(float)
    per = np.maximum(1, n)
    mean = np.bincount(row, weights=length, minlength=rows) / per
    square = np.bincount(row, weights=length**2, minlength=rows) / per
    inside = lambda k: row[k:] == row[: len(row) - k]
    spans = {}
    for k in (2, 5):
        ok = inside(k - 1) if len(row) >= k else np.zeros(0, bool)
        key = np.zeros(len(ok), U64)
        for j in range(k):
            key = mix(key * U64(3) + h[j : j + len(ok)])
        spans[k] = _repeated(key[ok], row[: len(ok)][ok], rows)
    once = _repeated(h, row, rows)
    ends = np.isin(words.data[words.end - 1], np.frombuffer(b".!?", np.uint8)) if len(row) else np.zeros(0)
    sentence = np.bincount(row, weights=ends, minlength=rows) / per
    shares = np.column_stack([rates, spans[2], spans[5], once, sentence])
    # Each share as it is, and as whether there is a notable amount of it.
    return np.column_stack([
        shares, np.minimum(shares / 0.05, 1.0),
        np.log1p(n), np.log1p(size), np.minimum(mean, 30), np.sqrt(np.maximum(0, square - mean**2)).clip(0, 30), n < 5,
    ])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column as it is, and the features of the text in the second."""
    for batch in batches:
        for words in word_chunks(batch.column(1), NOT_SPACE):
            x = features(words)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(words.first, words.rows), lists], names=[batch.schema.names[0], "x"]
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), FEATURES)


@dataclass
class Ranking:
    """A linear score in standardised features, and where and how steeply it is cut."""

    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.center) / self.spread) @ self.weights
        return sigmoid(self.slope * (raw - self.threshold))


def labelled_examples(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(label, x) of every labelled text, once each: copies of a text say nothing new."""
    rows = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    if known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        labelled = rows.join(F.broadcast(known), "doc_id").select("label", "text")
        found = labelled.mapInArrow(_feature_rows, "label int, x array<double>")
    else:
        # The numbers are shuffled, not the texts.
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = rows.mapInArrow(_feature_rows, f"doc_id {kind}, x array<double>").join(known, "doc_id").select("label", "x")
    return found.dropDuplicates(["label", "x"])


def _numbered(examples: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Rows with gapless numbers ``i`` within each label, in an order by hash, and the rows of each label."""
    parted = examples.withColumn("part", F.pmod(F.xxhash64("x"), F.lit(_PARTS)).cast("int"))
    sizes = {(r["label"], r["part"]): r["n"] for r in parted.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, totals = [], {0: 0, 1: 0}
    for label, part in sorted(sizes):
        starts.append((label, part, totals[label]))
        totals[label] += sizes[label, part]
    start = examples.sparkSession.createDataFrame(starts, "label int, part int, start long")
    rank = F.row_number().over(Window.partitionBy("label", "part").orderBy(F.xxhash64("x"), "x"))
    placed = parted.withColumn("rank", rank).join(F.broadcast(start), ["label", "part"])
    return placed.select("label", "x", (F.col("start") + F.col("rank") - 1).alias("i")), totals


def preference_pairs(examples: DataFrame, pairs: int = PAIRS) -> tuple[DataFrame | None, dict[int, int]]:
    """Feature differences ``d`` of good and bad rows, and the rows of each label; no pairs where a class is missing.

    Every row of the commoner class is paired with rows of the rarer one in turn, once or until there are ``pairs``
    pairs, so that each row of both is in one at least.
    """
    numbered, totals = _numbered(examples)
    if not all(totals.values()):
        return None, totals
    many = 1 if totals[1] >= totals[0] else 0
    few = totals[1 - many]
    rounds = max(1, -(-pairs // totals[many]))
    turn = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("turn")
    often = numbered.filter(F.col("label") == many).select("x", "i", turn)
    often = often.select("x", F.pmod(F.col("i") + F.col("turn") * max(1, few // rounds), F.lit(few)).alias("i"))
    rare = numbered.filter(F.col("label") != many).select(F.col("x").alias("other"), "i")
    met = often.join(F.broadcast(rare) if few <= BROADCAST_EXAMPLES else rare, "i")
    good, bad = ("x", "other") if many == 1 else ("other", "x")
    return met.select(F.zip_with(good, bad, lambda a, b: a - b).alias("d")), totals


def fit_weights(pairs: DataFrame, spread: np.ndarray, ridge: float = 10.0, steps: int = 30) -> np.ndarray:
    """Bradley-Terry weights of all pairs by Newton steps; a partition sends its gradient and Hessian.

    ``ridge`` is the penalty beside 60,000 pairs, and grows with them.
    """
    w = np.zeros(FEATURES)
    for _ in range(steps):

        def summed(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            n, gradient, hessian = 0, np.zeros(FEATURES), np.zeros((FEATURES, FEATURES))
            for batch in batches:
                d = _matrix(batch.column(0)) / spread
                p = sigmoid(d @ w)
                n += len(d)
                gradient += d.T @ (p - 1)
                hessian += (d * (p * (1 - p))[:, None]).T @ d
            yield pa.RecordBatch.from_pydict({"s": pa.array([[float(n), *gradient, *hessian.ravel()]])})

        # Each pair once in either order would double the loss and change nothing.
        total = np.sum([r["s"] for r in pairs.mapInArrow(summed, "s array<double>").collect()], axis=0)
        penalty = ridge * total[0] / PAIRS
        gradient = total[1 : FEATURES + 1] + penalty * w
        step = np.linalg.solve(total[FEATURES + 1 :].reshape(FEATURES, FEATURES) + penalty * np.eye(FEATURES), gradient)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def value_at(rows: DataFrame, column: str, rank: int, bins: int = 1024, few: int = 20_000) -> float:
    """The value that ``rank`` others precede in order, exactly: the bin it lies in is cut again until it holds few rows."""
    c, below = F.col(column), 0
    low, high, inside = rows.agg(F.min(c), F.max(c), F.count(c)).first()
    while low < high:
        here = rows.filter(c.between(low, high))
        if inside <= few:
            return sorted(r[0] for r in here.select(c).collect())[rank - below]
        at = F.least(F.floor((c - low) / (high - low) * bins), F.lit(bins - 1))
        for r in here.groupBy(at.alias("bin")).agg(F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("n")).orderBy("bin").collect():
            if below + r["n"] > rank:
                low, high, inside = r["low"], r["high"], r["n"]
                break
            below += r["n"]
    return low


def fit_slope(rows: DataFrame, threshold: float, ridge: float = 1.0, steps: int = 30) -> float:
    """Slope of a logistic regression of ``label`` on ``raw`` less the threshold, over all rows."""
    slope, z = 0.0, F.col("raw") - threshold
    for _ in range(steps):
        p = F.lit(1.0) / (1 + F.exp(-(z * slope)))
        gradient, hessian = rows.agg(F.sum((p - F.col("label")) * z), F.sum(p * (1 - p) * z * z)).first()
        step = (gradient + ridge * slope) / (hessian + ridge)
        slope -= step
        if abs(step) < 1e-6:
            break
    return float(np.clip(slope, 0.05, 20))


def learn_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> Ranking:
    """Fit on all labelled rows; with one class only, no preference at all."""
    examples = stored(labelled_examples(docs, known_labels(labels, "quality", modulus, held_out)), "quality_examples")
    pairs, totals = preference_pairs(examples)
    if pairs is None:
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 1.0)
    each = [F.col("x")[i] for i in range(FEATURES)]
    scale = np.array(examples.agg(*map(F.avg, each), *map(F.stddev_pop, each)).first(), float)
    center, spread = scale[:FEATURES], np.where(scale[FEATURES:] > 1e-9, scale[FEATURES:], 1.0)
    weights = fit_weights(stored(pairs, "quality_pairs"), spread)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = ((_matrix(batch.column(1)) - center) / spread) @ weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["label", "raw"])

    scores = stored(examples.select("label", "x").mapInArrow(raw, "label int, raw double"), "quality_scores")
    k = totals[0]  # the quantile that equals the share of bad rows
    threshold = (value_at(scores, "raw", k - 1) + value_at(scores, "raw", k)) / 2
    return Ranking(center, spread, weights, threshold, fit_slope(scores, threshold))


def quality_score(text: Column, model: Ranking) -> Column:
    """Score of a text, 0 to 1; a null text scores as an empty one."""
    parts = vars(model)

    def scored(column: pa.Array) -> pa.Array:
        own = Ranking(**parts)
        out = [own.score(features(words)) for words in word_chunks(column, NOT_SPACE)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(scored, "double")(text)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of every document.

    Null and empty texts get the score of a text without words. Repeated rows are scored each; an empty table
    gives no rows; without labels of both classes every score is 0.5. Other columns are not read.
    """
    model = learn_quality(docs, labels)
    return docs.select("doc_id", quality_score(F.col("text"), model).alias("score"))


def score_quantile(scored: DataFrame, share: float, bins: int = 10_000) -> float:
    """The score below which ``share`` of all rows lie, to 1 / ``bins``, by counts per bin."""
    counts = scored.groupBy(F.floor(F.col("score") * bins).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, seen = sum(r["n"] for r in counts), 0
    for r in sorted(counts, key=lambda r: r["bin"]):
        seen += r["n"]
        if seen >= share * total:
            return (r["bin"] + 1) / bins
    return 0.0


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``threshold``."""
    model = learn_quality(docs, labels)
    return docs.filter(quality_score(F.col("text"), model) >= threshold)
