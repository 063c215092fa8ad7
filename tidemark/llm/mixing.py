"""Mixing sources by temperature, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power of an exponent, normalised.
The exponent is searched for by repeated bisection: the largest at which the weights
still have the target entropy, raised as far as needed to keep every source's repetition within
its limit. A source's quota of the token budget is then made up of whole epochs and a rest.
Documents lie in 4,096 blocks by hash; each epoch is a permutation of them, and the rest
is the longest run of blocks, and then of documents of the next block, that the quota has room for.

Whether a document belongs to the rest follows from its own keys and one row per source,
so texts are neither shuffled nor sorted. Sums within a source run over its blocks
and over the documents of one block, never over all its documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import join_groups, stored

WAYS = 16  # stretches that one round of the search cuts the interval into
ROUNDS = 8


@dataclass(frozen=True)
class Target:
    """What the weights must meet.

    ``entropy`` is a share of the logarithm of the number of sources or, if ``relative``, of the way there from
    the entropy that the sources have; ``repeats`` how often a document may be drawn at most; ``budget`` the
    tokens to draw, or None for the fewest that draw every document once or more. ``passes`` states the budget as
    a multiple of the tokens there are.
    """

    entropy: float = 0.95
    repeats: float = 4.0
    budget: int | None = None
    relative: bool = False
    passes: float | None = None


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column) -> Column:
    """A key for shuffling: MD5 of the id's text and the text's length."""
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(as_text(doc_id), F.lit(":"), as_text(F.length(text))).cast("binary"))


def block_of(key: Column) -> Column:
    return F.substring(key, 1, 3)


def permutation_key(source: Column, epoch: Column, block: Column) -> Column:
    """Blocks of an epoch come in the order of this key."""
    name = F.coalesce(source.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", name, epoch.cast("string"), block).cast("binary"))


def _search(evaluate: Callable[[list[float]], list[bool]], low: float, high: float) -> tuple[float, float]:
    """Where a condition that holds at ``low`` stops holding, to the precision of the rounds."""
    for _ in range(ROUNDS):
        points = [low + (high - low) * k / WAYS for k in range(1, WAYS)]
        last = sum(evaluate(points))  # monotone: it holds at the first so many
        low, high = ([low, *points][last], [*points, high][last])
    return low, high


def fit_exponent(shares: DataFrame, total: int, target: Target) -> tuple[float, float]:
    """The exponent, and the sum of the powers; ``shares`` has tokens per source, all above 0.

    Each round is one aggregate over the sources, however many there are.
    """
    p = F.col("tokens") / F.lit(float(total))
    sources, least, most = shares.agg(F.count(F.lit(1)), F.min(p), F.max(p)).first()

    def sums(points: list[float]) -> list[tuple[float, float]]:
        power = [F.pow(p, F.lit(a)) for a in points]
        row = shares.agg(*[F.sum(x) for x in power], *[F.sum(x * F.log(p)) for x in power]).first()
        return [(row[k], row[len(points) + k]) for k in range(len(points))]

    def entropies(points: list[float]) -> list[float]:
        return [math.log(s) - a * t / s for a, (s, t) in zip(points, sums(points), strict=True)]

    own = entropies([1.0])[0]
    least_entropy = own + target.entropy * (math.log(sources) - own) if target.relative else target.entropy * math.log(sources)

    def diverse(points: list[float]) -> list[bool]:
        return [h >= least_entropy for h in entropies(points)]

    def repeating(points: list[float]) -> list[bool]:
        if target.budget is None:
            return [(most / least) ** (1 - a) > target.repeats for a in points]
        draws = target.budget / total
        return [draws * least ** (a - 1) / s > target.repeats for a, (s, _) in zip(points, sums(points), strict=True)]

    exponent = 1.0 if own >= least_entropy else _search(diverse, 0.0, 1.0)[0]
    if repeating([exponent])[0]:
        exponent = _search(repeating, exponent, 1.0)[1]
    return exponent, sums([exponent])[0][0]


def source_plan(narrow: DataFrame, target: Target) -> DataFrame:
    """One row per source: tokens, weight, quota, epochs, and how far its last epoch goes.

    ``edge`` is the permutation key of the block in which the rest ends and ``cutoff`` the last order
    key taken from that block; blocks before it are taken whole. Sources without a token get
    one epoch.
    """
    by_source = narrow.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    by_source = stored(by_source, "sources")
    full = by_source.filter("tokens > 0")
    total = full.agg(F.sum("tokens")).first()[0]
    if total is None:
        exponent, powers, total = 1.0, 1.0, 1
    else:
        if target.passes is not None:
            target = replace(target, budget=int(total * target.passes))
        exponent, powers = fit_exponent(full, total, target)
    p = F.col("tokens") / F.lit(float(total))
    weight = F.when(F.col("tokens") > 0, F.pow(p, F.lit(exponent)) / F.lit(powers)).otherwise(0.0)
    if target.budget is None:
        largest = full.agg(F.max("tokens")).first()[0] or 1
        budget = total * powers * (largest / total) ** (1 - exponent)
    else:
        budget = float(target.budget)
    quota = F.floor(F.col("weight") * F.lit(budget) + F.lit(0.5)).cast("long")
    if target.budget is None:
        quota = F.greatest(quota, F.col("tokens"))
    plan = by_source.withColumn("weight", weight).withColumn("quota", quota)
    plan = plan.withColumn("epochs", F.expr("if(tokens > 0, quota div tokens, 1)").cast("int"))
    plan = stored(plan.withColumn("rest", F.expr("if(tokens > 0, quota % tokens, 0)")), "quotas")

    blocks = narrow.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    known = join_groups(blocks, plan.select("source", "epochs", "rest"), ["source"], F.col("block"))
    turn = known.withColumn("turn", permutation_key(F.col("source"), F.col("epochs"), F.col("block")))
    upto = Window.partitionBy("source").orderBy("turn")
    turn = turn.withColumn("upto", F.sum("in_block").over(upto))
    first = F.min(F.struct("turn", "block", (F.col("upto") - F.col("in_block")).alias("before")))
    edges = stored(
        turn.filter("upto > rest").groupBy("source").agg(first.alias("at"))
        .select("source", F.col("at.turn").alias("edge"), F.col("at.block").alias("edge_block"), F.col("at.before").alias("before")),
        "edges",
    )
    plan = join_groups(plan, edges, ["source"], F.lit(0))
    room = plan.select("source", "edge_block", (F.col("rest") - F.col("before")).alias("room"))
    inside = join_groups(narrow, room, ["source"], F.col("order_key")).filter(F.col("block") == F.col("edge_block"))
    # Rows with the same key are taken together or not at all.
    running = Window.partitionBy("source").orderBy("order_key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = inside.withColumn("upto", F.sum("n_tokens").over(running)).filter("upto <= room")
    cutoffs = stored(taken.groupBy("source").agg(F.max("order_key").alias("cutoff")), "cutoffs")
    return join_groups(plan, cutoffs, ["source"], F.lit(0)).drop("before", "edge_block")


def drawn(docs: DataFrame, target: Target, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Every draw of every document: all columns of ``docs`` and, as ``__draw``, a struct.

    The struct has source, n_tokens, weight, epoch (from 0), block and place, the sort key that puts the draws
    of a source's epoch in their permuted order. Null sources are a source of their own. Null and
    empty texts have no tokens: they belong to the epochs of their source and cost nothing. Repeated rows
    are drawn each. An empty table gives no draws.
    """
    key = order_key(F.col(id_column), F.col(text_column))
    narrow = docs.select(
        F.col(source_column).alias("source"), token_count(F.col(text_column)).alias("n_tokens"),
        key.alias("order_key"), block_of(key).alias("block"),
    )
    narrow = stored(narrow, "tokens")
    plan = source_plan(narrow, target).select(
        "source", F.struct("tokens", "weight", "epochs", "edge", "cutoff").alias("__plan")
    )
    plan = stored(plan, "plan").withColumnRenamed("source", "__source")
    rows = docs.withColumns({"__source": F.col(source_column), "__order": key, "__block": block_of(key)})
    planned = join_groups(rows, plan, ["__source"], F.col("__order"))
    turn = permutation_key(F.col("__source"), F.col("__plan.epochs"), F.col("__block"))
    edge = F.col("__plan.edge")
    extra = (turn < edge) | ((turn == edge) & (F.col("__order") <= F.coalesce(F.col("__plan.cutoff"), F.lit(""))))
    copies = F.col("__plan.epochs") + F.coalesce(extra, F.lit(False)).cast("int")
    epochs = F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))
    each = planned.withColumn("__epoch", F.explode(epochs))
    place = F.concat(permutation_key(F.col("__source"), F.col("__epoch"), F.col("__block")), F.col("__order"))
    draw = F.struct(
        F.col("__source").alias("source"), token_count(F.col(text_column)).alias("n_tokens"), F.col("__plan.weight").alias("weight"),
        F.col("__epoch").alias("epoch"), F.col("__block").alias("block"), place.alias("place"),
    )
    return each.select(*docs.columns, draw.alias("__draw"))


def mixed_documents(docs: DataFrame, target: Target) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn."""
    return drawn(docs, target).select(*docs.columns)


def mixture(docs: DataFrame, target: Target) -> DataFrame:
    """doc_id, source, n_tokens, weight, epoch, block and place of every draw."""
    return drawn(docs.select("doc_id", "text", "source"), target).select("doc_id", "__draw.*")
