"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One step of the alternation: hang each node's neighbours on the least of them.

    The large step moves a node's larger neighbours, the small step its smaller ones
    and itself. A node with very many neighbours is a group with a partial minimum and then one side
    of a plain join, which Spark splits when it is skewed.
    """
    near = edges if small else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        near = near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    moved = near.join(least, "a")
    if small:
        out = moved.select(F.col("low").alias("a"), "b").union(moved.select(F.col("low").alias("a"), F.col("a").alias("b")))
    else:
        out = moved.filter("b > a").select(F.col("low").alias("a"), "b")
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the least node it can reach.

    Large and small star steps alternate until the stars no longer change, which takes
    a number of rounds that grows with the logarithm of the longest chain. Every round is written
    to the shared folder. Loops and repeated links do no harm; no links give no rows.
    """
    def summary(df: DataFrame) -> tuple:
        found = df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return tuple(found)

    edges = edges.filter("a is not null and b is not null and a <> b")
    stars = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    before = None
    while (now := summary(stars)) != before:
        before = now
        stars = stored(_stars(_stars(stars, small=False), small=True), "stars")
    return stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
