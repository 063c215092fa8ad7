"""What each filter of a chain removes, in every order the filters can have.

A document's outcome under every order depends only on which filters it fails, a mask
of one bit per filter. Documents are therefore counted once by part and mask. A recursive
query then walks all orders: from each prefix it goes on with every filter not used yet,
carries the bits applied so far and says, for each mask cell that occurs, whether documents
of that cell are kept, removed or already gone at that step. The walk has 325 prefixes
of at most 32 cells, whatever the data. Joined with the counts it gives every part's table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

FILTERS = "ABCDE"
COPY = "E"  # the one that looks at other documents
LETTERS = "array(" + ", ".join(f"named_struct('letter', '{f}', 'bit', {1 << k})" for k, f in enumerate(FILTERS)) + ")"

# The walk. A row is a prefix and a mask cell; the flags say what the prefix's last filter does to the cell.
WALK = """
WITH RECURSIVE walk(prefix, step, letter, applied, mask, kept, removed, redundant, alone) AS (
  SELECT CAST('' AS STRING), 0, CAST('' AS STRING), 0, mask, 1, 0, 0, 0 FROM {masks}
  UNION ALL
  SELECT concat(w.prefix, l.letter), w.step + 1, l.letter, w.applied | l.bit, m.mask,
         CAST(m.mask & (w.applied | l.bit) = 0 AS INT),
         CAST(m.mask & w.applied = 0 AND m.mask & l.bit <> 0 AS INT),
         CAST(m.mask & w.applied <> 0 AND m.mask & l.bit <> 0 AS INT),
         CAST(m.mask = l.bit AS INT)
  FROM walk w JOIN {masks} m ON m.mask = w.mask
  LATERAL VIEW explode(filter({letters}, l -> w.applied & l.bit = 0)) AS l
)
SELECT * FROM walk WHERE step > 0
"""


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at a text alone, as conditions to fail them; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 5,
        "D": F.regexp_like(text, F.lit("[#$%&*|]")),
    }


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones by part and mask: (part, mask, n, good, toxic).

    Texts are read once; what goes on is a digest and a mask for each. Copies are found by the least
    id of each digest, which is summed up before it is shuffled, and by joining that back on digest and id
    together, so a text that a third of all rows have is no hot key.
    """
    bit = {name: 1 << k for k, name in enumerate(FILTERS)}
    failed = text_failures(F.col("text"))
    rows = stored(
        docs.select(
            "doc_id",
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)).alias("digest"),
            reduce(Column.__add__, [F.when(c, bit[k]).otherwise(0) for k, c in failed.items()]).alias("mask"),
        ),
        "masks",
    )
    known = rows.filter("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copies = known.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("first").isNull(), bit[COPY]).otherwise(0)).alias("mask")
    )
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    # Rows without an id have no labels and are no copies; they stay out of the joins.
    unknown = rows.filter("doc_id is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    marked = copies.join(marks, "doc_id", "left").select("part", "mask", "good", "toxic").unionByName(unknown)
    return marked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what the step's filter does.

    ``part`` is a source, an empty string for null. ``kept`` documents remain after the step, ``removed`` go at it,
    ``redundant`` ones fail its filter but went before, ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are the removed ones
    labelled so, and ``shapley`` is what the filter removes summed over all orders.

    A null text is empty. A null id has no labels, is no copy and makes no copies; rows with the same id and text are
    not copies of each other. A document with several label rows is good or toxic if any of them says so. Other
    columns are not read. A part without failing documents has its rows with zeros; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cells = stored(failure_cells(docs, labels), "cells")
    walk = stored(spark.sql(WALK.replace("{letters}", LETTERS), masks=stored(cells.select("mask").distinct().coalesce(1), "mask-cells")), "walk")
    # The walk has 325 rows for each of at most 32 masks, the orders are 120 of 5 steps: bounded sides.
    weights = F.broadcast(walk.withColumnRenamed("mask", "__mask"))
    lost = F.col("n") * F.col("removed")
    prefixes = cells.join(weights, F.col("mask") == F.col("__mask")).groupBy("part", "prefix", "letter").agg(
        F.sum(F.col("n") * F.col("kept")).alias("kept"),
        F.sum(lost).alias("removed"),
        F.sum(F.col("n") * F.col("redundant")).alias("redundant"),
        F.sum(F.col("n") * F.col("alone")).alias("unique_fails"),
        F.sum(F.col("good") * F.col("removed")).alias("good_lost"),
        F.sum(F.col("toxic") * F.col("removed")).alias("toxic_lost"),
    )
    orders = walk.filter(F.col("step") == len(FILTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    steps = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))).withColumn(
        "prefix", F.expr("left(filter_order, step)")
    )
    table = prefixes.join(F.broadcast(steps), "prefix")
    # A prefix stands for all orders that begin with it.
    shares = table.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return table.join(shares, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
