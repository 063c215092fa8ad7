"""Contiguous shards of nearly equal bytes, by global prefix sums.

Rows are put in one global order by a range shuffle. Each range partition's
totals (bytes and rows) are summed, their running sums over the partitions give
every partition its offset, and a running sum within each partition gives every
row its place in the whole. Cutting the bytes at equal targets makes shards that
are contiguous in that order. Nothing but the totals, one row per partition, is
ever looked at in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def with_offsets(ranked: DataFrame, part: str, size: str, order: list[str]) -> DataFrame:
    """Add ``__start`` (bytes before the row) and ``__index`` (rows before it).

    ``ranked`` has a partition number ``part`` that rises with ``order``.
    """
    totals = ranked.groupBy(part).agg(
        F.sum(size).alias("__bytes"), F.count(F.lit(1)).alias("__rows")
    )
    # One row per partition of the range shuffle: a few thousand, set by the settings.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        part,
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
    )
    inside = Window.partitionBy(part).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranked.withColumn("__upto", F.sum(size).over(upto))
        .withColumn("__number", F.row_number().over(inside))
        .join(offsets, part)
        .withColumn("__start", F.col("__bytes_before") + F.col("__upto") - F.col(size))
        .withColumn("__index", F.col("__rows_before") + F.col("__number") - 1)
        .drop("__bytes_before", "__rows_before", "__upto", "__number")
    )


def cut(start: Column, size: Column, total: Column | int, shards: int) -> Column:
    """The shard in which a row's middle byte lies, of ``shards`` equal stretches."""
    middle = F.expr("0L") + start * 2 + size
    place = (middle * shards / 2).cast("decimal(38,6)") / F.greatest(F.lit(1), F.lit(total))
    return F.least(F.floor(place), F.lit(shards - 1)).cast("int")


def balanced_shards(
    rows: DataFrame, size: str, order: list[str], shards: int, partitions: int | None = None
) -> DataFrame:
    """Give every row ``shard`` (0 to ``shards`` - 1) and ``slot`` (its place in the shard).

    ``rows`` holds the columns to keep, ``size`` (a non-null long) and the columns of
    ``order``, which should tell rows apart: rows alike in all of them are put in
    an arbitrary order of their own, which changes nothing else, and a huge run of them
    lies in one range partition. No rows give no rows. Shards differ from the target
    by at most one row's size. A shard whose stretch lies within one huge row is empty.
    """
    count = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, *order).withColumn("__part", F.spark_partition_id())
    ranked = stored(ranged, "ranges")  # the partition numbers must not change any more
    placed = with_offsets(ranked, "__part", size, order)
    total = ranked.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    cutted = placed.withColumn("shard", cut(F.col("__start"), F.col(size), int(total), shards))
    cutted = stored(cutted.drop("__part", "__start"), "cut")
    firsts = cutted.groupBy("shard").agg(F.min("__index").alias("__first"))
    # At most one row per shard.
    return (
        cutted.join(F.broadcast(firsts), "shard")
        .withColumn("slot", F.col("__index") - F.col("__first"))
        .drop("__index", "__first")
    )


def text_size(text: Column, overhead: int) -> Column:
    """UTF-8 bytes of a text (null: none) plus what each row costs besides."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    overhead: int = 16,
) -> DataFrame:
    """Id, size, checksum, shard and slot of every document.

    The order is by the text's MD5 and then by id, so it depends on the rows alone and
    equal texts lie side by side: a group of copies is in one shard, or in neighbouring
    ones where a cut passes through it, and a group larger than a shard is spread
    over several. A null text is as an empty one, with no bytes of its own, and sorts
    before all. Repeated ids are rows of their own; a null id sorts first in its group. Other columns
    are not read. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        text_size(F.col(text_column), overhead).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.when(F.col(text_column).isNotNull(), F.md5(body)).alias("__order"),
    )
    narrow = stored(rows, "sizes")  # texts are read once
    placed = balanced_shards(narrow, "size", ["__order", "doc_id"], shards)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")
