"""Row-level differences between two versions of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cdc import apply_changes

CHANGE = "_change_type"
INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Inserted, deleted and updated rows, an update as its row before and after.

    Both sides are unique on the keys, in which NULL equals NULL. Rows equal in
    every column, NULLs included, are left out.
    """
    columns = after.columns
    row = F.struct(*columns)
    old = before.select(*[F.col(k).alias(f"__old_{k}") for k in keys], row.alias("__old"))
    new = after.select(*[F.col(k).alias(f"__new_{k}") for k in keys], row.alias("__new"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}"))

    def change(kind: str, image: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(image).alias("row"))

    steps = (
        F.when(F.col("__old").isNull(), F.array(change(INSERT, "__new")))
        .when(F.col("__new").isNull(), F.array(change(DELETE, "__old")))
        .otherwise(F.array(change(BEFORE, "__old"), change(AFTER, "__new")))
    )
    return (
        old.join(new, same, "full_outer")
        .filter(~F.col("__old").eqNullSafe(F.col("__new")))
        .select(F.explode(steps).alias("c"))
        .select(F.col("c.kind").alias(CHANGE), *[F.col(f"c.row.`{c}`").alias(c) for c in columns])
    )


def feed_as_changes(feed: DataFrame, version: int) -> DataFrame:
    """A feed as change rows sequenced by the version they lead to."""
    return feed.filter(F.col(CHANGE) != BEFORE).withColumn(
        "__version", F.lit(version).cast("bigint")
    )


FEED_ARGUMENTS = {
    "sequence_by": "__version",
    "delete_when": f"{CHANGE} = '{DELETE}'",
    "except_columns": [CHANGE, "__version"],
    "scd_type": 1,
}


def apply_feed(
    target: DataFrame | None, feed: DataFrame, keys: list[str], version: int
) -> DataFrame:
    """Upsert and delete by key; returns the next state of the target."""
    return apply_changes(target, feed_as_changes(feed, version), keys=keys, **FEED_ARGUMENTS)


def stage_feed_jdbc(feed: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Write a feed to a staging table of a database.

    The statement that merges it into the served table belongs to that database.
    """
    feed.write.jdbc(url, table, mode="overwrite", properties=properties)
