"""Neighbours and running totals in ordered groups, safe when a group is huge.

A window sorts each group in one task. That is right for ordinary groups, but a
group holding a large share of all rows would keep one task busy. Such groups
are found first by counting, cut into segments at quantiles of the ordering
column, and windowed per segment; what crosses a segment's edge is filled in
from one summary row per segment. The result is the same for any cut, so the
quantiles may be approximate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.settings import SkewLimits

SEGMENT = "__segment"
_GROUP = "__group"
_BOUNDS = "__bounds"
_COARSE = "__coarse"
_EVERY = 64


def _group_id(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("bigint")


def heavy_groups(
    sized: DataFrame, group: str, limits: SkewLimits, buckets: int = 65_536
) -> tuple[int, list] | None:
    """The row limit, and the values of ``group`` with more rows than it, with their rows.

    None when there are none. One pass counts rows by hash bucket, a table of bounded
    size that tasks sum up before it is sent. A heavy group makes its bucket heavy, so only the
    groups of heavy buckets, of which there can be few, are then counted one by one.
    """
    bucket = F.pmod(F.xxhash64(group), F.lit(buckets))
    counts = sized.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows")).collect()
    total = sum(row["__rows"] for row in counts)
    if total <= limits.rows:
        return None
    threshold = limits.threshold(total)
    heavy = [(row["__bucket"],) for row in counts if row["__rows"] > threshold]
    if not heavy:
        return None
    near = sized.sparkSession.createDataFrame(heavy, "__bucket bigint")
    found = (
        sized.withColumn("__bucket", bucket)
        .join(F.broadcast(near), "__bucket", "left_semi")
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > threshold)
        .collect()
    )
    return (threshold, found) if found else None


def find_hot_groups(
    df: DataFrame, keys: list[str], order: str, limits: SkewLimits
) -> DataFrame | None:
    """The groups too big for one task, with the bounds that cut them.

    None when there are none. At most ``limits.groups`` rows reach the driver, each with fewer bounds than
    that; the returned table holds those rows as constants, so that every use of
    it in a plan cuts alike.
    """
    sized = df.select(_group_id(keys).alias(_GROUP), F.col(order).alias("__order"))
    heavy = heavy_groups(sized, _GROUP, limits)
    if heavy is None:
        return None
    threshold, hot = heavy
    pieces = [[row[_GROUP], -(-row["__rows"] // threshold)] for row in hot]
    most = max(n for _, n in pieces)
    spark = df.sparkSession
    cuts = spark.createDataFrame(
        [(group, max(1, most // n)) for group, n in pieces], f"{_GROUP} bigint, __stride int"
    )
    bounds = (
        sized.join(F.broadcast(cuts), _GROUP)
        .groupBy(_GROUP)
        .agg(
            F.percentile_approx(
                "__order", [i / most for i in range(1, most)] or [0.5], max(10_000, 10 * most)
            ).alias("q"),
            F.first("__stride").alias("__stride"),
        )
        .select(
            _GROUP,
            F.array_distinct(
                F.filter("q", lambda _, i: (i + 1) % F.col("__stride") == 0)
            ).alias(_BOUNDS),
        )
        .withColumn(_COARSE, F.filter(_BOUNDS, lambda _, i: (i + 1) % _EVERY == 0))
    )
    return spark.createDataFrame(bounds.collect(), bounds.schema)


def _segment(order: str) -> Column:
    """How many bounds a row is at or past: by every 64th, then those in between."""
    here = F.col(order)
    coarse = F.size(F.filter(_COARSE, lambda b: b <= here)) * _EVERY
    between = F.slice(F.col(_BOUNDS), coarse + 1, F.lit(_EVERY - 1))
    return coarse + F.size(F.filter(between, lambda b: b <= here))


def _split_hot(
    df: DataFrame, keys: list[str], order: str, hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary groups, and those of hot groups with their segment."""
    marked = df.withColumn(_GROUP, _group_id(keys))
    cold = marked.join(F.broadcast(hot), _GROUP, "left_anti").drop(_GROUP)
    cut = marked.join(F.broadcast(hot), _GROUP).withColumn(SEGMENT, _segment(order))
    return cold, cut.drop(_GROUP, _BOUNDS, _COARSE)


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    wanted: dict[str, tuple[str, int]],
    limits: SkewLimits,
    measured_on: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add columns taken from the next (+1) or previous (-1) row of the group.

    ``wanted`` maps a new column to the source column and direction. ``order``
    starts with the column that decides; the rest break ties. ``measured_on`` is
    what to look for hot groups in, where some rows that ``df`` is made from are
    cheaper to count than ``df`` itself and at least as many per group.
    ``partitions`` fixes how many partitions the ordinary groups are hashed into.
    """
    measured = df if measured_on is None else measured_on
    hot = find_hot_groups(measured, keys, order[0], limits)
    if hot is None:
        return _neighbours(_hashed(df, keys, partitions), keys, order, wanted)

    cold, cut = _split_hot(df, keys, order[0], hot)
    by_segment = Window.partitionBy(*keys).orderBy(SEGMENT)
    edges = (
        cut.groupBy(*keys, SEGMENT)
        .agg(*[_edge(source, step, order).alias(name) for name, (source, step) in wanted.items()])
        .select(
            *keys,
            SEGMENT,
            *[
                (F.lead if step > 0 else F.lag)(name).over(by_segment).alias(f"__edge_{name}")
                for name, (_, step) in wanted.items()
            ],
        )
    )
    one = cut.withColumn("__one", F.lit(1))
    inner = _neighbours(
        one,
        [*keys, SEGMENT],
        order,
        {**wanted, "__after": ("__one", 1), "__before": ("__one", -1)},
    )
    filled = {
        name: F.when(
            F.col("__after" if step > 0 else "__before").isNull(), F.col(f"__edge_{name}")
        ).otherwise(F.col(name))
        for name, (_, step) in wanted.items()
    }
    # One row per segment of a hot group: a bounded side.
    joined = inner.join(F.broadcast(edges), [*keys, SEGMENT], "left").withColumns(filled)
    plain = _neighbours(_hashed(cold, keys, partitions), keys, order, wanted)
    return plain.unionByName(joined.select(*df.columns, *wanted))


def _hashed(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    return df.repartition(partitions, *keys) if partitions else df


def _neighbours(
    df: DataFrame, keys: list[str], order: list[str], wanted: dict[str, tuple[str, int]]
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns(
        {
            name: (F.lead if step > 0 else F.lag)(source).over(w)
            for name, (source, step) in wanted.items()
        }
    )


def _edge(source: str, step: int, order: list[str]) -> Column:
    """What a segment offers its neighbour: its first or its last row's value."""
    if source == order[0]:
        return F.min(source) if step > 0 else F.max(source)
    position = F.struct(*order)
    return F.min_by(source, position) if step > 0 else F.max_by(source, position)


def with_running_total(
    df: DataFrame,
    order: str,
    value: str,
    name: str,
    limits: SkewLimits,
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Add the running total of ``value`` over all rows in ``order``.

    The whole table is one group here. ``order`` must be unique.
    """
    hot = find_hot_groups(df if measured_on is None else measured_on, [], order, limits)
    if hot is None:
        # No more than limits.rows rows, so one task is enough.
        w = Window.partitionBy(F.lit(0)).orderBy(order)
        return df.withColumn(name, F.sum(value).over(w))
    _, rows = _split_hot(df, [], order, hot)
    w = Window.partitionBy(SEGMENT).orderBy(order)
    before = Window.partitionBy(F.lit(0)).orderBy(SEGMENT)
    # One row per segment, and segments are bounded.
    carried = (
        rows.groupBy(SEGMENT)
        .agg(F.sum(value).alias("__sum"))
        .select(SEGMENT, (F.sum("__sum").over(before) - F.col("__sum")).alias("__carried"))
    )
    return (
        rows.withColumn("__inner", F.sum(value).over(w))
        .join(F.broadcast(carried), SEGMENT)
        .withColumn(name, F.col("__inner") + F.col("__carried"))
        .select(*df.columns, name)
    )
