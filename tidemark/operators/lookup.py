"""Joining facts to dimensions without trusting a dimension to stay small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import heavy_groups
from tidemark.settings import Settings, SkewLimits


BROADCAST_BYTES = 256_000_000
SALTS = 64


def fits_broadcast(df: DataFrame, rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and bytes of text; stops counting just beyond."""
    width = F.length(F.to_json(F.struct(*df.columns)))
    count, size = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return count <= rows and (size or 0) <= most_bytes


def hot_values(df: DataFrame, key: str, limits: SkewLimits) -> DataFrame | None:
    """Values of ``key`` too frequent for one join task; at most ``limits.groups``."""
    keyed = df.select(key).filter(F.col(key).isNotNull())
    heavy = heavy_groups(keyed, key, limits)
    if heavy is None:
        return None
    rows = [(row[key],) for row in heavy[1]]
    return df.sparkSession.createDataFrame(rows, keyed.schema)


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    how: str,
    settings: Settings,
    *,
    may_be_hot: bool = True,
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of facts to a dimension that is unique on its key.

    A dimension of checked size is broadcast. A larger one is shuffled. Rows with
    a NULL key never match and would pile up in one task, so they are set apart: ``left``
    passes them on with NULL columns, ``inner`` drops them. Rows of hot keys stay where
    they are and meet a broadcast of just their dimension rows, or, should those be too
    many, are spread over copies of them. ``how`` is ``inner`` or ``left``. With
    ``may_be_hot=False`` the caller states that the facts are already aggregated to the
    key. ``measured_on`` is where to look for hot keys, if the rows the facts come from
    are cheaper to count than the facts.
    """
    side = dimension.withColumnRenamed(dimension_key, "__dimension_key")
    on = F.col(fact_key) == F.col("__dimension_key")

    def joined(part: DataFrame, dims: DataFrame) -> DataFrame:
        return part.join(dims, on, how).drop("__dimension_key")

    if fits_broadcast(dimension, settings.broadcast_rows):
        return joined(facts, F.broadcast(side))
    keyed = facts.filter(F.col(fact_key).isNotNull())
    measured = facts if measured_on is None else measured_on
    hot = hot_values(measured, fact_key, settings.skew) if may_be_hot else None
    if hot is None:
        out = joined(keyed, side)
    else:
        hot = hot.withColumnRenamed(fact_key, "__hot")
        is_hot = F.col(fact_key) == F.col("__hot")
        ordinary = keyed.join(F.broadcast(hot), is_hot, "left_anti")
        apart = keyed.join(F.broadcast(hot), is_hot, "left_semi")
        hot_side = side.join(
            F.broadcast(hot), F.col("__dimension_key") == F.col("__hot"), "left_semi"
        )
        if fits_broadcast(hot_side, settings.broadcast_rows):
            met = joined(apart, F.broadcast(hot_side))
        else:
            salted = apart.withColumn("__salt", F.pmod(F.xxhash64(*apart.columns), F.lit(SALTS)))
            copies = hot_side.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            spread = on & (F.col("__salt") == F.col("__copy"))
            met = salted.join(copies, spread, how).drop("__dimension_key", "__salt", "__copy")
        out = joined(ordinary, side).unionByName(met)
    if how == "left":
        kinds = {f.name: f.dataType for f in side.schema.fields if f.name != "__dimension_key"}
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
        out = out.unionByName(facts.filter(F.col(fact_key).isNull()).select("*", *empty))
    return out
