"""Signed rows: what a change adds to sums, and what it takes back.

A change feed says which rows came and which went. Given a sign each, sums of
them are what a change does to an aggregate, and joins of them follow the product rule

    change(F join D) = change(F) join D before  +  F after join change(D)

so an aggregate over joined tables can be kept up without reading either as a whole. A group
carries its number of rows, which says when it vanishes, and for every measure the number of values
that are not NULL, which says when its sum is NULL. Measures are whole numbers or decimals: these
can be taken back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changefeed import AFTER, CHANGE, INSERT

SIGN, ROWS = "__sign", "__rows"


def known(measure: str) -> str:
    """The column that counts a measure's values."""
    return f"__known_{measure}"


def signed(feed: DataFrame) -> DataFrame:
    """The rows of a feed with 1 for those that came and -1 for those that went."""
    sign = F.when(F.col(CHANGE).isin(INSERT, AFTER), 1).otherwise(-1)
    return feed.withColumn(SIGN, sign.cast("bigint")).drop(CHANGE)


def netted(rows: DataFrame) -> DataFrame:
    """Signed rows summed up; what came and went alike is left out."""
    columns = [c for c in rows.columns if c != SIGN]
    summed = rows.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN))
    return summed.filter(F.col(SIGN) != 0)


def grouped(rows: DataFrame, groups: dict[str, Column], measures: dict[str, Column], kinds: dict[str, str]) -> DataFrame:
    """Signed sums of signed rows by group; groups that nothing changes in are left out."""
    sign = F.col(SIGN)
    sums = [F.sum(sign).alias(ROWS)]
    for name, value in measures.items():
        sums.append(F.coalesce(F.sum(sign * value), F.lit(0)).cast(kinds[name]).alias(name))
        sums.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).alias(known(name)))
    return _changing(rows.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(*sums), list(measures))


def _parts(measures: list[str]) -> list[str]:
    return [ROWS, *[c for m in measures for c in (m, known(m))]]


def _changing(sums: DataFrame, measures: list[str]) -> DataFrame:
    some = F.lit(False)
    for column in _parts(measures):
        some = some | (F.col(column) != 0)
    return sums.filter(some)


def weighted(sums: DataFrame, measures: list[str]) -> DataFrame:
    """Sums that were joined to signed rows, with the sign taken into them."""
    return sums.withColumns({c: F.col(c) * F.col(SIGN) for c in _parts(measures)}).drop(SIGN)


def regrouped(sums: DataFrame, keys: list[str], measures: list[str], kinds: dict[str, str]) -> DataFrame:
    """Signed sums by fewer or other keys."""
    parts = [F.sum(c).cast(kinds.get(c, "bigint")).alias(c) for c in _parts(measures)]
    return _changing(sums.groupBy(*keys).agg(*parts), measures)


def added(stored: DataFrame, change: DataFrame, keys: list[str], measures: list[str], kinds: dict[str, str]) -> DataFrame:
    """The groups that ``change`` touches, as they are with it; NULL equals NULL in keys."""
    columns = [*keys, *_parts(measures)]
    both = stored.select(*columns, F.lit(False).alias("__new")).unionByName(
        change.select(*columns, F.lit(True).alias("__new"))
    )
    parts = [F.sum(c).cast(kinds.get(c, "bigint")).alias(c) for c in _parts(measures)]
    summed = both.groupBy(*keys).agg(*parts, F.max("__new").alias("__new"))
    return summed.filter("__new").drop("__new")


def value_of(measure: str) -> Column:
    """A measure's sum as SQL has it: NULL where no value is known."""
    return F.when(F.col(known(measure)) > 0, F.col(measure))
