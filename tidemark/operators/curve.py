"""A sort key that keeps rows near each other in several columns at once.

Each column is replaced by its rank among 256 quantiles, so that skewed and uneven values fill
the ranks evenly, and the bits of the ranks are interleaved. A contiguous range of the key then covers
a narrow range of every column, not of the first one alone. Quantiles come from one mergeable sketch
per column over all rows; at most 255 numbers per column reach the driver.

The key only places rows. Values whose ranks are equal stay apart by the columns that follow the key in a sort.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

RANK_BITS = 8
_LEAST = -1.7976931348623157e308


def ordered_number(column: Column, kind) -> Column:
    """A double that does not fall where the column rises; NULL stays NULL.

    Texts and binaries count by their first seven bytes, numbers beyond 53 bits by those; dates and timestamps
    by their number of days and microseconds.
    """
    if isinstance(kind, (StringType, BinaryType)):
        bytes_ = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(bytes_, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.unix_date(column.cast("date")).cast("double")
    if isinstance(kind, BooleanType):
        return column.cast("int").cast("double")
    if isinstance(kind, NumericType):
        return column.cast("double")
    raise ValueError(f"cannot cluster by a column of type {kind.simpleString()}")


def with_curve_key(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``rows`` with the key of ``columns``, at most seven, as the bigint column ``name``.

    NULL and NaN rank with the least values. Reads the rows once more, for the quantiles.
    """
    if not 0 < len(columns) <= 63 // RANK_BITS:
        raise ValueError(f"a key takes one to {63 // RANK_BITS} columns, not {len(columns)}")
    numbers = [ordered_number(F.col(c), rows.schema[c].dataType) for c in columns]
    numbers = [F.when(~F.isnan(n), n) for n in numbers]
    ranks = 1 << RANK_BITS
    points = [k / ranks for k in range(1, ranks)]
    found = rows.agg(*[F.percentile_approx(n, points).alias(str(i)) for i, n in enumerate(numbers)]).first()
    out, key = rows, F.lit(0).cast("bigint")
    for i, number in enumerate(numbers):
        # Values without finite bounds, such as infinities, fall into the outermost ranks.
        bounds = sorted({b for b in found[i] or [] if abs(b) != float("inf")})
        if not bounds:
            continue
        place, rank = f"{name}_n{i}", f"{name}_r{i}"
        out = out.withColumn(place, F.coalesce(number, F.lit(_LEAST)))
        splits = [-float("inf"), *bounds, float("inf")]
        out = Bucketizer(splits=splits, inputCol=place, outputCol=rank).transform(out).drop(place)
        # Ranks of a column with few distinct values are drawn apart, so that its high bits count, too.
        widened = F.floor(F.col(rank) * F.lit(ranks / len(splits))).cast("bigint")
        for bit in range(RANK_BITS):
            one = F.shiftright(widened, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
    return out.withColumn(name, key).select(*rows.columns, name)
