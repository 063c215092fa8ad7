"""Envelope records to flat, typed change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import exact_money
from tidemark.sources.envelope import MONEY_COLUMNS, envelope_schema

LOG_POSITION = ["_partition", "_offset"]
CAST_ERRORS = "_cast_errors"
RAW_TEXT = "_raw"


def decode_changes(
    raw: DataFrame,
    row: StructType,
    keys: list[str],
    *,
    money: frozenset[str] = MONEY_COLUMNS,
    position: bool = False,
    diagnostics: bool = False,
) -> DataFrame:
    """Flatten envelopes to ``op, lsn``, the keys, then the other columns.

    Keys come from the row image after the change, or from the one before it for
    deletes. Unreadable records become rows of NULLs. Amounts that are no exact
    decimal become NULL instead of failing the job. ``position`` keeps the log
    position to break ties; ``diagnostics`` keeps the text and the names of the
    columns whose cast failed.
    """
    text = F.col("value").cast("string")
    carried = [F.col("partition").alias("_partition"), F.col("offset").alias("_offset")]
    # The explode of one element keeps later filters from moving below the parsing, where each
    # mention of a column would parse the text again.
    parsed = raw.select(
        F.explode(F.array(F.from_json(text, envelope_schema(row)))).alias("e"),
        *(carried if position else []),
        *([text.alias(RAW_TEXT)] if diagnostics else []),
    )
    after = "e.payload.after."
    exact = [f.name for f in row.fields if f.name in money]

    def value(name: str) -> Column:
        field = F.col(after + name)
        return (exact_money(field) if name in exact else field).alias(name)

    extra: list = list(LOG_POSITION) if position else []
    if diagnostics:
        failed = F.array(
            *[
                F.when(F.col(after + c).isNotNull() & exact_money(F.col(after + c)).isNull(), c)
                for c in exact
            ]
        )
        errors = F.array_compact(failed) if exact else F.array().cast("array<string>")
        extra += [errors.alias(CAST_ERRORS), F.col(RAW_TEXT)]
    return parsed.select(
        F.col("e.payload.op").alias("op"),
        F.col("e.payload.source.lsn").alias("lsn"),
        *[
            F.coalesce(F.col(after + k), F.col("e.payload.before." + k)).alias(k)
            for k in keys
        ],
        *[value(f.name) for f in row.fields if f.name not in keys],
        *extra,
    )
