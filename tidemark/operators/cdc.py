"""Applying change events by sequence number: current state and full history.

All functions are pure. A *state* is what a target keeps: visible columns plus

* ``__START_AT``  sequence number of the event the row came from,
* ``__END_AT``    (history only) sequence number of the next event of the key,
* ``__deleted``   the event was a delete; kept so that late events land right,
* ``__tie``       log position, when given, to order events of equal sequence.

:func:`visible` turns a state into what readers see.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.ordered import with_neighbours
from tidemark.settings import SkewLimits

START, END, DELETED, TIE = "__START_AT", "__END_AT", "__deleted", "__tie"
# Only while merging: the row was stored already, and where it ended.
STORED, OLD_END = "__stored", "__old_end"
_BOOKKEEPING = (START, END, DELETED, TIE, STORED, OLD_END)


def _column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def usable_changes(
    changes: DataFrame, keys: list[str], sequence_by: Column | str
) -> DataFrame:
    """Change rows that can be applied: every key and the sequence are present."""
    return changes.filter(_usable(keys, sequence_by))


def unusable_changes(
    changes: DataFrame, keys: list[str], sequence_by: Column | str
) -> DataFrame:
    """The rest of the change rows, for the rejects table."""
    return changes.filter(~_usable(keys, sequence_by))


def _usable(keys: list[str], sequence_by: Column | str) -> Column:
    usable = _column(sequence_by).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return usable


def to_events(
    changes: DataFrame,
    keys: list[str],
    sequence_by: Column | str,
    delete_when: Column | str,
    except_columns: list[str],
    tie_by: list[str] | None = None,
) -> DataFrame:
    """Change rows in the shape of a state, without ends."""
    deleted = _column(delete_when)
    dropped = {*except_columns, *(tie_by or [])} - set(keys)
    usable = usable_changes(changes, keys, sequence_by)
    return usable.select(
        *[c for c in changes.columns if c not in dropped],
        _column(sequence_by).alias(START),
        F.coalesce(deleted, F.lit(False)).alias(DELETED),
        *([F.struct(*tie_by).alias(TIE)] if tie_by else []),
    )


def _order(events: DataFrame, keys: list[str]) -> list[str]:
    """Sequence first, then the log position or else all other columns.

    Both are kept in the state, so every later merge breaks ties the same way. A row stored
    already follows its repetition.
    """
    stored = [STORED] if STORED in events.columns else []
    if TIE in events.columns:
        return [START, TIE, *stored]
    return [START, DELETED, *[c for c in events.columns if c not in (*keys, *_BOOKKEEPING)], *stored]


def latest(events: DataFrame, keys: list[str]) -> DataFrame:
    """The last event of each key.

    Ranking below a filter lets Spark keep one row per key before the shuffle, so
    a key with very many events sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in _order(events, keys)])
    return (
        events.withColumn("__rank", F.row_number().over(w))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


def history(
    events: DataFrame,
    keys: list[str],
    limits: SkewLimits,
    measured_on: DataFrame | None = None,
    partitions: int | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Every event with its end; of events with equal sequence the last one.

    One shuffle and one sort serve both: an event followed by one of the same
    sequence is superseded by it. ``previous`` names a column for the sequence of the event before,
    superseded or not.
    """
    wanted = {END: (START, 1)} | ({previous: (START, -1)} if previous else {})
    closed = with_neighbours(
        events, keys, _order(events, keys), wanted, limits, measured_on, partitions
    )
    return closed.filter(F.col(END).isNull() | (F.col(END) > F.col(START)))


def apply_changes(
    prior: DataFrame | None,
    changes: DataFrame,
    *,
    keys: list[str],
    sequence_by: Column | str,
    delete_when: Column | str,
    except_columns: list[str],
    scd_type: int,
    tie_by: list[str] | None = None,
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """The state after applying change rows to a prior state.

    Late, repeated and out-of-order events give the same state as all events
    applied at once in order. Rows of ``prior`` that the changes cannot affect
    pass through without a shuffle when the changes are small.
    """
    events = to_events(changes, keys, sequence_by, delete_when, except_columns, tie_by)
    if scd_type == 1:
        return merge_latest(prior, latest(events, keys), keys)
    if scd_type == 2:
        return merge_history(prior, events, keys, limits)
    raise ValueError(f"scd_type must be 1 or 2, not {scd_type}")


def merge_latest(
    prior: DataFrame | None,
    fresh: DataFrame,
    keys: list[str],
    partitions: int | None = None,
) -> DataFrame:
    """A state of last events with ``fresh``, one event per key, merged in.

    ``partitions`` fixes how many partitions the merged rows are hashed into.
    """
    if prior is None:
        return fresh.repartition(partitions, *keys) if partitions else fresh
    both = prior.select(*fresh.columns).unionByName(fresh)
    return latest(both.repartition(partitions, *keys) if partitions else both, keys)


def merge_history(
    prior: DataFrame | None,
    events: DataFrame,
    keys: list[str],
    limits: SkewLimits,
    partitions: int | None = None,
) -> DataFrame:
    """A history state with new events merged in; ``partitions`` as above."""
    if prior is None:
        return history(events, keys, limits, partitions=partitions)
    # Only rows reaching past the earliest new event of their key can change.
    touched = events.groupBy(*keys).agg(F.min(START).alias("__from"))
    marked = prior.join(touched, keys, "left")
    settled = F.col("__from").isNull() | F.coalesce(F.col(END) <= F.col("__from"), F.lit(False))
    reopened = marked.filter(~settled).select(*events.columns)
    inputs = prior.select(*keys, START).unionByName(events.select(*keys, START))
    rebuilt = history(
        reopened.unionByName(events), keys, limits, measured_on=inputs, partitions=partitions
    )
    return marked.filter(settled).select(*rebuilt.columns).unionByName(rebuilt)


def visible(state: DataFrame) -> DataFrame:
    """What readers see: no deletes; a history keeps its interval columns."""
    hidden = [DELETED, TIE] if END in state.columns else [START, DELETED, TIE]
    return state.filter(~F.col(DELETED)).drop(*hidden)


def current_versions(versions: DataFrame) -> DataFrame:
    """The open version of each key of a history."""
    return versions.filter(F.col(END).isNull())


def versions_as_of(versions: DataFrame, sequence: int) -> DataFrame:
    """The versions that were current once ``sequence`` was applied."""
    return versions.filter(
        (F.col(START) <= sequence) & (F.col(END).isNull() | (F.col(END) > sequence))
    )


def collapse_unchanged(
    versions: DataFrame, keys: list[str], tracked: list[str], limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Merge adjoining versions that agree on the tracked columns.

    For reading only; the stored history keeps every event. Other columns are
    those of the first merged version.
    """
    row = F.struct(*tracked)
    seen = with_neighbours(
        versions.withColumn("__row", row),
        keys,
        [START],
        {
            "__row_before": ("__row", -1),
            "__end_before": (END, -1),
            "__row_after": ("__row", 1),
            "__start_after": (START, 1),
        },
        limits,
    )
    edges = seen.select(
        *versions.columns,
        (
            F.col("__end_before").eqNullSafe(F.col(START))
            & F.col("__row_before").eqNullSafe(F.col("__row"))
        ).alias("__joins_before"),
        (
            F.col("__start_after").eqNullSafe(F.col(END))
            & F.col("__row_after").eqNullSafe(F.col("__row"))
        ).alias("__joins_after"),
    ).filter(~F.col("__joins_before") | ~F.col("__joins_after"))
    # What is left of a merged run is its first and its last version.
    paired = with_neighbours(
        edges, keys, [START], {"__run_end": (END, 1)}, limits, measured_on=versions
    )
    return (
        paired.filter(~F.col("__joins_before"))
        .withColumn(END, F.when(F.col("__joins_after"), F.col("__run_end")).otherwise(F.col(END)))
        .select(*versions.columns)
    )
