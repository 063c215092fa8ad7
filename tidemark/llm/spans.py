"""Where a pattern matches in a text, in DataFrame functions.

Spark has no function for positions of matches. Matches are therefore put between marks, a
character that means nothing and that the text is cleared of first; splitting at the
marks leaves gaps and matches in turn, and running sums of their lengths are the positions, in
code points. The sums are built in stretches, so that their cost stays near linear in the matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "﷐"  # a code point that is no character
STRETCH = 256
SPAN = "struct<start:int,end:int,text:string>"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def no_spans(kind: str = SPAN) -> Column:
    return F.array().cast(f"array<{kind}>")


def markable(text: Column) -> Column:
    """The text, null as empty, with every mark in it replaced by another character of no class."""
    own = F.coalesce(text, F.lit(""))
    return F.when(F.contains(own, F.lit(MARK)), F.translate(own, MARK, "�")).otherwise(own)


def _running(total: Column, values: Column) -> Column:
    """The sums before each value and after the last, beginning at ``total``."""
    return F.aggregate(values, F.array(total), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def sums_before(values: Column) -> Column:
    """For each int of a non-empty array the sum of those before it."""
    def whole(v: Column) -> Column:
        stretches = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRETCH).cast("int"))
        part = lambda c: F.slice(v, c * STRETCH + 1, STRETCH)
        totals = F.transform(stretches, lambda c: F.aggregate(part(c), F.lit(0), lambda a, x: a + x))
        return bind(
            _running(F.lit(0), totals),
            lambda t: F.flatten(F.transform(
                stretches,
                lambda c: F.slice(_running(F.get(t, c), part(c)), 1, F.size(part(c))),
            )),
        )

    return bind(values, whole)


def spans_of(text: Column, pattern: str) -> Column:
    """start, end and text of every match, leftmost first and not overlapping; ``text`` is markable."""
    def cut(parts: Column) -> Column:
        lengths = F.transform(parts, lambda x: F.length(x))
        return bind(sums_before(lengths), lambda at: F.transform(
            F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)),
            lambda i: F.struct(
                F.get(at, i).alias("start"), F.get(at, i + 1).alias("end"), F.get(parts, i).alias("text")
            ),
        ))

    def found(marked: Column) -> Column:
        return F.when(F.contains(marked, F.lit(MARK)), bind(F.split(marked, MARK), cut)).otherwise(no_spans())

    return bind(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), found)


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (rank, start, end, kind), the form that digests are made of."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


LABELLED = "struct<rank:int,start:int,end:int,kind:string>"


def listed(spans: Column, by_start: bool) -> Column:
    """kind:start:end of labelled spans, comma-joined, by start and rank or by rank and start."""
    if by_start:
        spans = F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")
