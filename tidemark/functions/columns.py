"""Column functions: exact money, order rules, row comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.sources.envelope import MONEY_TYPE

# Order states and the legal steps between them.
KNOWN_STATUSES = ("created", "confirmed", "preparing", "delivered", "cancelled")
STATUS_STEPS = (
    ("created", "confirmed"),
    ("confirmed", "preparing"),
    ("preparing", "delivered"),
    ("created", "cancelled"),
    ("confirmed", "cancelled"),
    ("preparing", "cancelled"),
)


def exact_money(text: Column) -> Column:
    """A decimal string as money, NULL if it is no number or too large."""
    return text.try_cast(MONEY_TYPE)


def line_total(quantity: Column, unit_price: Column) -> Column:
    return quantity * unit_price


def adjusted_price(price: Column, factor: Column | str) -> Column:
    """Price times an exact factor, rounded half-even to cents."""
    factor = F.lit(factor) if isinstance(factor, str) else factor
    return F.bround(price * factor.cast("decimal(10,6)"), 2).cast(MONEY_TYPE)


def legal_step(previous: Column, current: Column) -> Column:
    """Whether an order may go from one status to the other."""
    step = F.struct(previous.alias("a"), current.alias("b"))
    return step.isin(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in STATUS_STEPS])


def anomaly_kind(total: Column, status: Column) -> Column:
    """Label an order by its defects."""
    negative = total < 0
    unmapped = ~status.isin(*KNOWN_STATUSES)
    return (
        F.when(negative & unmapped, "negative_total+unknown_status")
        .when(negative, "negative_total")
        .when(unmapped, "unknown_status")
        .otherwise("none")
    )


def deactivation_breach(delta: Column, active_after: Column, floor: int) -> Column:
    """Whether a net deactivation left fewer active rows than the floor."""
    return (delta < 0) & (active_after < floor)

