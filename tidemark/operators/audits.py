"""Business rules checked over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    anomaly_kind,
    deactivation_breach,
    legal_step,
    line_total,
)
from tidemark.operators.cdc import END, START
from tidemark.operators.ordered import with_neighbours, with_running_total
from tidemark.settings import SkewLimits


def order_total_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Each order's total against the sum of its items.

    Items are summed per order before the join, so both of its sides have one
    row per order. An order without items totals 0 and is marked.
    """
    sums = items.groupBy("order_id").agg(
        F.sum(line_total(F.col("quantity"), F.col("unit_price"))).alias("__sum")
    )
    total = F.coalesce("__sum", F.lit(0)).cast("decimal(31,2)")
    return orders.join(sums, "order_id", "left").select(
        "order_id",
        "total_amount",
        total.alias("items_total"),
        (F.col("total_amount") - total).cast("decimal(32,2)").alias("difference"),
        F.col("__sum").isNull().alias("missing_items"),
    )


def label_anomalies(orders: DataFrame) -> DataFrame:
    return orders.withColumn("anomaly", anomaly_kind(F.col("total_amount"), F.col("status")))


def anomaly_shares(orders: DataFrame) -> DataFrame:
    """Orders per day and kind of anomaly, with their share of the day."""
    kinds = ("negative_total", "unknown_status", "negative_total+unknown_status", "none")
    per_kind = [
        F.struct(F.lit(k).alias("anomaly"), F.count_if(F.col("anomaly") == k).alias("orders"))
        for k in kinds
    ]
    return (
        label_anomalies(orders)
        .groupBy(F.col("created_at").try_cast("date").alias("order_date"))
        .agg(F.array(*per_kind).alias("kinds"), F.count(F.lit(1)).alias("day_orders"))
        .select("order_date", "day_orders", F.explode("kinds").alias("k"))
        .filter("k.orders > 0")
        .select(
            "order_date",
            "k.anomaly",
            "k.orders",
            (F.col("k.orders") / F.col("day_orders")).alias("share"),
        )
    )


def status_transition_audit(
    versions: DataFrame,
    limits: SkewLimits = SkewLimits(),
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Every status change of an order and whether the lifecycle allows it.

    Where ``versions`` are not stored, ``measured_on`` takes the events they come
    from, which are cheaper to search for hot keys.
    """
    steps = with_neighbours(
        versions.select("order_id", START, "status"),
        ["order_id"],
        [START],
        {"previous_status": ("status", -1)},
        limits,
        measured_on,
    )
    return steps.filter(
        F.col("previous_status").isNotNull() & (F.col("previous_status") != F.col("status"))
    ).withColumn("legal", legal_step(F.col("previous_status"), F.col("status")))


def price_move_audit(
    versions: DataFrame,
    limits: SkewLimits = SkewLimits(),
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Every price change of a product; more than a tenth either way is flagged.

    Compares by multiplying out, so no division loses digits. ``measured_on`` as
    in :func:`status_transition_audit`.
    """
    moves = with_neighbours(
        versions.select("product_id", START, "price"),
        ["product_id"],
        [START],
        {"previous_price": ("price", -1)},
        limits,
        measured_on,
    )
    new, old = F.col("price") * 10, F.col("previous_price")
    return moves.filter(old.isNotNull() & (old != F.col("price"))).withColumn(
        "excessive", (new > old * 11) | (new < old * 9)
    )


def active_floor_audit(
    versions: DataFrame, floor: int, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Active restaurants after each change, flagging those that breach the floor.

    A version adds one when it starts and takes one away when it ends. These are
    summed per sequence number first; the running total over the rest is cut
    into ranges, so no task sees them all.
    """
    active = versions.filter("is_active").select(START, END)
    steps = (
        active.select(
            F.explode(
                F.array(
                    F.struct(F.col(START).alias("lsn"), F.lit(1).alias("step")),
                    F.struct(F.col(END).alias("lsn"), F.lit(-1).alias("step")),
                )
            ).alias("s")
        )
        .select("s.lsn", "s.step")
        .filter(F.col("lsn").isNotNull())
    )
    deltas = steps.groupBy("lsn").agg(F.sum("step").alias("delta")).filter(F.col("delta") != 0)
    return with_running_total(
        deltas, "lsn", "delta", "active_count", limits, measured_on=steps
    ).withColumn("breach", deactivation_breach(F.col("delta"), F.col("active_count"), floor))
