"""Aggregates over current versions, and the denormalised order table.

The aggregates group the facts by the join key before joining, so the join
handles one row per key whatever share of the facts a key has. A second grouping
on the dimension's columns keeps the result that of joining first.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import line_total
from tidemark.operators import cdc
from tidemark.operators.lookup import join_dimension
from tidemark.settings import Settings


def daily_orders_by_restaurant(
    orders: DataFrame, restaurants: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders and revenue per day and restaurant.

    ``created_at`` is text, so the day is the written one in any time zone; text
    that is no date counts under a NULL day.
    """
    per_day = orders.groupBy(
        F.col("created_at").try_cast("date").alias("order_date"), "restaurant_id"
    ).agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("amount"))
    names = restaurants.select(
        F.col("restaurant_id").alias("r_id"), F.col("name").alias("restaurant_name")
    )
    return (
        # A restaurant has a row per day at most.
        join_dimension(
            per_day, names, "restaurant_id", "r_id", "inner", settings, may_be_hot=False
        )
        .groupBy("order_date", "restaurant_id", "restaurant_name")
        .agg(
            F.sum("n").alias("order_count"),
            F.sum("amount").cast("decimal(20,2)").alias("revenue"),
        )
    )


def revenue_by_city(
    orders: DataFrame, restaurants: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders and revenue per city of the restaurant."""
    per_restaurant = orders.groupBy("restaurant_id").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("amount")
    )
    cities = restaurants.select(F.col("restaurant_id").alias("r_id"), "city")
    return (
        join_dimension(
            per_restaurant, cities, "restaurant_id", "r_id", "inner", settings, may_be_hot=False
        )
        .groupBy("city")
        .agg(
            F.sum("n").alias("order_count"),
            F.sum("amount").cast("decimal(20,2)").alias("revenue"),
        )
    )


def top_products(
    order_items: DataFrame,
    products: DataFrame,
    restaurants: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Quantity and revenue per product, at the price each item was sold for.

    Unranked; sort the result to rank it.
    """
    per_product = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(line_total(F.col("quantity"), F.col("unit_price"))).alias("amount"),
    )
    named = join_dimension(
        per_product,
        products.select(
            F.col("product_id").alias("p_id"), F.col("name").alias("product_name"), "restaurant_id"
        ),
        "product_id",
        "p_id",
        "inner",
        settings,
        may_be_hot=False,
    )
    names = restaurants.select(
        F.col("restaurant_id").alias("r_id"), F.col("name").alias("restaurant_name")
    )
    return (
        join_dimension(
            named, names, "restaurant_id", "r_id", "inner", settings, measured_on=products
        )
        .groupBy("product_id", "product_name", "restaurant_id", "restaurant_name")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("amount").cast("decimal(31,2)").alias("total_revenue"),
        )
    )


def enrich_orders(
    events: DataFrame,
    customers: DataFrame,
    restaurants: DataFrame,
    settings: Settings = Settings(),
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Order events with customer and restaurant context, in serving columns.

    Events lacking a dimension row keep NULLs. Bookkeeping columns stay. Hot
    customers and restaurants are looked for in ``measured_on``, or the events.
    """
    measured = events if measured_on is None else measured_on
    with_customer = join_dimension(
        events,
        customers.select(
            F.col("customer_id").alias("c_id"),
            F.col("full_name").alias("customer_name"),
            F.col("phone").alias("customer_phone"),
            F.col("city").alias("customer_city"),
        ),
        "customer_id",
        "c_id",
        "left",
        settings,
        measured_on=measured,
    )
    with_both = join_dimension(
        with_customer,
        restaurants.select(
            F.col("restaurant_id").alias("r_id"),
            F.col("name").alias("restaurant_name"),
            F.col("city").alias("restaurant_city"),
        ),
        "restaurant_id",
        "r_id",
        "left",
        settings,
        measured_on=measured,
    )
    kept = [c for c in (cdc.START, cdc.DELETED, cdc.TIE) if c in events.columns]
    # The columns of the serving table.
    return with_both.select(
        "order_id",
        "status",
        "total_amount",
        F.col("created_at").alias("ordered_at"),
        "customer_id",
        "customer_name",
        "customer_phone",
        "customer_city",
        "restaurant_id",
        "restaurant_name",
        "restaurant_city",
        *kept,
    )


def order_enriched(
    prior: DataFrame | None,
    valid_orders: DataFrame,
    customers: DataFrame,
    restaurants: DataFrame,
    settings: Settings = Settings(),
    tie_by: list[str] | None = None,
) -> DataFrame:
    """Next state of the serving table: the latest valid event of each order.

    Dimensions are looked up as they are now, so only each order's last event
    needs the joins; earlier ones of the batch would be overwritten.
    """
    events = cdc.to_events(valid_orders, ["order_id"], "lsn", "op = 'd'", ["op", "lsn"], tie_by)
    served = enrich_orders(
        cdc.latest(events, ["order_id"]), customers, restaurants, settings, measured_on=events
    )
    return served if prior is None else cdc.merge_latest(prior, served, ["order_id"])


@dataclass(frozen=True)
class MartSpec:
    """A published aggregate: inputs by table name, layout, and key."""

    name: str
    comment: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    keys: list[str]
    cluster_by: list[str]


MARTS = (
    MartSpec(
        "daily_orders_by_restaurant",
        "Orders and revenue per day and restaurant",
        daily_orders_by_restaurant,
        ("orders", "restaurants"),
        ["order_date", "restaurant_id", "restaurant_name"],
        ["order_date", "restaurant_id"],
    ),
    MartSpec(
        "revenue_by_city",
        "Orders and revenue per restaurant city",
        revenue_by_city,
        ("orders", "restaurants"),
        ["city"],
        ["city"],
    ),
    MartSpec(
        "top_products",
        "Quantity and revenue per product with its restaurant",
        top_products,
        ("order_items", "products", "restaurants"),
        ["product_id"],
        ["restaurant_id"],
    ),
)
