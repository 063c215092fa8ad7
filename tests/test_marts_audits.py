"""Aggregates and audits: stated examples, hot keys, time zones."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import SF_DIR, rows_of

from tidemark.functions.columns import (
    KNOWN_STATUSES,
    adjusted_price,
    anomaly_kind,
    deactivation_breach,
    legal_step,
)
from tidemark.operators import audits
from tidemark.operators.cdc import END, START
from tidemark.operators.lookup import fits_broadcast, hot_values, join_dimension
from tidemark.plans import marts
from tidemark.settings import Settings, SkewLimits
from workload import queries

TIGHT = Settings(broadcast_rows=5, skew=SkewLimits(rows=50, groups=10))


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def money(text):
    return F.lit(text).cast("decimal(10,2)")


def items(spark, rows):
    return spark.createDataFrame(
        rows, "order_id bigint, quantity int, price string"
    ).select("order_id", "quantity", F.col("price").cast("decimal(10,2)").alias("unit_price"))


def test_order_totals(spark):
    orders = spark.createDataFrame(
        [(1, "25.50"), (2, "0.00"), (3, "0.30"), (4, "9.00")], "order_id bigint, t string"
    ).select("order_id", F.col("t").cast("decimal(10,2)").alias("total_amount"))
    lines = items(spark, [(1, 2, "10.00"), (1, 1, "5.50"), (3, 3, "0.10"), (4, 1, "8.00")])
    got = {r["order_id"]: r for r in audits.order_total_reconciliation(orders, lines).collect()}
    assert got[1]["items_total"] == Decimal("25.50") and got[1]["difference"] == 0
    assert got[2]["items_total"] == 0 and got[2]["missing_items"]
    assert got[3]["items_total"] == Decimal("0.30") and not got[3]["missing_items"]
    assert got[4]["difference"] == Decimal("1.00")


@pytest.mark.parametrize(
    "total, status, kind",
    [
        ("-50.00", "created", "negative_total"),
        ("50.00", "pending_sync", "unknown_status"),
        ("50.00", "created", "none"),
        ("-1.00", "unknown", "negative_total+unknown_status"),
    ],
)
def test_anomalies(spark, total, status, kind):
    assert value(spark, anomaly_kind(money(total), F.lit(status))) == kind


def test_status_steps(spark):
    legal = {
        (a, b)
        for a in KNOWN_STATUSES
        for b in KNOWN_STATUSES
        if value(spark, legal_step(F.lit(a), F.lit(b)))
    }
    assert legal == {
        ("created", "confirmed"), ("confirmed", "preparing"), ("preparing", "delivered"),
        ("created", "cancelled"), ("confirmed", "cancelled"), ("preparing", "cancelled"),
    }


def test_transition_audit_flags_illegal_steps(spark):
    rows = [(1, 1, "created"), (1, 2, "created"), (1, 3, "delivered"), (2, 1, "confirmed"),
            (2, 2, "cancelled"), (2, 3, "created")]
    versions = spark.createDataFrame(rows, f"order_id bigint, {START} bigint, status string")
    got = audits.status_transition_audit(versions)
    assert set(rows_of(got, ["order_id", START, "previous_status", "status", "legal"])) == {
        (1, 3, "created", "delivered", False),
        (2, 2, "confirmed", "cancelled", True),
        (2, 3, "cancelled", "created", False),
    }


@pytest.mark.parametrize(
    "price, factor, expected",
    [("10.00", "1.055", "10.55"), ("100.00", "0.9", "90.00"), ("10.00", "1.0005", "10.00"),
     ("10.00", "1.0015", "10.02")],
)
def test_adjusted_price(spark, price, factor, expected):
    assert value(spark, adjusted_price(money(price), factor)) == Decimal(expected)


def test_price_moves(spark):
    versions = spark.createDataFrame(
        [(1, 1, "10.00"), (1, 2, "11.00"), (1, 3, "9.89"), (1, 4, "9.89")],
        f"product_id bigint, {START} bigint, p string",
    ).select("product_id", START, F.col("p").cast("decimal(10,2)").alias("price"))
    got = audits.price_move_audit(versions)
    assert set(rows_of(got, [START, "excessive"])) == {(2, False), (3, True)}


@pytest.mark.parametrize(
    "active_before, delta, breach", [(2, 1, False), (2, -1, True), (3, -1, False)]
)
def test_active_floor(spark, active_before, delta, breach):
    after = F.lit(active_before + delta)
    assert value(spark, deactivation_breach(F.lit(delta), after, 2)) == breach


@pytest.mark.parametrize("limits", [SkewLimits(), SkewLimits(rows=4, groups=50)])
def test_active_floor_audit_counts_over_time(spark, limits):
    rows = []
    for i in range(30):
        rows.append((i, i, 100 + i if i % 2 else None, True))
        if i % 2:
            rows.append((i, 100 + i, 200 + i if i % 3 == 0 else None, False))
            if i % 3 == 0:
                rows.append((i, 200 + i, None, True))
    versions = spark.createDataFrame(
        rows, f"restaurant_id bigint, {START} bigint, {END} bigint, is_active boolean"
    )
    deltas = {}
    for _, start, end, active in rows:
        if active:
            deltas[start] = deltas.get(start, 0) + 1
            if end is not None:
                deltas[end] = deltas.get(end, 0) - 1
    count, expected = 0, set()
    for lsn in sorted(deltas):
        count += deltas[lsn]
        expected.add((lsn, count, deltas[lsn] < 0 and count < 20))
    got = audits.active_floor_audit(versions, 20, limits)
    assert set(rows_of(got, ["lsn", "active_count", "breach"])) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_a_hot_key_equals_a_plain_join(spark, how):
    """A third of the facts share a key, another part has none."""
    facts = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id") % 50)
        .cast("bigint")
        .alias("k"),
    )
    dimension = spark.range(40).select(F.col("id").alias("d"), (F.col("id") * 10).alias("x"))
    assert hot_values(facts, "k", TIGHT.skew).count() == 1
    assert not fits_broadcast(dimension, TIGHT.broadcast_rows)
    got = join_dimension(facts, dimension, "k", "d", how, TIGHT)
    plain = facts.join(dimension, F.col("k") == F.col("d"), how).drop("d")
    assert rows_of(got) == rows_of(plain)
    few = join_dimension(facts, dimension, "k", "d", how, Settings())
    assert rows_of(few) == rows_of(plain)


MARTS = ["daily_orders_by_restaurant", "revenue_by_city", "top_products", "order_enriched"]


@pytest.mark.parametrize("name", MARTS)
def test_marts_are_the_same_without_broadcast(spark, name, monkeypatch):
    expected = rows_of(queries.QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(queries, "SETTINGS", TIGHT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(queries.QUERIES[name](spark, SF_DIR)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_result_types(spark):
    daily = queries.daily_orders_by_restaurant(spark, SF_DIR)
    assert dict(daily.dtypes) == {
        "order_date": "date", "restaurant_id": "bigint", "restaurant_name": "string",
        "order_count": "bigint", "revenue": "decimal(20,2)",
    }
    top = dict(queries.top_products(spark, SF_DIR).dtypes)
    assert (top["total_quantity"], top["total_revenue"]) == ("bigint", "decimal(31,2)")


def test_days_are_the_written_ones_in_any_zone(spark):
    orders = spark.createDataFrame(
        [(1, 3, "2026-07-01T01:30:00.123456Z"), (2, 3, "2026-07-01T23:30:00Z")],
        "order_id bigint, restaurant_id bigint, created_at string",
    ).withColumn("total_amount", money("1.00"))
    places = spark.createDataFrame([(3, "p")], "restaurant_id bigint, name string")
    found = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            rows = marts.daily_orders_by_restaurant(orders, places).collect()
            found.append([(str(r["order_date"]), r["order_count"]) for r in rows])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [[("2026-07-01", 2)]] * 2


def test_a_dimension_with_two_rows_of_a_key_counts_twice(spark):
    """As in a join before grouping."""
    orders = spark.createDataFrame(
        [(1, 3, "2026-07-01"), (2, 3, "2026-07-01")],
        "order_id bigint, restaurant_id bigint, created_at string",
    ).withColumn("total_amount", money("1.00"))
    places = spark.createDataFrame([(3, "p", "c"), (3, "p", "c")], "restaurant_id bigint, name string, city string")
    daily = marts.daily_orders_by_restaurant(orders, places).collect()
    assert [(r["order_count"], r["revenue"]) for r in daily] == [(4, Decimal("4.00"))]
    city = marts.revenue_by_city(orders, places).collect()
    assert [(r["order_count"], r["revenue"]) for r in city] == [(4, Decimal("4.00"))]
