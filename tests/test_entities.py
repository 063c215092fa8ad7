"""One envelope record of each captured table, decoded to typed columns."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.decode import CAST_ERRORS, decode_changes
from tidemark.operators.lookup import join_dimension
from tidemark.plans.entities import ENTITIES
from tidemark.settings import Settings, SkewLimits
from tidemark.streaming.flows import route_changes

# What a record of each table carries, and its typed form.
RECORDS = {
    "customers": (
        {"customer_id": 1, "full_name": "A B", "email": None, "phone": "7", "city": "X"},
        {"customer_id": 1, "full_name": "A B", "email": None, "phone": "7", "city": "X"},
    ),
    "restaurants": (
        {"restaurant_id": 2, "name": "R", "city": "X", "is_active": True, "unknown": 5},
        {"restaurant_id": 2, "name": "R", "city": "X", "is_active": True},
    ),
    "products": (
        {"product_id": 3, "restaurant_id": 2, "name": "P", "price": "12.30"},
        {"product_id": 3, "restaurant_id": 2, "name": "P", "price": Decimal("12.30")},
    ),
    "order_items": (
        {"order_item_id": 4, "order_id": 5, "product_id": 3, "quantity": 2, "unit_price": "0.10"},
        {"order_item_id": 4, "order_id": 5, "product_id": 3, "quantity": 2, "unit_price": Decimal("0.10")},
    ),
    "orders": (
        {"order_id": 5, "customer_id": 1, "restaurant_id": 2, "status": "created", "total_amount": "-1.5",
         "created_at": "2026-01-02T03:04:05Z"},
        {"order_id": 5, "customer_id": 1, "restaurant_id": 2, "status": "created", "total_amount": Decimal("-1.50"),
         "created_at": "2026-01-02T03:04:05Z"},
    ),
}
SPECS = {spec.name: spec for spec in ENTITIES}


def raw(spark, spec, after, op="u", lsn=9):
    image = {"after": after, "before": None, "op": op, "source": {"lsn": lsn}}
    if op == "d":
        image |= {"after": None, "before": {k: after[k] for k in spec.keys}}
    value = json.dumps({"payload": image})
    rows = [(b"k", value.encode(), spec.name, 0, 1, None, 0)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint, "
                                 "timestamp timestamp, timestampType int")


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_record_is_typed(spark, name):
    spec, (wire, typed) = SPECS[name], RECORDS[name]
    row = decode_changes(raw(spark, spec, wire), spec.row, spec.keys).first().asDict()
    assert {k: row[k] for k in typed} == typed and (row["op"], row["lsn"]) == ("u", 9)


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_delete_carries_its_key(spark, name):
    spec, (wire, typed) = SPECS[name], RECORDS[name]
    row = decode_changes(raw(spark, spec, wire, "d"), spec.row, spec.keys).first().asDict()
    assert {k: row[k] for k in spec.keys} == {k: typed[k] for k in spec.keys}
    assert all(v is None for k, v in row.items() if k not in (*spec.keys, "op", "lsn"))


@pytest.mark.parametrize("name, amount", [("products", "price"), ("order_items", "unit_price"), ("orders", "total_amount")])
def test_unreadable_amounts_are_set_aside(spark, name, amount):
    spec, (wire, _) = SPECS[name], RECORDS[name]
    records = raw(spark, spec, wire | {amount: "abc"})
    decoded = decode_changes(records, spec.row, spec.keys, position=True, diagnostics=True)
    row = route_changes(decoded, spec).first()
    assert row["_route" if "_route" in row else [c for c in row.asDict() if "route" in c][0]] == "quarantine"
    assert "readable_amounts" in row["reasons"] and row[CAST_ERRORS] == [amount]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows, hot_rows", [(10, 100), (10, 5)])
def test_null_and_hot_keys_do_not_pile_up(spark, how, rows, hot_rows):
    """The dimension is too large to broadcast, and so are, at times, the rows of hot keys."""
    facts = spark.range(20_000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 10 < 4 THEN id % 20 ELSE id % 997 END AS k"
    )
    dims = spark.range(500).selectExpr("id AS d", "id * 10 AS v")
    settings = Settings(broadcast_rows=hot_rows, skew=SkewLimits(rows=500, groups=1000))
    got = join_dimension(facts, dims, "k", "d", how, settings)
    plain = facts.join(dims, facts.k == dims.d, how).drop("d")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    if how == "left":
        spread = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert spread < 11_000
