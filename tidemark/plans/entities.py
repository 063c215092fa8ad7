"""What is captured and how each table is checked and kept."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from tidemark.functions.columns import KNOWN_STATUSES
from tidemark.operators.decode import CAST_ERRORS
from tidemark.sources import envelope


@dataclass(frozen=True)
class EntitySpec:
    """One captured table: keys, history type and rules.

    A row failing a drop rule is dropped, one failing a warn rule is counted,
    one failing a quarantine rule is set aside.
    """

    name: str
    row: StructType
    keys: list[str]
    scd_type: int
    drop_rules: dict[str, str] = field(default_factory=dict)
    warn_rules: dict[str, str] = field(default_factory=dict)
    quarantine_rules: dict[str, str] = field(default_factory=dict)
    sequence_by: str = "lsn"
    delete_when: str = "op = 'd'"
    except_columns: tuple[str, ...] = ("op", "lsn")


def _known_statuses() -> str:
    return ", ".join(f"'{s}'" for s in KNOWN_STATUSES)


# Keys, history types and named rules of the captured tables.
CUSTOMERS = EntitySpec(
    "customers",
    envelope.CUSTOMERS,
    ["customer_id"],
    scd_type=1,
    drop_rules={"valid_key": "customer_id IS NOT NULL"},
    warn_rules={"email_present": "email IS NOT NULL", "phone_present": "phone IS NOT NULL"},
)
RESTAURANTS = EntitySpec(
    "restaurants",
    envelope.RESTAURANTS,
    ["restaurant_id"],
    scd_type=2,
    drop_rules={"valid_key": "restaurant_id IS NOT NULL"},
    warn_rules={"name_present": "name IS NOT NULL"},
)
PRODUCTS = EntitySpec(
    "products",
    envelope.PRODUCTS,
    ["product_id"],
    scd_type=2,
    drop_rules={"valid_key": "product_id IS NOT NULL"},
    warn_rules={"positive_price": "price > 0", "name_present": "name IS NOT NULL"},
)
ORDER_ITEMS = EntitySpec(
    "order_items",
    envelope.ORDER_ITEMS,
    ["order_item_id"],
    scd_type=2,
    drop_rules={"valid_key": "order_item_id IS NOT NULL"},
    warn_rules={"positive_qty": "quantity > 0"},
)
ORDERS = EntitySpec(
    "orders",
    envelope.ORDERS,
    ["order_id"],
    scd_type=2,
    warn_rules={"known_status": f"status IN ({_known_statuses()})"},
    quarantine_rules={
        "valid_key": "order_id IS NOT NULL",
        "non_negative_amount": "total_amount >= 0",
    },
)
ENTITIES = (CUSTOMERS, RESTAURANTS, PRODUCTS, ORDER_ITEMS, ORDERS)

# Where a record's amounts could not be read, this fails beside the rules above.
READABLE_AMOUNTS = {"readable_amounts": f"cardinality({CAST_ERRORS}) = 0"}
