"""Row payloads of the five captured tables and the envelope around them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

ID, TEXT, COUNT, FLAG = LongType(), StringType(), IntegerType(), BooleanType()


def _row(**columns: DataType) -> StructType:
    row = StructType()
    for name, kind in columns.items():
        row.add(name, kind)
    return row


# Column names and wire types of the captured tables. Exact
# numerics and timestamps travel as strings.
_STAMPS = {"created_at": TEXT, "updated_at": TEXT}
CUSTOMERS = _row(
    customer_id=ID, full_name=TEXT, email=TEXT, phone=TEXT, city=TEXT, **_STAMPS
)
RESTAURANTS = _row(
    restaurant_id=ID, name=TEXT, category=TEXT, city=TEXT, is_active=FLAG, **_STAMPS
)
PRODUCTS = _row(
    product_id=ID, restaurant_id=ID, name=TEXT, price=TEXT, is_available=FLAG, **_STAMPS
)
ORDERS = _row(
    order_id=ID, customer_id=ID, restaurant_id=ID, status=TEXT, total_amount=TEXT, **_STAMPS
)
ORDER_ITEMS = _row(
    order_item_id=ID, order_id=ID, product_id=ID, quantity=COUNT, unit_price=TEXT,
    created_at=TEXT,
)

# The money columns and their exact type.
MONEY_COLUMNS = frozenset({"price", "total_amount", "unit_price"})
MONEY_TYPE = "decimal(10,2)"


def envelope_schema(row: StructType) -> StructType:
    """Schema of one change event for rows of type ``row``.

    Declares only what is read later, so the JSON parser skips everything else.
    """
    payload = _row(after=row, before=row, op=TEXT, source=_row(lsn=ID))
    return _row(payload=payload)
