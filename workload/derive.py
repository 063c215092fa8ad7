"""The supplied tables as the ordering domain, and as logs of changes to it.

Each log spreads a table's rows into a few change events by rules on the key, so
it grows with the table. Explodes are over four or five steps per row and need
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = 1_000_000_000
ITEM_KEYS = ["order_id", "product_id", "line_supplier", "line_no", "line_date"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "supplier").count()


def _with_nation(rows: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return rows.join(nation, F.col(key) == nation.n_nationkey)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_nation(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey")
    key = F.col("c_custkey")
    return rows.select(
        key.alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.when(key % 11 != 0, key.cast("string")).alias("phone"),
        F.col("n_name").alias("city"),
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_nation(table(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey")
    return rows.select(
        F.col("s_suppkey").alias("restaurant_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") % supplier_count(spark, sf_dir)).alias("restaurant_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("line_supplier"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("line_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderkey") % supplier_count(spark, sf_dir)).alias("restaurant_id"),
        F.when(status == "O", 0).when(status == "P", 2).otherwise(3).alias("depth"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )


def _steps(rows: DataFrame, last: int, key: str, applies: Column) -> DataFrame:
    """Repeat each row for steps 0 to ``last`` and keep the applicable ones.

    Step ``last`` deletes; ``written`` blanks the data columns there.
    """
    k = F.col("k")
    return (
        rows.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(last + 1)])))
        .filter(applies)
        .withColumn("op", F.when(k == last, "d").when(k == 0, "c").otherwise("u"))
        .withColumn("lsn", k.cast("bigint") * STEP + F.col(key))
    )


def _written(last: int, value: Column | str) -> Column:
    return F.when(F.col("k") < last, F.col(value) if isinstance(value, str) else value)


def log_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four statuses, then a delete for every 17th; some carry anomalies."""
    k, key, total = F.col("k"), F.col("order_id"), F.col("total_amount")
    applies = ((k <= F.col("depth")) & ~((key % 40 == 3) & (k > 0))) | ((k == 4) & (key % 17 == 0))
    flipped = (key % 40 == 1) | ((key % 40 == 5) & (k == 1))
    status = (
        F.when(key % 40 == 3, "pending_sync")
        .when(k == 0, "created")
        .when(k == 1, "confirmed")
        .when(k == 2, "preparing")
        .otherwise("delivered")
    )
    return _steps(orders(spark, sf_dir), 4, "order_id", applies).select(
        "op",
        "lsn",
        "order_id",
        _written(4, "customer_id").alias("customer_id"),
        _written(4, "restaurant_id").alias("restaurant_id"),
        _written(4, status).alias("status"),
        _written(4, F.when(flipped, -total).otherwise(total))
        .cast("decimal(10,2)")
        .alias("total_amount"),
        _written(4, "created_at").alias("created_at"),
    )


def log_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed for every 5th, reopened for every 10th, deleted for 7 of 20."""
    k, key = F.col("k"), F.col("restaurant_id")
    applies = (
        (k == 0)
        | ((k == 1) & (key % 5 == 0))
        | ((k == 2) & (key % 10 == 0))
        | ((k == 3) & (key % 20 == 7))
    )
    return _steps(restaurants(spark, sf_dir), 3, "restaurant_id", applies).select(
        "op",
        "lsn",
        "restaurant_id",
        _written(3, "name").alias("name"),
        _written(3, "city").alias("city"),
        _written(3, k != 1).alias("is_active"),
    )


def log_renamed_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above; those that reopen have a new name then, and every other one has moved."""
    again = F.floor(F.col("lsn") / STEP) == 2
    moved = again & (F.col("restaurant_id") % 20 == 0)
    return log_restaurants(spark, sf_dir).withColumns({
        "name": F.when(again, F.concat("name", F.lit(" II"))).otherwise(F.col("name")),
        "city": F.when(moved, F.concat("city", F.lit(" (moved)"))).otherwise(F.col("city")),
    })


def in_steps(log: DataFrame, *steps: set[int]) -> list[DataFrame]:
    """The parts of a log that belong to some of its steps each."""
    return [log.filter(F.floor(F.col("lsn") / STEP).isin(*part)) for part in steps]


def log_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small price rise for every 4th, a large one for 1 of 9, some deleted."""
    k, key = F.col("k"), F.col("product_id")
    applies = (
        (k == 0)
        | ((k == 1) & (key % 4 == 0))
        | ((k == 2) & (key % 9 == 1))
        | ((k == 3) & (key % 50 == 9))
    )
    rise = F.when(k == 1, 1).when(k == 2, 500).otherwise(0)
    return _steps(products(spark, sf_dir), 3, "product_id", applies).select(
        "op",
        "lsn",
        "product_id",
        _written(3, "restaurant_id").alias("restaurant_id"),
        _written(3, "name").alias("name"),
        _written(3, (F.col("price") + rise).cast("decimal(10,2)")).alias("price"),
    )


def log_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changed city for every 7th, deleted for 5 of 30."""
    k, key = F.col("k"), F.col("customer_id")
    applies = (k == 0) | ((k == 1) & (key % 7 == 0)) | ((k == 2) & (key % 30 == 5))
    moved = F.when(k == 1, F.concat("city", F.lit(" (moved)"))).otherwise(F.col("city"))
    return _steps(customers(spark, sf_dir), 2, "customer_id", applies).select(
        "op",
        "lsn",
        "customer_id",
        _written(2, "full_name").alias("full_name"),
        _written(2, "email").alias("email"),
        _written(2, "phone").alias("phone"),
        _written(2, moved).alias("city"),
    )


def log_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One more of it for every 6th order's items, at a new price for every 12th; some deleted."""
    k, key = F.col("k"), F.col("order_id")
    applies = (k == 0) | ((k == 1) & (key % 6 == 0)) | ((k == 2) & (key % 23 == 0))
    price = F.col("unit_price") + F.when((k == 1) & (key % 12 == 0), 1).otherwise(0)
    return _steps(order_items(spark, sf_dir), 2, "order_id", applies).select(
        "op",
        "lsn",
        *ITEM_KEYS,
        _written(2, (F.col("quantity") + k).cast("int")).alias("quantity"),
        _written(2, price.cast("decimal(10,2)")).alias("unit_price"),
    )


def log_keyed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items with one key, as the item topic has them."""
    return log_order_items(spark, sf_dir).select(
        "op",
        "lsn",
        F.xxhash64(*ITEM_KEYS).alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
    )


def topics(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    """The log and the key of each captured table."""
    return {
        "customers": (log_customers(spark, sf_dir), "customer_id"),
        "restaurants": (log_restaurants(spark, sf_dir), "restaurant_id"),
        "products": (log_products(spark, sf_dir), "product_id"),
        "order_items": (log_keyed_items(spark, sf_dir), "order_item_id"),
        "orders": (log_orders(spark, sf_dir), "order_id"),
    }


def dirty_logs(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str, str]]:
    """Logs in which every 13th row of an id has an unreadable amount; with key and amount."""
    amounts = {"products": "price", "order_items": "unit_price", "orders": "total_amount"}
    ids = {"products": "product_id", "order_items": "order_id", "orders": "order_id"}
    found = topics(spark, sf_dir)
    out = {}
    for name, amount in amounts.items():
        log, key = found[name]
        text = F.when((F.col(ids[name]) % 13 == 0) & F.col(amount).isNotNull(), "abc")
        out[name] = (log.withColumn(amount, text.otherwise(F.col(amount).cast("string"))), key, amount)
    return out


def dirty_date() -> Column:
    return F.when(F.col("order_id") % 19 == 0, "2026-13-45T00:00:00Z").otherwise(F.col("created_at"))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied stream as changes to users; errors delete."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "d").otherwise("u").alias("op"),
        F.col("event_id").alias("lsn"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
