"""Each query's answer in SQL over the same tables."""

from __future__ import annotations

# The ordering domain and its change logs, from the supplied tables.
VIEWS = {
    "f_customers": """
        SELECT c_custkey AS customer_id, c_name AS full_name, c_name || '@example.com' AS email,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS phone,
               n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "f_restaurants": """
        SELECT s_suppkey AS restaurant_id, s_name AS name, n_name AS city
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "f_products": """
        SELECT p_partkey AS product_id, p_partkey % (SELECT count(*) FROM supplier) AS restaurant_id,
               p_name AS name, CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM part""",
    "f_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_orderkey % (SELECT count(*) FROM supplier) AS restaurant_id,
               CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 2 ELSE 3 END AS depth,
               CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at
        FROM orders""",
    "log_orders": """
        SELECT CASE WHEN k = 4 THEN 'd' WHEN k = 0 THEN 'c' ELSE 'u' END AS op,
               CAST(k AS BIGINT) * 1000000000 + order_id AS lsn, order_id,
               CASE WHEN k < 4 THEN customer_id END AS customer_id,
               CASE WHEN k < 4 THEN restaurant_id END AS restaurant_id,
               CASE WHEN k = 4 THEN NULL WHEN order_id % 40 = 3 THEN 'pending_sync'
                    WHEN k = 0 THEN 'created' WHEN k = 1 THEN 'confirmed'
                    WHEN k = 2 THEN 'preparing' ELSE 'delivered' END AS status,
               CASE WHEN k = 4 THEN NULL
                    WHEN order_id % 40 = 1 OR (order_id % 40 = 5 AND k = 1) THEN -total_amount
                    ELSE total_amount END AS total_amount,
               CASE WHEN k < 4 THEN created_at END AS created_at
        FROM f_orders CROSS JOIN (SELECT unnest(range(0, 5)) AS k)
        WHERE (k <= depth AND NOT (order_id % 40 = 3 AND k > 0)) OR (k = 4 AND order_id % 17 = 0)""",
    "log_restaurants": """
        SELECT CASE WHEN k = 3 THEN 'd' WHEN k = 0 THEN 'c' ELSE 'u' END AS op,
               CAST(k AS BIGINT) * 1000000000 + restaurant_id AS lsn, restaurant_id,
               CASE WHEN k < 3 THEN name END AS name, CASE WHEN k < 3 THEN city END AS city,
               CASE WHEN k = 3 THEN NULL ELSE k <> 1 END AS is_active
        FROM f_restaurants CROSS JOIN (SELECT unnest(range(0, 4)) AS k)
        WHERE k = 0 OR (k = 1 AND restaurant_id % 5 = 0) OR (k = 2 AND restaurant_id % 10 = 0)
           OR (k = 3 AND restaurant_id % 20 = 7)""",
    "log_products": """
        SELECT CASE WHEN k = 3 THEN 'd' WHEN k = 0 THEN 'c' ELSE 'u' END AS op,
               CAST(k AS BIGINT) * 1000000000 + product_id AS lsn, product_id,
               CASE WHEN k < 3 THEN restaurant_id END AS restaurant_id,
               CASE WHEN k < 3 THEN name END AS name,
               CAST(CASE k WHEN 0 THEN price WHEN 1 THEN price + 1 WHEN 2 THEN price + 500 END
                    AS DECIMAL(10,2)) AS price
        FROM f_products CROSS JOIN (SELECT unnest(range(0, 4)) AS k)
        WHERE k = 0 OR (k = 1 AND product_id % 4 = 0) OR (k = 2 AND product_id % 9 = 1)
           OR (k = 3 AND product_id % 50 = 9)""",
    "log_customers": """
        SELECT CASE WHEN k = 2 THEN 'd' WHEN k = 0 THEN 'c' ELSE 'u' END AS op,
               CAST(k AS BIGINT) * 1000000000 + customer_id AS lsn, customer_id,
               CASE WHEN k < 2 THEN full_name END AS full_name, CASE WHEN k < 2 THEN email END AS email,
               CASE WHEN k < 2 THEN phone END AS phone,
               CASE k WHEN 0 THEN city WHEN 1 THEN city || ' (moved)' END AS city
        FROM f_customers CROSS JOIN (SELECT unnest(range(0, 3)) AS k)
        WHERE k = 0 OR (k = 1 AND customer_id % 7 = 0) OR (k = 2 AND customer_id % 30 = 5)""",
    "log_order_items": """
        SELECT CASE WHEN k = 2 THEN 'd' WHEN k = 0 THEN 'c' ELSE 'u' END AS op,
               CAST(k AS BIGINT) * 1000000000 + l_orderkey AS lsn, l_orderkey AS order_id,
               l_partkey AS product_id, l_suppkey AS line_supplier, l_linenumber AS line_no,
               l_shipdate AS line_date,
               CASE WHEN k < 2 THEN CAST(CAST(l_quantity AS INTEGER) + k AS INTEGER) END AS quantity,
               CASE WHEN k < 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(10,2))
                   + CASE WHEN k = 1 AND l_orderkey % 12 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,2)) END AS unit_price
        FROM lineitem CROSS JOIN (SELECT unnest(range(0, 3)) AS k)
        WHERE k = 0 OR (k = 1 AND l_orderkey % 6 = 0) OR (k = 2 AND l_orderkey % 23 = 0)""",
    "log_events": """
        SELECT CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, event_id AS lsn,
               user_id, event_type, value, props
        FROM events""",
}
NEEDS = {
    "log_orders": ["f_orders"],
    "log_restaurants": ["f_restaurants"],
    "log_products": ["f_products"],
    "log_customers": ["f_customers"],
}
AS_OF = 1999999999
ITEM_KEYS = "order_id, product_id, line_supplier, line_no, line_date"
ORDER_DATA = "order_id, customer_id, restaurant_id, status, total_amount, created_at"


def _with(body: str, *views: str, **more: str) -> str:
    """A statement over the named views and further ones given in full."""
    chain: dict[str, str] = {}
    for view in views:
        for name in [*NEEDS.get(view, []), view]:
            chain[name] = VIEWS[name]
    chain.update(more)
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in chain.items()) + "\n" + body


def _now(log: str, keys: str) -> str:
    return f"""
        SELECT * EXCLUDE (op, lsn, rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY lsn DESC) AS rn FROM {log})
        WHERE rn = 1 AND op <> 'd'"""


def _history(log: str, keys: str) -> str:
    return f"""
        SELECT * EXCLUDE (op, lsn), lsn AS "__START_AT" FROM (
            SELECT *, lead(lsn) OVER (PARTITION BY {keys} ORDER BY lsn) AS "__END_AT" FROM {log})
        WHERE op <> 'd'"""


VALID = """
    SELECT * FROM log_orders
    WHERE (op = 'd' AND order_id IS NOT NULL) OR (order_id IS NOT NULL AND total_amount >= 0)"""
ORDERS_NOW = _now("valid", "order_id")
PLACES_NOW = _now("log_restaurants", "restaurant_id")
GOLD = {"valid": VALID, "o": ORDERS_NOW, "r": PLACES_NOW}
HISTORY = {"h": _history("log_orders", "order_id")}

ROUTED = "SELECT *, {flag} AS feed FROM log_orders"
THREE_VALUED = """
    CASE WHEN NOT (order_id IS NOT NULL AND total_amount >= 0) THEN 'quarantine'
         WHEN order_id IS NOT NULL AND total_amount >= 0 THEN 'valid' END"""
PASS_DELETES = """
    CASE WHEN op = 'd' AND order_id IS NOT NULL THEN 'valid'
         WHEN order_id IS NOT NULL AND total_amount >= 0 THEN 'valid' ELSE 'quarantine' END"""

ENRICHED = """
    SELECT o.order_id, o.status, o.total_amount, o.created_at AS ordered_at, o.customer_id,
           c.full_name AS customer_name, c.phone AS customer_phone, c.city AS customer_city,
           o.restaurant_id, r.name AS restaurant_name, r.city AS restaurant_city
    FROM o LEFT JOIN c ON o.customer_id = c.customer_id
           LEFT JOIN r ON o.restaurant_id = r.restaurant_id"""
ENRICHED_INPUTS = {**GOLD, "c": _now("log_customers", "customer_id")}
ENRICHED_LOGS = ("log_orders", "log_restaurants", "log_customers")


def _outcomes(entity: str, log: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, op, '{name}' AS rule,
                   CAST(count(*) FILTER (WHERE {rule}) AS BIGINT) AS passed,
                   CAST(count(*) FILTER (WHERE NOT ({rule})) AS BIGINT) AS failed,
                   CAST(count(*) FILTER (WHERE ({rule}) IS NULL) AS BIGINT) AS unknown
            FROM {log} GROUP BY op"""
        for name, rule in rules.items()
    )


def _feed(keys: str, columns: list[str]) -> str:
    """Differences between ``a`` and ``b``, keyed, as insert, delete and update rows."""
    listed = ", ".join(columns)
    key = keys.split(", ")[0]
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in columns)

    def image(kind: str, side: str, where: str) -> str:
        cols = ", ".join(f"{side}.{c}" for c in columns)
        return f"""SELECT '{kind}' AS "_change_type", {cols}
                   FROM a FULL JOIN b ON {on} WHERE {where}"""

    both = f"a.{key} IS NOT NULL AND b.{key} IS NOT NULL AND ({differs})"
    parts = [
        image("insert", "b", f"a.{key} IS NULL"),
        image("delete", "a", f"b.{key} IS NULL"),
        image("update_preimage", "a", both),
        image("update_postimage", "b", both),
    ]
    return f'SELECT "_change_type", {listed} FROM (' + " UNION ALL ".join(parts) + ")"


def _revenue(orders: str) -> str:
    return f"""
        SELECT city, CAST(count(order_id) AS BIGINT) AS order_count,
               CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
        FROM {orders} AS o JOIN r USING (restaurant_id) GROUP BY city"""


ORACLE = {
    "decode_change_events": _with("SELECT * FROM log_orders", "log_orders"),
    "scd1_customers": _with(_now("log_customers", "customer_id"), "log_customers"),
    "scd2_restaurants": _with(_history("log_restaurants", "restaurant_id"), "log_restaurants"),
    "scd2_products": _with(_history("log_products", "product_id"), "log_products"),
    "scd2_orders": _with(_history("log_orders", "order_id"), "log_orders"),
    "scd2_order_items": _with(_history("log_order_items", ITEM_KEYS), "log_order_items"),
    "scd1_events": _with(_now("log_events", "user_id"), "log_events"),
    "scd2_events": _with(_history("log_events", "user_id"), "log_events"),
    "scd2_incremental_orders": _with(_history("log_orders", "order_id"), "log_orders"),
    "scd1_incremental_events": _with(_now("log_events", "user_id"), "log_events"),
    "orders_as_of": _with(
        f"""SELECT * FROM h WHERE "__START_AT" <= {AS_OF}
            AND ("__END_AT" IS NULL OR "__END_AT" > {AS_OF})""",
        "log_orders",
        **HISTORY,
    ),
    "restaurants_collapsed": _with(
        """
        SELECT restaurant_id, min(name) AS name, min(city) AS city, min(s) AS "__START_AT",
               CASE WHEN count(*) = count(e) THEN max(e) END AS "__END_AT"
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY restaurant_id ORDER BY s) AS run
              FROM (SELECT restaurant_id, name, city, "__START_AT" AS s, "__END_AT" AS e,
                           CASE WHEN lag("__END_AT") OVER w IS NOT DISTINCT FROM "__START_AT"
                                 AND lag(name) OVER w IS NOT DISTINCT FROM name
                                 AND lag(city) OVER w IS NOT DISTINCT FROM city
                                THEN 0 ELSE 1 END AS fresh
                    FROM h WINDOW w AS (PARTITION BY restaurant_id ORDER BY "__START_AT")))
        GROUP BY restaurant_id, run""",
        "log_restaurants",
        h=_history("log_restaurants", "restaurant_id"),
    ),
    "quarantine_three_valued": _with(ROUTED.format(flag=THREE_VALUED), "log_orders"),
    "quarantine_pass_deletes": _with(ROUTED.format(flag=PASS_DELETES), "log_orders"),
    "quarantine_reasons": _with(
        """
        SELECT reason, CAST(count(*) AS BIGINT) AS rejects FROM (
            SELECT 'valid_key' AS reason FROM log_orders WHERE order_id IS NULL
            UNION ALL
            SELECT 'non_negative_amount' FROM log_orders
            WHERE total_amount IS NULL OR total_amount < 0)
        GROUP BY reason""",
        "log_orders",
    ),
    "expect_or_drop_products": _with(
        "SELECT * FROM log_products WHERE product_id IS NOT NULL AND price > 0", "log_products"
    ),
    "expectation_report": _with(
        " UNION ALL ".join(
            [
                _outcomes(
                    "customers",
                    "log_customers",
                    {
                        "valid_key": "customer_id IS NOT NULL",
                        "email_present": "email IS NOT NULL",
                        "phone_present": "phone IS NOT NULL",
                    },
                ),
                _outcomes(
                    "restaurants",
                    "log_restaurants",
                    {
                        "valid_key": "restaurant_id IS NOT NULL",
                        "name_present": "name IS NOT NULL",
                    },
                ),
                _outcomes(
                    "products",
                    "log_products",
                    {
                        "valid_key": "product_id IS NOT NULL",
                        "positive_price": "price > 0",
                        "name_present": "name IS NOT NULL",
                    },
                ),
                _outcomes(
                    "order_items",
                    "log_order_items",
                    {"valid_key": "order_id IS NOT NULL", "positive_qty": "quantity > 0"},
                ),
                _outcomes(
                    "orders",
                    "log_orders",
                    {
                        "known_status": "status IN ('created', 'confirmed', 'preparing', "
                        "'delivered', 'cancelled')"
                    },
                ),
            ]
        ),
        "log_customers",
        "log_restaurants",
        "log_products",
        "log_order_items",
        "log_orders",
    ),
    "daily_orders_by_restaurant": _with(
        """
        SELECT CAST(substr(created_at, 1, 10) AS DATE) AS order_date, restaurant_id,
               name AS restaurant_name, CAST(count(order_id) AS BIGINT) AS order_count,
               CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
        FROM o JOIN r USING (restaurant_id) GROUP BY ALL""",
        "log_orders",
        "log_restaurants",
        **GOLD,
    ),
    "revenue_by_city": _with(_revenue("o"), "log_orders", "log_restaurants", **GOLD),
    "top_products": _with(
        """
        SELECT p.product_id, p.name AS product_name, p.restaurant_id, r.name AS restaurant_name,
               CAST(sum(quantity) AS BIGINT) AS total_quantity,
               CAST(sum(quantity * unit_price) AS DECIMAL(31,2)) AS total_revenue
        FROM i JOIN p ON i.product_id = p.product_id JOIN r ON p.restaurant_id = r.restaurant_id
        GROUP BY ALL""",
        "log_order_items",
        "log_products",
        "log_restaurants",
        i=_now("log_order_items", ITEM_KEYS),
        p=_now("log_products", "product_id"),
        r=PLACES_NOW,
    ),
    "order_enriched": _with(ENRICHED, *ENRICHED_LOGS, **ENRICHED_INPUTS),
    "order_lookup": _with(
        ENRICHED + " WHERE o.order_id IN (SELECT user_id FROM events)",
        *ENRICHED_LOGS,
        **ENRICHED_INPUTS,
    ),
    "order_change_feed": _with(
        _feed("order_id", ORDER_DATA.split(", ")),
        "log_orders",
        **HISTORY,
        a=f"""SELECT {ORDER_DATA} FROM h WHERE "__START_AT" <= {AS_OF}
              AND ("__END_AT" IS NULL OR "__END_AT" > {AS_OF})""",
        b=f'SELECT {ORDER_DATA} FROM h WHERE "__END_AT" IS NULL',
    ),
    "revenue_change_feed": _with(
        _feed("city", ["city", "order_count", "revenue"]),
        "log_orders",
        "log_restaurants",
        valid=VALID,
        h=_history("valid", "order_id"),
        r=PLACES_NOW,
        early=f"""SELECT * FROM h WHERE "__START_AT" <= {AS_OF}
                  AND ("__END_AT" IS NULL OR "__END_AT" > {AS_OF})""",
        final='SELECT * FROM h WHERE "__END_AT" IS NULL',
        a=_revenue("early"),
        b=_revenue("final"),
    ),
    "synced_orders": _with(_now("log_orders", "order_id"), "log_orders"),
    "stream_scd2_orders": _with(
        _history("valid", "order_id"), "log_orders", valid=VALID
    ),
    "stream_quarantine": _with(
        f"""
        SELECT op, lsn, {ORDER_DATA}, 'non_negative_amount' AS reasons
        FROM log_orders WHERE op <> 'd' AND (total_amount IS NULL OR total_amount < 0)""",
        "log_orders",
    ),
    "order_total_reconciliation": _with(
        """
        SELECT o.order_id, o.total_amount,
               CAST(coalesce(s.total, 0) AS DECIMAL(31,2)) AS items_total,
               CAST(o.total_amount - coalesce(s.total, 0) AS DECIMAL(32,2)) AS difference,
               s.total IS NULL AS missing_items
        FROM o LEFT JOIN (SELECT order_id, sum(quantity * unit_price) AS total
                          FROM i GROUP BY order_id) s ON o.order_id = s.order_id""",
        "log_orders",
        "log_order_items",
        valid=VALID,
        o=ORDERS_NOW,
        i=_now("log_order_items", ITEM_KEYS),
    ),
    "order_anomalies": _with(
        """
        SELECT order_date, anomaly, CAST(count(*) AS BIGINT) AS orders,
               CAST(count(*) AS DOUBLE)
                   / CAST(sum(count(*)) OVER (PARTITION BY order_date) AS DOUBLE) AS share
        FROM (SELECT CAST(substr(created_at, 1, 10) AS DATE) AS order_date,
                     CASE WHEN total_amount < 0 AND NOT known
                          THEN 'negative_total+unknown_status'
                          WHEN total_amount < 0 THEN 'negative_total'
                          WHEN NOT known THEN 'unknown_status' ELSE 'none' END AS anomaly
              FROM (SELECT *, status IN ('created', 'confirmed', 'preparing', 'delivered',
                                         'cancelled') AS known FROM o))
        GROUP BY order_date, anomaly""",
        "log_orders",
        o=_now("log_orders", "order_id"),
    ),
    "status_transition_audit": _with(
        """
        SELECT order_id, "__START_AT", status, previous_status,
               (previous_status, status) IN (('created', 'confirmed'), ('confirmed', 'preparing'),
                   ('preparing', 'delivered'), ('created', 'cancelled'),
                   ('confirmed', 'cancelled'), ('preparing', 'cancelled')) AS legal
        FROM (SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY "__START_AT")
                        AS previous_status FROM h)
        WHERE previous_status IS NOT NULL AND previous_status <> status""",
        "log_orders",
        **HISTORY,
    ),
    "price_move_audit": _with(
        """
        SELECT product_id, "__START_AT", price, previous_price,
               price * 10 > previous_price * 11 OR price * 10 < previous_price * 9 AS excessive
        FROM (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY "__START_AT")
                        AS previous_price FROM h)
        WHERE previous_price IS NOT NULL AND previous_price <> price""",
        "log_products",
        h=_history("log_products", "product_id"),
    ),
    "active_floor_audit": _with(
        """
        SELECT lsn, CAST(delta AS BIGINT) AS delta, CAST(active AS BIGINT) AS active_count,
               delta < 0 AND active < (SELECT count(*) * 9 // 10 FROM supplier) AS breach
        FROM (SELECT lsn, delta, sum(delta) OVER (ORDER BY lsn) AS active
              FROM (SELECT lsn, sum(step) AS delta
                    FROM (SELECT "__START_AT" AS lsn, 1 AS step FROM h WHERE is_active
                          UNION ALL
                          SELECT "__END_AT", -1 FROM h WHERE is_active AND "__END_AT" IS NOT NULL)
                    GROUP BY lsn) WHERE delta <> 0)""",
        "log_restaurants",
        h=_history("log_restaurants", "restaurant_id"),
    ),
}
# Stored and streamed forms of the same answers.
ORACLE["published_revenue_feed"] = ORACLE["revenue_change_feed"]
ORACLE["stream_order_enriched"] = ORACLE["order_enriched"]
ORACLE["staged_daily_orders"] = ORACLE["daily_orders_by_restaurant"]
ORACLE["staged_revenue_by_city"] = ORACLE["revenue_by_city"]
ORACLE["staged_top_products"] = ORACLE["top_products"]
ORACLE["staged_synced_serving"] = ORACLE["order_enriched"]
ORACLE["clustered_daily_orders"] = (
    f"SELECT * FROM ({ORACLE['daily_orders_by_restaurant']}) "
    "WHERE restaurant_id BETWEEN 0 AND (SELECT count(*) // 4 FROM supplier)"
)
ORACLE["patched_order_history"] = ORACLE["scd2_orders"]
ORACLE["stored_orders_as_of"] = ORACLE["orders_as_of"]
# Restaurants that are renamed, and some that move, when they reopen.
RENAMED = """
    SELECT * REPLACE (CASE WHEN lsn // 1000000000 = 2 THEN name || ' II' ELSE name END AS name,
                      CASE WHEN lsn // 1000000000 = 2 AND restaurant_id % 20 = 0 THEN city || ' (moved)' ELSE city END AS city)
    FROM log_restaurants"""
RENAMED_NOW = {"renamed": RENAMED, "r": _now("renamed", "restaurant_id")}
ORACLE["incremental_daily_orders"] = _with(
    """
    SELECT CAST(substr(created_at, 1, 10) AS DATE) AS order_date, restaurant_id,
           name AS restaurant_name, CAST(count(order_id) AS BIGINT) AS order_count,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
    FROM o JOIN r USING (restaurant_id) GROUP BY ALL""",
    "log_orders",
    "log_restaurants",
    **{**RENAMED_NOW, **GOLD, **RENAMED_NOW},
)
ORACLE["incremental_revenue_by_city"] = _with(_revenue("o"), "log_orders", "log_restaurants", **{**RENAMED_NOW, **GOLD, **RENAMED_NOW})
ORACLE["incremental_top_products"] = _with(
    """
    SELECT p.product_id, p.name AS product_name, p.restaurant_id, r.name AS restaurant_name,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(quantity * unit_price) AS DECIMAL(31,2)) AS total_revenue
    FROM i JOIN p ON i.product_id = p.product_id JOIN r ON p.restaurant_id = r.restaurant_id
    GROUP BY ALL""",
    "log_order_items",
    "log_products",
    "log_restaurants",
    i=_now("log_order_items", ITEM_KEYS),
    p=_now("log_products", "product_id"),
    **RENAMED_NOW,
)
ORACLE["stored_order_lookup"] = _with(
    ENRICHED + """
    WHERE o.order_id = (SELECT max(order_id) FROM o WHERE order_id IN (SELECT user_id FROM events))""",
    *ENRICHED_LOGS,
    **ENRICHED_INPUTS,
)
ORACLE["dirty_dates_counted"] = _with(
    """
    SELECT CASE WHEN order_id % 19 <> 0 THEN CAST(substr(created_at, 1, 10) AS DATE) END AS order_date,
           restaurant_id, name AS restaurant_name, CAST(count(order_id) AS BIGINT) AS order_count,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
    FROM o JOIN r USING (restaurant_id) GROUP BY ALL""",
    "log_orders",
    "log_restaurants",
    **GOLD,
)
_NULL_CITY = "SELECT * REPLACE (CASE WHEN restaurant_id % 3 <> 0 THEN city END AS city) FROM places"
ORACLE["null_key_change_feed"] = _with(
    """
    SELECT "_change_type", city, order_count, revenue FROM (
        SELECT CASE WHEN a.there IS NULL THEN 'insert' ELSE 'update_postimage' END AS "_change_type", b.*
        FROM b LEFT JOIN a ON a.city IS NOT DISTINCT FROM b.city
        WHERE a.there IS NULL OR a.order_count <> b.order_count OR a.revenue IS DISTINCT FROM b.revenue
        UNION ALL
        SELECT CASE WHEN b.there IS NULL THEN 'delete' ELSE 'update_preimage' END, a.*
        FROM a LEFT JOIN b ON a.city IS NOT DISTINCT FROM b.city
        WHERE b.there IS NULL OR a.order_count <> b.order_count OR a.revenue IS DISTINCT FROM b.revenue)""",
    "log_orders",
    "log_restaurants",
    valid=VALID,
    h=_history("valid", "order_id"),
    places=PLACES_NOW,
    r=_NULL_CITY,
    early=f"""SELECT * FROM h WHERE "__START_AT" <= {AS_OF}
              AND ("__END_AT" IS NULL OR "__END_AT" > {AS_OF})""",
    final='SELECT * FROM h WHERE "__END_AT" IS NULL',
    a=f"SELECT *, 1 AS there FROM ({_revenue('early')})",
    b=f"SELECT *, 1 AS there FROM ({_revenue('final')})",
)


def _dirty(entity: str, log: str, ident: str, amount: str, checked: bool) -> str:
    """Rows of a log with unreadable amounts; ``checked`` ones must be positive or zero, too."""
    wrong = f"({ident} % 13 = 0 AND {amount} IS NOT NULL)"
    negative = f"(op <> 'd' AND ({wrong} OR {amount} IS NULL OR {amount} < 0))"
    aside = f"({wrong} OR {negative})" if checked else wrong
    reasons = f"""concat_ws(',', {f"CASE WHEN {negative} THEN 'non_negative_amount' END," if checked else ""}
                  CASE WHEN {wrong} THEN 'readable_amounts' END)"""
    return f"""
        SELECT '{entity}' AS entity, op, lsn, CASE WHEN {aside} THEN 'quarantine' ELSE 'valid' END AS route,
               CASE WHEN NOT {wrong} THEN {amount} END AS amount, CASE WHEN {aside} THEN {reasons} END AS reasons
        FROM {log}"""


ORACLE["dirty_records_routed"] = _with(
    " UNION ALL ".join([
        _dirty("products", "log_products", "product_id", "price", False),
        _dirty("order_items", "log_order_items", "order_id", "unit_price", False),
        _dirty("orders", "log_orders", "order_id", "total_amount", True),
    ]),
    "log_products",
    "log_order_items",
    "log_orders",
)


def _observed(entity: str, log: str, rules: dict[str, str]) -> str:
    counts = [("rows", "true")]
    for name, rule in rules.items():
        for part, among in (("writes", "op <> 'd'"), ("deletes", "op = 'd'")):
            for outcome, verdict in (("passed", rule), ("failed", f"NOT ({rule})"), ("unknown", f"({rule}) IS NULL")):
                counts.append((f"{name}.{part}.{outcome}", f"{among} AND {verdict}"))
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{m}' AS measure, CAST(count(*) FILTER (WHERE {w}) AS BIGINT) AS rows FROM {log}"
        for m, w in counts
    )


ORACLE["observed_expectations"] = _with(
    " UNION ALL ".join([
        _observed("customers", "log_customers", {"email_present": "email IS NOT NULL", "phone_present": "phone IS NOT NULL"}),
        _observed("restaurants", "log_restaurants", {"name_present": "name IS NOT NULL"}),
        _observed("products", "log_products", {"positive_price": "price > 0", "name_present": "name IS NOT NULL"}),
        _observed("order_items", "log_order_items", {"positive_qty": "quantity > 0"}),
        _observed("orders", "log_orders", {
            "known_status": "status IN ('created', 'confirmed', 'preparing', 'delivered', 'cancelled')"}),
    ]),
    "log_customers",
    "log_restaurants",
    "log_products",
    "log_order_items",
    "log_orders",
)
