"""The named queries once more, as SQL for another engine (DuckDB).

Written from the definitions, not from the Spark code: windows are plain windows over all lines,
histories are compared row by row.
"""

from __future__ import annotations

from depotlake.schemas import TABLES, columns

# ------------------------------------------------------------ shared parts

_RISK = "(31 * p + 17 * n) % 111"

PARTS: dict[str, str] = {
    "src_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               replace(lower(c_name), '#', '.') || '@example.com' AS customer_email
        FROM customer""",
    "src_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders""",
    "src_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price, l_linenumber AS line_number
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "src_categories": """
        SELECT p_type AS category_name,
               CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS category_id
        FROM (SELECT DISTINCT p_type FROM part)""",
    "src_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, category_id,
               p_partkey % (SELECT count(*) FROM supplier) AS supplier_id
        FROM part JOIN src_categories ON p_type = category_name""",
    "src_suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, 'ACTIVE' AS supplier_status,
               CAST((20 + s_suppkey % 31) * 0.1 AS DECIMAL(3,2)) AS supplier_rating
        FROM supplier""",
    "src_warehouses": """
        SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name,
               CASE n_nationkey % 3 WHEN 0 THEN 'REGIONAL_HUB' WHEN 1 THEN 'FULFILLMENT'
                    ELSE 'LOCAL_DEPOT' END AS warehouse_type,
               r_name AS region, n_name AS city
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_inventory": f"""
        SELECT p * (SELECT count(*) FROM nation) + n AS inventory_id, n AS warehouse_id, p AS product_id,
               CAST((7 * p + 13 * n) % 250 AS INTEGER) AS current_stock,
               CAST(20 + p % 60 AS INTEGER) AS reorder_point,
               CASE WHEN {_RISK} < 60 THEN 'HEALTHY' WHEN {_RISK} < 75 THEN 'LOW'
                    ELSE 'CRITICAL' END AS stock_status,
               CAST((3 * p + n) % 30 AS INTEGER) AS days_of_supply,
               CAST({_RISK} * 0.01 AS DECIMAL(3,2)) AS stock_out_risk_score,
               CASE p % 3 WHEN 0 THEN 'FAST' WHEN 1 THEN 'MEDIUM' ELSE 'SLOW' END
                   AS movement_velocity
        FROM (SELECT p_partkey AS p, n_nationkey AS n FROM part, nation)
        WHERE (p + n) % 10 <> 0""",
    "src_shipments": """
        SELECT k AS shipment_id, k AS order_id, k % (SELECT count(*) FROM supplier) AS supplier_id,
               CAST(k % (SELECT count(*) FROM nation) AS INTEGER) AS warehouse_id, shipped AS shipment_date,
               shipped + 3 AS expected_delivery_date, shipped + days AS actual_delivery_date,
               CAST((2500 + k % 6000) * 0.01 AS DECIMAL(10,2)) AS shipping_cost,
               days AS delivery_time_days, days > 3 AS is_late,
               CAST((29 + k % 21) * 0.1 AS DECIMAL(2,1)) AS quality_rating,
               CAST((52 + k % 55) * 0.01 AS DECIMAL(3,2)) AS delivery_performance_score
        FROM (SELECT o_orderkey AS k,
                     CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS shipped,
                     CAST(2 + o_orderkey * 7 % 4 AS INTEGER) AS days
              FROM orders WHERE o_orderstatus <> 'P')""",
    "base": """
        SELECT o.order_id AS order_key, o.customer_id AS customer_key,
               p.product_id AS product_key, s.supplier_id AS supplier_key,
               w.warehouse_id AS warehouse_key, g.category_id AS category_key,
               o.order_date, d.shipment_date, d.expected_delivery_date, d.actual_delivery_date,
               c.customer_name, p.product_name, g.category_name, s.supplier_name,
               i.quantity AS order_quantity, i.price AS unit_price,
               i.quantity * i.price AS order_value,
               coalesce(d.delivery_time_days, 0) AS delivery_time_days,
               coalesce(d.is_late, false) AS is_late_delivery,
               coalesce(d.shipping_cost, 0) AS shipping_cost,
               coalesce(d.delivery_performance_score, 1) AS delivery_performance_score,
               coalesce(d.quality_rating, 5) AS quality_rating,
               coalesce(v.current_stock, 0) AS current_stock_level,
               coalesce(v.reorder_point, 0) AS reorder_point,
               coalesce(v.stock_out_risk_score, 0) AS stock_out_risk_score,
               coalesce(v.days_of_supply, 0) AS days_of_supply,
               coalesce(v.movement_velocity, 'UNKNOWN') AS movement_velocity,
               coalesce(v.stock_status, 'UNKNOWN') AS stock_status,
               coalesce(w.warehouse_name, 'Unknown') AS warehouse_name,
               coalesce(w.region, 'Unknown') AS warehouse_region,
               i.line_number, d.shipment_id, v.inventory_id
        FROM src_orders o
        JOIN src_customers c ON c.customer_id = o.customer_id
        JOIN src_items i ON i.order_id = o.order_id
        JOIN src_products p ON p.product_id = i.product_id
        JOIN src_categories g ON g.category_id = p.category_id
        JOIN src_suppliers s ON s.supplier_id = p.supplier_id
        LEFT JOIN src_shipments d ON d.order_id = o.order_id
        LEFT JOIN src_warehouses w ON w.warehouse_id = d.warehouse_id
        LEFT JOIN src_inventory v
               ON v.product_id = p.product_id AND v.warehouse_id = w.warehouse_id""",
}

_DERIVED = """
    SELECT *,
           CAST(stock_out_risk_score * 0.4 + CASE WHEN is_late_delivery THEN 0.36 ELSE 0 END
                AS DECIMAL(6,3)) AS supply_chain_risk_score,
           CASE movement_velocity WHEN 'FAST' THEN 'HIGH_TURNOVER'
                WHEN 'MEDIUM' THEN 'MEDIUM_TURNOVER' WHEN 'SLOW' THEN 'LOW_TURNOVER'
                ELSE 'UNKNOWN_TURNOVER' END AS inventory_turnover_category,
           order_value + shipping_cost AS total_supply_chain_cost,
           CAST(year(order_date) AS INTEGER) AS order_year,
           CAST(month(order_date) AS INTEGER) AS order_month,
           CAST(day(order_date) AS INTEGER) AS order_day
    FROM {source}"""


def _clamped(column: str) -> str:
    return (
        f"CASE WHEN {column} > 1 THEN CAST(1 AS DECIMAL(3,2))"
        f" WHEN {column} < 0 THEN CAST(0 AS DECIMAL(3,2)) ELSE {column} END"
    )


_FILLED = """coalesce(delivery_time_days, 0) AS delivery_time_days,
        coalesce(shipping_cost, 0) AS shipping_cost,
        coalesce(current_stock_level, 0) AS current_stock_level,
        coalesce(stock_out_risk_score, 0.5) AS stock_out_risk_score,
        coalesce(delivery_performance_score, 1) AS delivery_performance_score,
        coalesce(quality_rating, 3) AS quality_rating"""

_CLEANED = f"""
    SELECT * REPLACE ({_clamped('delivery_performance_score')} AS delivery_performance_score,
                      {_clamped('stock_out_risk_score')} AS stock_out_risk_score)
    FROM (SELECT * REPLACE ({_FILLED}) FROM {{source}}
          WHERE order_quantity > 0 AND unit_price > 0 AND order_value > 0)"""

PARTS["derived"] = _DERIVED.format(source="base")
PARTS["fact"] = _CLEANED.format(source="derived")

PARTS["damaged"] = """
    SELECT * REPLACE (order_quantity * unit_price AS order_value)
    FROM (SELECT * REPLACE (
            CASE WHEN order_key % 13 <> 0 THEN customer_key END AS customer_key,
            CASE WHEN order_key % 37 <> 0 THEN order_date END AS order_date,
            CASE WHEN line_number = 7 THEN 0
                 WHEN line_number = 6 AND order_key % 5 = 0 THEN NULL
                 WHEN line_number = 5 AND order_key % 5 = 1 THEN -order_quantity
                 ELSE order_quantity END AS order_quantity,
            CASE WHEN product_key % 41 = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE unit_price END
                AS unit_price,
            CASE WHEN order_key % 17 <> 0 THEN delivery_time_days END AS delivery_time_days,
            CASE WHEN order_key % 19 <> 0 THEN shipping_cost END AS shipping_cost,
            CASE WHEN order_key % 23 <> 0 THEN current_stock_level END AS current_stock_level,
            CASE WHEN order_key % 7 = 0 THEN NULL
                 WHEN order_key % 7 = 1 THEN -stock_out_risk_score
                 ELSE stock_out_risk_score END AS stock_out_risk_score,
            CASE WHEN order_key % 29 <> 0 THEN delivery_performance_score END
                AS delivery_performance_score,
            CASE WHEN order_key % 31 <> 0 THEN quality_rating END AS quality_rating)
          FROM base)"""
PARTS["damaged_derived"] = _DERIVED.format(source="damaged")
PARTS["damaged_fact"] = _CLEANED.format(source="damaged_derived")


def _mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


_LATE_RATE = "CAST(count(*) FILTER (WHERE is_late_delivery) AS DOUBLE) / count(*)"

PARTS["team"] = f"""
    SELECT supplier_key, supplier_name, warehouse_region, order_year, order_month,
           {_mean('delivery_time_days')} AS avg_delivery_time,
           {_LATE_RATE} AS late_shipment_rate,
           {_mean('delivery_performance_score')} AS avg_delivery_performance,
           {_mean('quality_rating')} AS avg_quality_rating,
           sum(shipping_cost) AS total_shipping_cost,
           {_mean('supply_chain_risk_score')} AS avg_supply_chain_risk,
           CASE WHEN sum(delivery_performance_score) >= 0.9 * count(*) THEN 'EXCELLENT'
                WHEN sum(delivery_performance_score) >= 0.8 * count(*) THEN 'GOOD'
                WHEN sum(delivery_performance_score) >= 0.7 * count(*) THEN 'FAIR'
                ELSE 'POOR' END AS performance_category
    FROM fact GROUP BY ALL"""
PARTS["store"] = f"""
    SELECT product_key, product_name, category_name, warehouse_key, warehouse_name,
           order_year, order_month,
           {_mean('current_stock_level')} AS avg_stock_level,
           {_mean('stock_out_risk_score')} AS avg_stock_out_risk,
           sum(order_quantity) AS total_demand,
           {_mean('days_of_supply')} AS avg_days_of_supply,
           sum(order_value) AS total_revenue,
           CASE WHEN sum(stock_out_risk_score) <= 0.3 * count(*) THEN 'HEALTHY'
                WHEN sum(stock_out_risk_score) <= 0.6 * count(*) THEN 'MODERATE_RISK'
                ELSE 'HIGH_RISK' END AS stock_health_status,
           CASE WHEN sum(order_quantity) >= 100 THEN 'FAST_MOVING'
                WHEN sum(order_quantity) >= 50 THEN 'MEDIUM_MOVING'
                ELSE 'SLOW_MOVING' END AS product_velocity_classification
    FROM fact GROUP BY ALL"""
PARTS["finance"] = f"""
    SELECT supplier_key, supplier_name, category_name, order_year, order_month,
           sum(order_value) AS total_purchase_value, {_mean('unit_price')} AS avg_unit_price,
           sum(shipping_cost) AS total_shipping_cost,
           sum(total_supply_chain_cost) AS total_supply_chain_cost,
           {_mean('delivery_time_days')} AS avg_payment_cycle_days,
           sum(order_quantity) AS total_units_purchased,
           CASE WHEN sum(order_value) >= 50000 THEN 'TIER_1_HIGH_SPEND'
                WHEN sum(order_value) >= 20000 THEN 'TIER_2_MEDIUM_SPEND'
                ELSE 'TIER_3_LOW_SPEND' END AS supplier_spend_tier,
           CAST(sum(order_value) AS DOUBLE)
               / CAST(sum(total_supply_chain_cost) + 1 AS DOUBLE) AS cost_efficiency_ratio
    FROM fact GROUP BY ALL"""
PARTS["scorecard"] = f"""
    SELECT supplier_key, supplier_name,
           {_mean('delivery_performance_score')} AS delivery_score,
           {_mean('quality_rating')} AS quality_score,
           CAST(count(*) FILTER (WHERE stock_status = 'HEALTHY') AS DOUBLE) / count(*)
               AS availability_score,
           (delivery_score * CAST(0.4 AS DOUBLE) + quality_score / 5 * CAST(0.3 AS DOUBLE)
            + availability_score * CAST(0.3 AS DOUBLE)) * 100 AS overall_supplier_score
    FROM fact GROUP BY supplier_key, supplier_name"""
PARTS["graded"] = """
    SELECT *, CASE WHEN round(overall_supplier_score, 6) >= 80 THEN 'EXCELLENT'
                   WHEN round(overall_supplier_score, 6) >= 70 THEN 'GOOD'
                   WHEN round(overall_supplier_score, 6) >= 60 THEN 'FAIR'
                   ELSE 'NEEDS_IMPROVEMENT' END AS supplier_grade
    FROM scorecard"""
PARTS["monthly"] = f"""
    SELECT order_year, order_month, count(DISTINCT order_key) AS total_orders,
           CAST(sum(order_value) AS DOUBLE) AS total_revenue,
           {_mean('delivery_time_days')} AS avg_delivery_time,
           {_LATE_RATE} AS late_delivery_rate,
           {_mean('supply_chain_risk_score')} AS avg_risk_score
    FROM fact GROUP BY ALL"""

_TIES = (
    "order_key, line_number, shipment_id NULLS FIRST, inventory_id NULLS FIRST, product_key,"
    " order_quantity, unit_price"
)


def _over(key: str) -> str:
    return f"OVER (PARTITION BY {key} ORDER BY order_date)"


def _numbered(key: str) -> str:
    return f"row_number() OVER (PARTITION BY {key} ORDER BY order_date, {_TIES})"


def _running_mean(top: str, key: str) -> str:
    return f"CAST(sum({top}) {_over(key)} AS DOUBLE) / count(*) {_over(key)}"


HISTORIES: dict[str, str] = {
    "customer_order_sequence": _numbered("customer_key"),
    "customer_total_orders": f"rank() {_over('customer_key')}",
    "customer_cumulative_value": f"CAST(sum(order_value) {_over('customer_key')} AS DOUBLE)",
    "supplier_order_sequence": _numbered("supplier_key"),
    "supplier_avg_delivery_time": _running_mean("delivery_time_days", "supplier_key"),
    "supplier_late_delivery_rate": _running_mean(
        "CASE WHEN is_late_delivery THEN 1 ELSE 0 END", "supplier_key"
    ),
    "product_order_sequence": _numbered("product_key"),
    "product_demand_trend": f"CAST(sum(order_quantity) {_over('product_key')} AS BIGINT)",
}

PARTS["enhanced"] = "SELECT *, {} FROM derived".format(
    ", ".join(f"{sql} AS {name}" for name, sql in HISTORIES.items())
)

PARTS["full_fact"] = _CLEANED.format(source="enhanced")
PARTS["fan_shipments"] = """
    SELECT * FROM src_shipments
    UNION ALL
    SELECT * REPLACE (shipment_id + 1000000000 AS shipment_id,
                      delivery_time_days + 1 AS delivery_time_days)
    FROM src_shipments WHERE order_id % 3 = 0"""
PARTS["fan_inventory"] = """
    SELECT * FROM src_inventory
    UNION ALL
    SELECT * REPLACE (inventory_id + 1000000000 AS inventory_id, current_stock + 1 AS current_stock)
    FROM src_inventory WHERE product_id % 4 = 0"""
# Copies of a line are numbered alike in all three histories.
PARTS["copied_items"] = """
    SELECT i.*, n AS copy_number FROM src_items i, range(40) t(n) WHERE n < CASE WHEN order_id % 50 = 0 THEN 40 ELSE 1 END"""
PARTS["fan_base"] = (
    PARTS["base"].replace("src_shipments", "fan_shipments").replace("src_inventory", "fan_inventory")
)
PARTS["copied_base"] = (
    PARTS["base"].replace("src_items", "copied_items").replace("i.line_number,", "i.line_number, i.copy_number,")
)
for _kind in ("fan", "copied"):
    PARTS[f"{_kind}_derived"] = _DERIVED.format(source=f"{_kind}_base")
    PARTS[f"{_kind}_enhanced"] = PARTS["enhanced"].replace("FROM derived", f"FROM {_kind}_derived")
PARTS["copied_enhanced"] = PARTS["copied_enhanced"].replace(_TIES, f"{_TIES}, copy_number")

PARTS["first_customers"] = """
    SELECT DISTINCT customer_id, customer_name, customer_email FROM src_customers"""
PARTS["later_customers"] = """
    SELECT customer_id,
           CASE WHEN customer_id % 10 = 3 THEN customer_name || ' Ltd' ELSE customer_name END
               AS customer_name,
           CASE WHEN customer_id % 23 = 4 THEN NULL ELSE customer_email END AS customer_email
    FROM src_customers WHERE customer_id % 17 <> 5
    UNION ALL
    SELECT customer_id + 1000000000, customer_name, customer_email
    FROM src_customers WHERE customer_id % 50 = 7"""
# Every customer is one row in each snapshot, so old and new are compared side by side.
PARTS["merged"] = """
    SELECT o.customer_id, o.customer_name, o.customer_email, '2024-01-01' AS effective_start_date,
           CASE WHEN changed THEN '2024-02-29' ELSE '9999-12-31' END AS effective_end_date,
           NOT changed AS is_current, CAST(1 AS INTEGER) AS record_version,
           '2024-01-01 06:00:00' AS created_timestamp,
           CASE WHEN changed THEN '2024-03-01 06:00:00' ELSE '2024-01-01 06:00:00' END
               AS updated_timestamp
    FROM (SELECT f.*, l.customer_id IS NOT NULL
                 AND (f.customer_name IS DISTINCT FROM l.customer_name
                      OR f.customer_email IS DISTINCT FROM l.customer_email) AS changed
          FROM first_customers f LEFT JOIN later_customers l USING (customer_id)) o
    UNION ALL
    SELECT l.customer_id, l.customer_name, l.customer_email, '2024-03-01', '9999-12-31', true,
           CAST(CASE WHEN f.customer_id IS NULL THEN 1 ELSE 2 END AS INTEGER),
           '2024-03-01 06:00:00', '2024-03-01 06:00:00'
    FROM later_customers l LEFT JOIN first_customers f USING (customer_id)
    WHERE f.customer_id IS NULL
       OR f.customer_name IS DISTINCT FROM l.customer_name
       OR f.customer_email IS DISTINCT FROM l.customer_email"""


def _with(body: str) -> str:
    """Prefix the body with the parts it needs, directly or through other parts."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for name in PARTS.keys() & words:
            if name not in needed:
                needed.add(name)
                visit(PARTS[name])

    visit(body)
    used = [f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed]
    return f"WITH {', '.join(used)}\n{body}" if used else body


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "VARCHAR",
    "timestamp": "VARCHAR",
}


def _table(table: str, source: str) -> str:
    picked = ", ".join(
        f"CAST({name} AS {SQL_TYPES[kind]}) AS {name}" for name, kind in columns(TABLES[table])
    )
    return _with(f"SELECT {picked} FROM {source}")


def _cast(names: str, source: str, tail: str = "") -> str:
    """``names`` lists columns, each with an optional type: ``a, b:DOUBLE``."""
    picked = []
    for item in names.split(","):
        name, _, kind = item.strip().partition(":")
        picked.append(f"CAST({name} AS {kind}) AS {name}" if kind else name)
    return _with(f"SELECT {', '.join(picked)} FROM {source} {tail}")


LINE = "order_key, product_key, line_number, order_quantity, unit_price:DOUBLE"
DATES = (
    "shipment_date:VARCHAR, expected_delivery_date:VARCHAR, actual_delivery_date:VARCHAR"
)

ORACLE_SQL: dict[str, str] = {}

# ---------------------------------------------------------- sources, joins

_NAMES = {
    "customers": "src_customers",
    "orders": "src_orders",
    "order_items": "src_items",
    "products": "src_products",
    "categories": "src_categories",
    "suppliers": "src_suppliers",
    "inventory": "src_inventory",
    "shipments": "src_shipments",
    "warehouses": "src_warehouses",
}


def _counts(column: str, tables: dict[str, str]) -> str:
    return _with(
        " UNION ALL ".join(
            f"SELECT '{shown}' AS {column}, count(*) AS row_count FROM {name}"
            for shown, name in tables.items()
        )
    )


ORACLE_SQL |= {
    "source_counts": _counts("source_name", _NAMES),
    "source_defaults": _with(
        """SELECT supplier_id, supplier_name,
                  CASE WHEN supplier_id % 3 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END
                      AS supplier_status,
                  CAST(CASE WHEN supplier_id % 4 = 0 THEN 5.00 ELSE supplier_rating END AS DOUBLE)
                      AS supplier_rating
           FROM src_suppliers"""
    ),
    "source_defaults_warehouses": _with(
        """SELECT warehouse_id, warehouse_id % 2 <> 0 AS climate_controlled,
                  CASE WHEN warehouse_id % 3 = 0 THEN '2024-01-01' ELSE '2020-05-01' END
                      AS effective_start_date,
                  '9999-12-31' AS effective_end_date, warehouse_id % 4 = 0 AS is_current,
                  CAST(CASE WHEN warehouse_id % 5 = 0 THEN 1 ELSE 7 END AS INTEGER)
                      AS record_version
           FROM src_warehouses"""
    ),
    "source_defaults_shipments": _with(
        """SELECT shipment_id,
                  CASE WHEN shipment_id % 5 = 0 THEN false ELSE is_late END AS is_late
           FROM src_shipments"""
    ),
    "source_defaults_inventory": _with(
        """SELECT inventory_id,
                  CASE WHEN product_id % 3 = 0 THEN '2024-01-01' ELSE '2020-05-01' END
                      AS effective_start_date,
                  '9999-12-31' AS effective_end_date, product_id % 4 = 0 AS is_current,
                  CAST(CASE WHEN warehouse_id % 5 = 0 THEN 1 ELSE 7 END AS INTEGER)
                      AS record_version,
                  CASE WHEN warehouse_id % 2 = 0 THEN '2024-01-01 06:00:00'
                       ELSE '2020-05-01 12:00:00' END AS created_timestamp,
                  '2024-01-01 06:00:00' AS updated_timestamp
           FROM src_inventory"""
    ),
    "join_customers": _cast(
        "order_id, order_date:VARCHAR, customer_id, customer_name",
        "src_orders JOIN src_customers USING (customer_id)",
    ),
    "join_items": _cast(
        "order_id, customer_id, order_date:VARCHAR, product_id, line_number, quantity,"
        " price:DOUBLE",
        "src_orders JOIN src_customers USING (customer_id) JOIN src_items USING (order_id)",
    ),
    "join_products": _cast(
        "order_id, line_number, quantity, product_id, product_name, supplier_id",
        "src_items JOIN src_products USING (product_id)",
    ),
    "join_categories": _cast(
        "category_id, product_id, product_name, supplier_id, category_name",
        "src_products JOIN src_categories USING (category_id)",
    ),
    "join_suppliers": _cast(
        "supplier_id, category_id, product_id, product_name, category_name, supplier_name",
        "src_products JOIN src_categories USING (category_id)"
        " JOIN src_suppliers USING (supplier_id)",
    ),
    "join_shipments": _cast(
        f"order_id, customer_id, order_date:VARCHAR, shipment_id, warehouse_id, {DATES},"
        " shipping_cost:DOUBLE, delivery_time_days, is_late, quality_rating:DOUBLE,"
        " delivery_performance_score:DOUBLE",
        "src_orders LEFT JOIN src_shipments USING (order_id)",
    ),
    "join_warehouses": _cast(
        f"shipment_id, order_id, {DATES}, shipping_cost:DOUBLE, delivery_time_days, is_late,"
        " quality_rating:DOUBLE, delivery_performance_score:DOUBLE, warehouse_key,"
        " warehouse_name, warehouse_region",
        "src_shipments LEFT JOIN (SELECT warehouse_id, warehouse_id AS warehouse_key,"
        " warehouse_name, region AS warehouse_region FROM src_warehouses) USING (warehouse_id)",
    ),
    "join_inventory": _with(
        """SELECT i.order_id, i.product_id, i.line_number, i.quantity,
                  CAST(i.price AS DOUBLE) AS price, d.warehouse_id AS warehouse_key,
                  v.inventory_id, v.current_stock, v.stock_status
           FROM src_items i JOIN src_orders o ON o.order_id = i.order_id
           LEFT JOIN src_shipments d ON d.order_id = i.order_id
           LEFT JOIN src_inventory v
                  ON v.product_id = i.product_id AND v.warehouse_id = d.warehouse_id"""
    ),
}

# ------------------------------------------------------------ projections

_BASE_COLUMNS = (
    "order_key, customer_key, product_key, supplier_key, warehouse_key, category_key,"
    f" order_date:VARCHAR, {DATES}, customer_name, product_name, category_name, supplier_name,"
    " order_quantity, unit_price:DOUBLE, order_value:DOUBLE, delivery_time_days,"
    " is_late_delivery, shipping_cost:DOUBLE, delivery_performance_score:DOUBLE,"
    " quality_rating:DOUBLE, current_stock_level, reorder_point, stock_out_risk_score:DOUBLE,"
    " days_of_supply, movement_velocity, stock_status, warehouse_name, warehouse_region,"
    " line_number, shipment_id, inventory_id"
)
ORACLE_SQL |= {
    "fact_base": _cast(_BASE_COLUMNS, "base"),
    "supply_chain_risk": _cast(
        f"{LINE}, stock_out_risk_score:DOUBLE, is_late_delivery, supply_chain_risk_score:DOUBLE",
        "derived",
    ),
    "turnover_category": _cast(
        f"{LINE}, movement_velocity, inventory_turnover_category", "derived"
    ),
    "landed_cost": _cast(
        f"{LINE}, order_value:DOUBLE, shipping_cost:DOUBLE, total_supply_chain_cost:DOUBLE",
        "derived",
    ),
    "order_calendar": _cast(
        f"{LINE}, order_date:VARCHAR, order_year, order_month, order_day", "derived"
    ),
}

# ---------------------------------------------------------------- quality

_MEASURES = (
    "delivery_time_days, shipping_cost:DOUBLE, current_stock_level, stock_out_risk_score:DOUBLE,"
    " delivery_performance_score:DOUBLE, quality_rating:DOUBLE"
)
_CRITICAL = ["order_key", "customer_key", "product_key", "order_date", "order_quantity"]
_UNIQUE = {
    "customers": "customer_id",
    "orders": "order_id",
    "products": "product_id",
    "categories": "category_id",
    "suppliers": "supplier_id",
    "inventory": "inventory_id",
    "shipments": "shipment_id",
    "warehouses": "warehouse_id",
    "order_items": "order_id, line_number",
}
_LOST_ITEM = "CASE WHEN line_number = 5 AND order_id % 9 = 0 THEN -1 - product_id ELSE product_id END"
_REFERENCES = [
    ("orders", "customer_id", "customer_id", "customers"),
    ("order_items", "order_id", "order_id", "orders"),
    ("order_items", "product_id", _LOST_ITEM, "products"),
    ("products", "category_id", "category_id", "categories"),
    ("products", "supplier_id", "supplier_id", "suppliers"),
    ("inventory", "warehouse_id", "warehouse_id", "warehouses"),
    ("inventory", "product_id", "product_id", "products"),
    ("shipments", "order_id", "order_id", "orders"),
    ("shipments", "supplier_id", "supplier_id", "suppliers"),
    ("shipments", "warehouse_id", "order_id % 27", "warehouses"),
]
_PARENT_KEYS = {name: key for name, key in _UNIQUE.items() if name != "order_items"}
_LIMITS = [
    ("products", "product_name", 9),
    ("warehouses", "warehouse_name", 8),
    ("warehouses", "warehouse_type", 11),
    ("warehouses", "region", 6),
    ("warehouses", "city", 8),
    ("inventory", "stock_status", 7),
    ("inventory", "movement_velocity", 5),
]

_LONG_NAMES = [
    ("suppliers", "supplier_name", "S", 95, "supplier_id % 10", 100),
    ("suppliers", "supplier_email", "e", 97, "supplier_id % 7", 100),
    ("suppliers", "contact_person", "c", 99, "supplier_id % 3", 100),
    ("suppliers", "phone", "1", 18, "supplier_id % 5", 20),
    ("warehouses", "state", "s", 49, "warehouse_id % 3", 50),
    ("warehouses", "country", "c", 48, "warehouse_id % 4", 50),
    ("warehouses", "manager_name", "m", 98, "warehouse_id % 5", 100),
    ("warehouses", "phone", "1", 19, "warehouse_id % 3", 20),
    ("warehouses", "email", "e", 99, "warehouse_id % 4", 100),
    ("warehouses", "automation_level", "a", 17, "warehouse_id % 6", 20),
    ("shipments", "shipment_status", "s", 18, "order_id % 4", 20),
    ("shipments", "tracking_number", "t", 47, "order_id % 6", 50),
    ("shipments", "carrier_name", "c", 98, "order_id % 5", 100),
    ("shipments", "delay_reason", "d", 196, "order_id % 7", 200),
]


def _shown_key(keys: str) -> str:
    return " || ',' || ".join(f"'\"{k}\":' || {k}" for k in keys.split(", "))


ORACLE_SQL |= {
    "dq_declared_lengths": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS source_name, '{column}' AS column_name,"
            f" repeat('{letter}', CAST({length} + {more} AS INTEGER)) AS value,"
            f" CAST({limit} AS INTEGER) AS max_length, count(*) AS row_count"
            f" FROM {_NAMES[name]} WHERE {length} + {more} > {limit} GROUP BY ALL"
            for name, column, letter, length, more, limit in _LONG_NAMES
        )
    ),
    "dq_null_profile": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM damaged"
            for c in _CRITICAL
        )
    ),
    "dq_valid_lines": _cast(
        f"{LINE}, order_value:DOUBLE",
        "damaged",
        "WHERE order_quantity > 0 AND unit_price > 0 AND order_value > 0",
    ),
    "dq_fill_defaults": _cast(
        f"{LINE}, {_MEASURES}", f"(SELECT * REPLACE ({_FILLED}) FROM damaged)"
    ),
    "dq_clamp_scores": _with(
        f"""SELECT order_key, product_key, line_number, order_quantity,
                   CAST(unit_price AS DOUBLE) AS unit_price,
                   CAST({_clamped('delivery_performance_score')} AS DOUBLE)
                       AS delivery_performance_score,
                   CAST({_clamped('stock_out_risk_score')} AS DOUBLE) AS stock_out_risk_score
            FROM damaged"""
    ),
    "fact_clean": _cast(
        f"{LINE}, order_value:DOUBLE, {_MEASURES}, supply_chain_risk_score:DOUBLE,"
        " inventory_turnover_category, total_supply_chain_cost:DOUBLE, order_year, order_month,"
        " order_day",
        "damaged_fact",
    ),
    "dq_pk_violations": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS source_name,"
            f" '{{' || {_shown_key(key)} || '}}' AS key_value,"
            f" count(*) AS row_count FROM {_NAMES[name]} GROUP BY {key} HAVING count(*) > 1"
            for name, key in _UNIQUE.items()
        )
    ),
    "dq_fk_orphans": _with(
        " UNION ALL ".join(
            f"SELECT '{child}.{column}' AS rule, CAST({value} AS BIGINT) AS key_value,"
            f" count(*) AS row_count FROM {_NAMES[child]} c WHERE NOT EXISTS (SELECT 1 FROM"
            f" {_NAMES[parent]} q WHERE q.{_PARENT_KEYS[parent]} = {value.replace('order_id', 'c.order_id').replace('product_id', 'c.product_id') if ' ' in value else 'c.' + value})"
            " GROUP BY ALL"
            for child, column, value, parent in _REFERENCES
        )
    ),
    "dq_length_violations": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS source_name, '{column}' AS column_name, {column} AS value,"
            f" CAST({limit} AS INTEGER) AS max_length, count(*) AS row_count"
            f" FROM {_NAMES[name]} WHERE length({column}) > {limit} GROUP BY ALL"
            for name, column, limit in _LIMITS
        )
    ),
}

# ---------------------------------------------------------------- windows


def _window(key: str, column: str, needs: str = "") -> str:
    added = [key, "order_date:VARCHAR", needs, column]
    names = ", ".join(c for c in added if c and c not in LINE)
    return _cast(
        f"{LINE}, {names}",
        f"(SELECT *, {HISTORIES[column]} AS {column} FROM base)",
    )


ORACLE_SQL |= {
    "win_customer_sequence": _window("customer_key", "customer_order_sequence"),
    "win_customer_rank": _window("customer_key", "customer_total_orders"),
    "win_customer_running_value": _window(
        "customer_key", "customer_cumulative_value", "order_value:DOUBLE"
    ),
    "win_supplier_sequence": _window("supplier_key", "supplier_order_sequence"),
    "win_supplier_running_delivery": _window(
        "supplier_key", "supplier_avg_delivery_time", "delivery_time_days"
    ),
    "win_supplier_running_late_rate": _window(
        "supplier_key", "supplier_late_delivery_rate", "is_late_delivery"
    ),
    "win_product_sequence": _window("product_key", "product_order_sequence"),
    "win_product_running_demand": _window("product_key", "product_demand_trend"),
    "fact_enhanced": _table("supply_chain_fact", "enhanced").replace(
        "CAST(product_demand_trend AS DOUBLE)", "CAST(product_demand_trend AS BIGINT)"
    ),
}

for _name, _source in (
    ("fact_full", "full_fact"), ("fact_fanout", "fan_enhanced"), ("fact_copies", "copied_enhanced")
):
    ORACLE_SQL[_name] = _table("supply_chain_fact", _source).replace(
        "CAST(product_demand_trend AS DOUBLE)", "CAST(product_demand_trend AS BIGINT)"
    )

# The published table, with its declared types.
ORACLE_SQL["fact_published"] = _table("supply_chain_fact", "full_fact")

# Keys are spread over tasks in other ways, the results are the same.
for _name in ("fact_base", "fact_enhanced"):
    ORACLE_SQL[f"{_name}_spread"] = ORACLE_SQL[_name]

# ------------------------------------------------------------- marts, KPIs

_TEAM = "supplier_key, supplier_name, warehouse_region, order_year, order_month"
_STORE = (
    "product_key, product_name, category_name, warehouse_key, warehouse_name, order_year,"
    " order_month"
)
_FINANCE = "supplier_key, supplier_name, category_name, order_year, order_month"

ORACLE_SQL |= {
    "mart_supply_chain_team": _table("supply_chain_team_metrics", "team"),
    "mart_store_manager": _table("store_manager_metrics", "store"),
    "mart_finance_team": _table("finance_team_metrics", "finance"),
    "supplier_scorecard": _table("supplier_scorecard", "scorecard"),
    "inventory_turnover": _with(
        f"""SELECT category_name,
                   CAST(sum(order_value) AS DOUBLE)
                       / NULLIF({_mean('current_stock_level')}, 0) AS inventory_turnover_ratio
            FROM fact GROUP BY ALL"""
    ),
    "perfect_order_rate": _with(
        """SELECT perfect_lines, total_orders,
                  CAST(perfect_lines AS DOUBLE) / NULLIF(total_orders, 0) AS perfect_order_rate
           FROM (SELECT count(*) FILTER (WHERE NOT is_late_delivery AND quality_rating >= 4.0
                                         AND stock_status = 'HEALTHY') AS perfect_lines,
                        count(DISTINCT order_key) AS total_orders FROM fact)"""
    ),
    "run_summary": _with(
        f"""SELECT count(*) AS total_records, CAST(sum(order_value) AS DOUBLE) AS total_revenue,
                   {_mean('delivery_time_days')} AS avg_delivery_time,
                   {_LATE_RATE} AS late_shipment_rate
            FROM fact"""
    ),
    "table_counts": _counts(
        "table_name",
        {
            "supply_chain_fact": "fact",
            "customer_dim": "first_customers",
            "supplier_dim": "src_suppliers",
            "warehouse_dim": "src_warehouses",
            "supply_chain_team_metrics": "team",
            "store_manager_metrics": "store",
            "finance_team_metrics": "finance",
            "perfect_order_rate": "(SELECT count(*) FROM fact)",
            "inventory_turnover": "(SELECT DISTINCT category_name FROM fact)",
            "supplier_scorecard": "scorecard",
        },
    ),
    "band_performance": _cast(
        f"{_TEAM}, avg_delivery_performance, performance_category", "team"
    ),
    "band_stock_health": _cast(f"{_STORE}, avg_stock_out_risk, stock_health_status", "store"),
    "band_velocity": _cast(
        f"{_STORE}, total_demand:DOUBLE, product_velocity_classification", "store"
    ),
    "band_spend_tier": _cast(
        f"{_FINANCE}, total_purchase_value:DOUBLE, supplier_spend_tier", "finance"
    ),
    "band_supplier_grade": _cast(
        "supplier_key, overall_supplier_score, supplier_grade", "graded"
    ),
    "cost_efficiency": _cast(
        f"{_FINANCE}, total_purchase_value:DOUBLE, total_supply_chain_cost:DOUBLE,"
        " cost_efficiency_ratio",
        "finance",
    ),
}

# ---------------------------------------------------------- reports, views

_YEAR = "WHERE order_year = 1998"
_MONTH = "WHERE order_year = 1998 AND order_month = 1"
_PERIOD = "order_year, order_month"
_BY_TEAM = f"supplier_key, warehouse_region, {_PERIOD}"
# NULL warehouses come first, as Spark sorts them.
_BY_STORE = f"product_key, warehouse_key NULLS FIRST, product_name, category_name, {_PERIOD}"
_BY_FINANCE = f"supplier_key, category_name, {_PERIOD}"
_BY_LINE = (
    "order_key, product_key, order_quantity, unit_price, warehouse_key NULLS FIRST,"
    f" current_stock_level, stock_out_risk_score, movement_velocity, stock_status, {_PERIOD}"
)


def _best(by: str, keys: str, rows: int) -> str:
    return f"ORDER BY {by} DESC, {keys} LIMIT {rows}"


ORACLE_SQL |= {
    "report_delivery_by_supplier": _with(
        f"""SELECT supplier_name, warehouse_region, avg_delivery_time, late_shipment_rate,
                   performance_category, avg_supply_chain_risk
            FROM team {_YEAR} {_best('avg_delivery_time', _BY_TEAM, 10)}"""
    ),
    "report_inventory_movement": _with(
        f"""SELECT product_name, warehouse_name, avg_stock_level, avg_stock_out_risk,
                   product_velocity_classification, stock_health_status,
                   CAST(total_demand AS DOUBLE) AS total_demand,
                   CAST(total_revenue AS DOUBLE) AS total_revenue
            FROM (SELECT * FROM store {_YEAR} {_best('total_demand', _BY_STORE, 15)})"""
    ),
    "report_supplier_payment": _with(
        f"""SELECT supplier_name, supplier_spend_tier,
                   CAST(total_purchase_value AS DOUBLE) AS total_purchase_value,
                   CAST(total_shipping_cost AS DOUBLE) AS total_shipping_cost,
                   CAST(total_supply_chain_cost AS DOUBLE) AS total_supply_chain_cost,
                   cost_efficiency_ratio, avg_payment_cycle_days
            FROM (SELECT * FROM finance {_YEAR}
                  {_best('total_purchase_value', _BY_FINANCE, 10)})"""
    ),
    "report_scorecard_raw": _with(
        f"""SELECT supplier_name, delivery_score, quality_score, availability_score,
                   overall_supplier_score, supplier_grade
            FROM graded {_best('overall_supplier_score', 'supplier_key, supplier_name', 10)}"""
    ),
    "report_high_risk_raw": _with(
        f"""SELECT product_name, supplier_name, warehouse_name, current_stock_level,
                   CAST(stock_out_risk_score AS DOUBLE) AS stock_out_risk_score,
                   CAST(supply_chain_risk_score AS DOUBLE) AS supply_chain_risk_score,
                   movement_velocity, stock_status
            FROM (SELECT * FROM fact WHERE supply_chain_risk_score > 0.7
                  {_best('supply_chain_risk_score', _BY_LINE, 20)})"""
    ),
    "report_supplier_performance": _with(
        f"""SELECT supplier_name, warehouse_region,
                   round(avg_delivery_time, 2) AS avg_delivery_days,
                   round(late_shipment_rate * 100, 2) AS late_shipment_percent,
                   performance_category,
                   round(avg_supply_chain_risk * 100, 2) AS risk_score_percent
            FROM team {_MONTH} {_best('avg_delivery_time', _BY_TEAM, 10)}"""
    ),
    "report_stock_health": _with(
        f"""SELECT product_name, category_name, warehouse_name,
                   round(avg_stock_level, 0) AS avg_stock,
                   round(avg_stock_out_risk * 100, 2) AS stockout_risk_percent,
                   product_velocity_classification, stock_health_status,
                   round(CAST(total_demand AS DOUBLE), 0) AS total_demand,
                   round(CAST(total_revenue AS DOUBLE), 2) AS total_revenue
            FROM (SELECT * FROM store {_MONTH} {_best('total_demand', _BY_STORE, 15)})"""
    ),
    "report_supplier_spend": _with(
        f"""SELECT supplier_name, category_name, supplier_spend_tier,
                   round(CAST(total_purchase_value AS DOUBLE), 2) AS total_spend,
                   round(CAST(total_shipping_cost AS DOUBLE), 2) AS shipping_cost,
                   round(CAST(total_supply_chain_cost AS DOUBLE), 2) AS total_cost,
                   round(cost_efficiency_ratio, 2) AS cost_efficiency,
                   round(avg_payment_cycle_days, 1) AS avg_payment_days
            FROM finance {_MONTH} {_best('total_spend', _BY_FINANCE, 10)}"""
    ),
    "report_scorecard": _with(
        f"""SELECT supplier_name, round(delivery_score * 100, 2) AS delivery_score,
                   round(quality_score * 20, 2) AS quality_score,
                   round(availability_score * 100, 2) AS availability_score,
                   round(overall_supplier_score, 2) AS overall_score, supplier_grade
            FROM (SELECT * FROM graded
                  {_best('overall_supplier_score', 'supplier_key, supplier_name', 10)})"""
    ),
    "report_high_risk": _with(
        f"""SELECT product_name, supplier_name, warehouse_name, current_stock_level,
                   CAST(round(stock_out_risk_score * 100, 2) AS DOUBLE) AS stockout_risk_percent,
                   CAST(round(supply_chain_risk_score * 100, 2) AS DOUBLE)
                       AS overall_risk_percent,
                   movement_velocity, stock_status
            FROM (SELECT * FROM fact WHERE supply_chain_risk_score > 0.7
                  {_best('supply_chain_risk_score', _BY_LINE, 20)})"""
    ),
    "report_monthly_trend": _with(
        """SELECT order_year, order_month, total_orders, round(total_revenue, 2) AS total_revenue,
                  round(avg_delivery_time, 2) AS avg_delivery_days,
                  round(late_delivery_rate * 100, 2) AS late_delivery_percent
           FROM monthly ORDER BY order_year, order_month"""
    ),
    "view_monthly_performance": _with("SELECT * FROM monthly ORDER BY order_year, order_month"),
}
# The same measures, grouped by supplier as well.
ORACLE_SQL["view_supplier_trends"] = _with(
    "SELECT supplier_key, supplier_name, " + PARTS["monthly"].strip().removeprefix("SELECT")
)

# ------------------------------------------------------------- dimensions


def _first_version(columns: str, source: str) -> str:
    return _with(
        f"""SELECT DISTINCT {columns}, '2024-01-01' AS effective_start_date,
                   '9999-12-31' AS effective_end_date, true AS is_current,
                   CAST(1 AS INTEGER) AS record_version,
                   '2024-01-01 06:00:00' AS created_timestamp,
                   '2024-01-01 06:00:00' AS updated_timestamp
            FROM {source}"""
    )


ORACLE_SQL |= {
    "scd2_initial_customer": _first_version(
        "customer_id, customer_name, customer_email", "src_customers"
    ),
    "scd2_initial_supplier": _first_version("supplier_id, supplier_name", "src_suppliers"),
    "scd2_initial_warehouse": _first_version(
        "warehouse_id, warehouse_name, warehouse_type, region, city", "src_warehouses"
    ),
    "scd2_merge": _with("SELECT * FROM merged"),
    "scd2_published": _with("SELECT * FROM merged"),
    "scd2_as_of": _with(
        """SELECT * FROM merged
           WHERE '2024-02-01' BETWEEN effective_start_date AND effective_end_date"""
    ),
    "scd2_current": _with("SELECT * FROM merged WHERE is_current"),
}
