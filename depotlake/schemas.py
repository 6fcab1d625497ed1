"""Column contracts of the nine sources and the eight warehouse tables.

Everything in this module is a fixed value: names, types, keys, lengths and
defaults that readers and writers of the warehouse agree on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# ---------------------------------------------------------------- sources

# Keys are BIGINT: a fact of 100 TB has more orders than INT can number.
SOURCES: dict[str, str] = {
    "customers": "customer_id bigint, customer_name string, customer_email string",
    "orders": "order_id bigint, customer_id bigint, order_date date",
    "order_items": (
        "order_id bigint, product_id bigint, quantity int, price decimal(10,2), line_number int"
    ),
    "products": "product_id bigint, product_name string, category_id int, supplier_id bigint",
    "categories": "category_id int, category_name string",
    "suppliers": (
        "supplier_id bigint, supplier_name string, supplier_status string,"
        " supplier_rating decimal(3,2)"
    ),
    "inventory": (
        "inventory_id bigint, warehouse_id int, product_id bigint, current_stock int,"
        " reorder_point int, stock_status string, days_of_supply int,"
        " stock_out_risk_score decimal(3,2), movement_velocity string"
    ),
    "shipments": (
        "shipment_id bigint, order_id bigint, supplier_id bigint, warehouse_id int,"
        " shipment_date date, expected_delivery_date date, actual_delivery_date date,"
        " shipping_cost decimal(10,2), delivery_time_days int, is_late boolean,"
        " quality_rating decimal(2,1), delivery_performance_score decimal(3,2)"
    ),
    "warehouses": (
        "warehouse_id int, warehouse_name string, warehouse_type string, region string, city string"
    ),
}

# Columns that are declared as well, and kept where a source has them.
MORE_COLUMNS: dict[str, str] = {
    "suppliers": "supplier_email string, contact_person string, phone string, address string",
    "inventory": (
        "store_id int, max_stock_level int, last_restock_date date, stock_value decimal(12,2),"
        " last_movement_date date, effective_start_date date, effective_end_date date,"
        " is_current boolean, record_version int, created_timestamp timestamp,"
        " updated_timestamp timestamp"
    ),
    "shipments": (
        "shipment_status string, tracking_number string, carrier_name string,"
        " weight_kg decimal(8,2), volume_cubic_meters decimal(8,2), delay_reason string,"
        " created_timestamp timestamp, updated_timestamp timestamp"
    ),
    "warehouses": (
        "state string, country string, manager_name string, phone string, email string,"
        " opening_date date, warehouse_size_sqft int, storage_capacity_units int,"
        " current_inventory_level int, employee_count int, automation_level string,"
        " climate_controlled boolean, hazmat_certified boolean, effective_start_date date,"
        " effective_end_date date, is_current boolean, record_version int"
    ),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "categories": ["category_id"],
    "suppliers": ["supplier_id"],
    "inventory": ["inventory_id"],
    "shipments": ["shipment_id"],
    "warehouses": ["warehouse_id"],
}

# child source, child column, parent source, parent column
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("products", "category_id", "categories", "category_id"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inventory", "warehouse_id", "warehouses", "warehouse_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("shipments", "order_id", "orders", "order_id"),
    ("shipments", "supplier_id", "suppliers", "supplier_id"),
    ("shipments", "warehouse_id", "warehouses", "warehouse_id"),
]

# Declared VARCHAR lengths.
LENGTH_LIMITS: dict[str, dict[str, int]] = {
    "suppliers": {
        "supplier_name": 100,
        "supplier_email": 100,
        "supplier_status": 20,
        "contact_person": 100,
        "phone": 20,
    },
    "categories": {"category_name": 100},
    "warehouses": {
        "warehouse_name": 100,
        "warehouse_type": 50,
        "region": 50,
        "city": 100,
        "state": 50,
        "country": 50,
        "manager_name": 100,
        "phone": 20,
        "email": 100,
        "automation_level": 20,
    },
    "inventory": {"stock_status": 20, "movement_velocity": 20},
    "shipments": {
        "shipment_status": 20,
        "tracking_number": 50,
        "carrier_name": 100,
        "delay_reason": 200,
    },
}

# Declared column defaults, as SQL literals.
COLUMN_DEFAULTS: dict[str, dict[str, str]] = {
    "suppliers": {"supplier_status": "'ACTIVE'", "supplier_rating": "5.00"},
    "warehouses": {
        "climate_controlled": "false",
        "hazmat_certified": "false",
        "effective_start_date": "date'2024-01-01'",
        "effective_end_date": "date'9999-12-31'",
        "is_current": "true",
        "record_version": "1",
    },
    "inventory": {
        "effective_start_date": "date'2024-01-01'",
        "effective_end_date": "date'9999-12-31'",
        "is_current": "true",
        "record_version": "1",
    },
    "shipments": {"is_late": "false"},
}

# Audit columns whose declared default is the load time.
LOAD_TIME_DEFAULTS: dict[str, list[str]] = {
    "inventory": ["created_timestamp", "updated_timestamp"],
    "shipments": ["created_timestamp", "updated_timestamp"],
}

# --------------------------------------------------------------- warehouse

VERSION_COLUMNS = (
    "effective_start_date date, effective_end_date date, is_current boolean, record_version int,"
    " created_timestamp timestamp, updated_timestamp timestamp"
)

# Keys and per-key sequence numbers are BIGINT, all other types as declared.
TABLES: dict[str, str] = {
    "supply_chain_fact": (
        "order_key bigint, customer_key bigint, product_key bigint, supplier_key bigint,"
        " warehouse_key int, category_key int, order_date date, shipment_date date,"
        " expected_delivery_date date, actual_delivery_date date, customer_name string,"
        " product_name string, category_name string, supplier_name string, order_quantity int,"
        " unit_price double, order_value double, delivery_time_days int,"
        " is_late_delivery boolean, shipping_cost double, delivery_performance_score double,"
        " quality_rating double, current_stock_level int, reorder_point int,"
        " stock_out_risk_score double, days_of_supply int, movement_velocity string,"
        " stock_status string, warehouse_name string, warehouse_region string,"
        " customer_order_sequence bigint, customer_total_orders bigint,"
        " customer_cumulative_value double, supplier_order_sequence bigint,"
        " supplier_avg_delivery_time double, supplier_late_delivery_rate double,"
        " product_order_sequence bigint, product_demand_trend double,"
        " supply_chain_risk_score double, inventory_turnover_category string,"
        " total_supply_chain_cost double, order_year int, order_month int, order_day int"
    ),
    "customer_dim": (
        "customer_id bigint, customer_name string, customer_email string, " + VERSION_COLUMNS
    ),
    "supplier_dim": "supplier_id bigint, supplier_name string, " + VERSION_COLUMNS,
    "warehouse_dim": (
        "warehouse_id int, warehouse_name string, warehouse_type string, region string,"
        " city string, " + VERSION_COLUMNS
    ),
    "supply_chain_team_metrics": (
        "supplier_key bigint, supplier_name string, warehouse_region string, order_year int,"
        " order_month int, avg_delivery_time double, late_shipment_rate double,"
        " avg_delivery_performance double, avg_quality_rating double,"
        " total_shipping_cost double, avg_supply_chain_risk double, performance_category string"
    ),
    "store_manager_metrics": (
        "product_key bigint, product_name string, category_name string, warehouse_key int,"
        " warehouse_name string, order_year int, order_month int, avg_stock_level double,"
        " avg_stock_out_risk double, total_demand double, avg_days_of_supply double,"
        " total_revenue double, stock_health_status string,"
        " product_velocity_classification string"
    ),
    "finance_team_metrics": (
        "supplier_key bigint, supplier_name string, category_name string, order_year int,"
        " order_month int, total_purchase_value double, avg_unit_price double,"
        " total_shipping_cost double, total_supply_chain_cost double,"
        " avg_payment_cycle_days double, total_units_purchased double,"
        " supplier_spend_tier string, cost_efficiency_ratio double"
    ),
    "supplier_scorecard": (
        "supplier_key bigint, supplier_name string, delivery_score double,"
        " quality_score double, availability_score double, overall_supplier_score double"
    ),
}

# Folder of each table under the warehouse root.
TABLE_FOLDERS: dict[str, str] = {
    "supply_chain_fact": "fact_table",
    "customer_dim": "customer_dimension",
    "supplier_dim": "supplier_dimension",
    "warehouse_dim": "warehouse_dimension",
    "supply_chain_team_metrics": "supply_chain_metrics",
    "store_manager_metrics": "store_manager_metrics",
    "finance_team_metrics": "finance_metrics",
    "supplier_scorecard": "supplier_scorecard",
}

# Exact types of the fact's money and score columns while it is being computed.
# Sums of decimals do not depend on the order in which tasks deliver them.
EXACT_TYPES: dict[str, str] = {
    "unit_price": "decimal(10,2)",
    "order_value": "decimal(21,2)",
    "shipping_cost": "decimal(10,2)",
    "delivery_performance_score": "decimal(3,2)",
    "quality_rating": "decimal(2,1)",
    "stock_out_risk_score": "decimal(3,2)",
    "supply_chain_risk_score": "decimal(6,3)",
    "total_supply_chain_cost": "decimal(22,2)",
}


def columns(ddl: str) -> list[tuple[str, str]]:
    """Names and types of a column list."""
    return re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast ``df`` to the columns, order and types of ``ddl``."""
    return df.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in columns(ddl)])


def to_table(df: DataFrame, table: str) -> DataFrame:
    return conform(df, TABLES[table])


def exact_fact(fact: DataFrame) -> DataFrame:
    """Turn the stored doubles of the fact back into the decimals they were cast from."""
    exact = {c: f"CAST({c} AS {kind}) AS {c}" for c, kind in EXACT_TYPES.items()}
    return fact.selectExpr(*[exact.get(c, c) for c in fact.columns])
