"""The order-line fact: joins of the nine sources and the columns derived per line."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.functions.banding import turnover_class
from depotlake.operators.skew import HeavyKeys, SkewPolicy, heavy_keys, look_up, numbered
from depotlake.sources.registry import Sources

POLICY = SkewPolicy()

# Values of a line whose order was not shipped, or whose item is not stocked, as SQL literals.
LINE_DEFAULTS: dict[str, str] = {
    "delivery_time_days": "0",
    "is_late_delivery": "false",
    "shipping_cost": "0.00BD",
    "delivery_performance_score": "1.00BD",
    "quality_rating": "5.0BD",
    "current_stock_level": "0",
    "reorder_point": "0",
    "stock_out_risk_score": "0.00BD",
    "days_of_supply": "0",
    "movement_velocity": "'UNKNOWN'",
    "stock_status": "'UNKNOWN'",
    "warehouse_name": "'Unknown'",
    "warehouse_region": "'Unknown'",
}

RISK_WEIGHT = Decimal("0.4")
# A late line adds its risk of 0.6, weighted by 0.6.
LATE_RISK = Decimal("0.6")
LATE_WEIGHT = Decimal("0.6")


# ------------------------------------------------------------------- joins


def _heavy(
    sources: Sources, name: str, columns: list[str], policy: SkewPolicy
) -> Callable[[], HeavyKeys]:
    """The heavy keys of a source, looked for on the first call."""
    return cache(lambda: heavy_keys(sources.core(name), columns, policy, sources.rows(name)[name]))


def orders_with_customers(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    rows = sources.rows("orders", "customers")["customers"]
    return look_up(sources.core("orders"), sources.core("customers"), ["customer_id"], rows, policy)


def items_with_orders(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """Order items with their order and customer; items rooted, so big rows move once."""
    rows = sources.rows("order_items", "orders")["orders"]
    right = orders_with_customers(sources, policy)
    return look_up(sources.core("order_items"), right, ["order_id"], rows, policy)


def items_with_products(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    rows = sources.rows("order_items", "products")["products"]
    return look_up(
        sources.core("order_items"), sources.core("products"), ["product_id"], rows, policy
    )


def products_with_categories(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    rows = sources.rows("products", "categories")["categories"]
    return look_up(
        sources.core("products"), sources.core("categories"), ["category_id"], rows, policy
    )


def products_with_suppliers(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """Products with their own supplier, which need not be the one who shipped the order."""
    rows = sources.rows("products", "suppliers")["suppliers"]
    return look_up(
        products_with_categories(sources, policy),
        sources.core("suppliers").select("supplier_id", "supplier_name"),
        ["supplier_id"],
        rows,
        policy,
    )


def orders_with_shipments(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    shipped = _heavy(sources, "shipments", ["order_id"], policy)
    shipments = numbered(sources.core("shipments"), "__shipment", shipped)
    return look_up(
        sources.core("orders"),
        shipments.drop("supplier_id"),
        ["order_id"],
        sources.rows("orders", "shipments")["shipments"],
        policy,
        "left",
        right_heavy=shipped,
    ).drop("__shipment")


def shipments_with_warehouses(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """Shipments with their warehouse; an unknown warehouse leaves ``warehouse_key`` NULL."""
    return _with_warehouses(sources.core("shipments"), sources, policy)


def _with_warehouses(shipments: DataFrame, sources: Sources, policy: SkewPolicy) -> DataFrame:
    warehouses = sources.core("warehouses").selectExpr(
        "warehouse_id",
        "warehouse_id AS warehouse_key",
        "warehouse_name",
        "region AS warehouse_region",
    )
    return look_up(
        shipments.drop("supplier_id"),
        warehouses,
        ["warehouse_id"],
        sources.rows("shipments", "warehouses")["warehouses"],
        policy,
        "left",
    ).drop("warehouse_id")


def order_lines(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """Nominally one row per order item; further shipments of the order, or stock records of the
    item in the warehouse, multiply it.

    On big data the items are shuffled three times: by product, by order for two joins, and by
    (product, warehouse) for the stock. Sides that are counted to be small are broadcast instead.
    Adaptive execution splits the items of a frequent product. The two joins by order share a
    shuffle, so orders with very many items are spread here, as are shipments and stock records
    of one key. Row counts, and where a source is large the search for such keys, run at once.
    """
    rows = sources.rows(*sources)
    by_order = _heavy(sources, "order_items", ["order_id"], policy)
    shipped = _heavy(sources, "shipments", ["order_id"], policy)
    stocked = _heavy(sources, "inventory", ["product_id", "warehouse_id"], policy)

    items = numbered(sources.core("order_items"), "__item", by_order)
    shipments = numbered(sources.core("shipments"), "__shipment", shipped)
    inventory = numbered(sources.core("inventory"), "__stock", stocked)
    lines = look_up(
        items, products_with_suppliers(sources, policy), ["product_id"], rows["products"], policy
    )
    lines = look_up(
        lines,
        orders_with_customers(sources, policy),
        ["order_id"],
        rows["orders"],
        policy,
        left_heavy=by_order,
    )
    lines = look_up(
        lines,
        _with_warehouses(shipments, sources, policy),
        ["order_id"],
        rows["shipments"],
        policy,
        "left",
        left_heavy=by_order,
        right_heavy=shipped,
    )
    return look_up(
        lines.withColumnRenamed("warehouse_key", "warehouse_id"),
        inventory,
        ["product_id", "warehouse_id"],
        rows["inventory"],
        policy,
        "left",
        right_heavy=stocked,
    ).withColumnRenamed("warehouse_id", "warehouse_key")


# -------------------------------------------------------------- projections


def _known(name: str, column: str | None = None) -> str:
    return f"coalesce({column or name}, {LINE_DEFAULTS[name]}) AS {name}"


def fact_base(lines: DataFrame) -> DataFrame:
    """Keys, dates, names, measures and defaults of each joined line.

    ``line_number``, ``shipment_id`` and ``inventory_id`` are no part of the fact; they order
    lines of equal date.
    """
    return lines.selectExpr(
        "order_id AS order_key",
        "customer_id AS customer_key",
        "product_id AS product_key",
        "supplier_id AS supplier_key",
        "warehouse_key",
        "category_id AS category_key",
        "order_date",
        "shipment_date",
        "expected_delivery_date",
        "actual_delivery_date",
        "customer_name",
        "product_name",
        "category_name",
        "supplier_name",
        "quantity AS order_quantity",
        "price AS unit_price",
        "CAST(quantity * price AS decimal(21,2)) AS order_value",
        _known("delivery_time_days"),
        _known("is_late_delivery", "is_late"),
        _known("shipping_cost"),
        _known("delivery_performance_score"),
        _known("quality_rating"),
        _known("current_stock_level", "current_stock"),
        _known("reorder_point"),
        _known("stock_out_risk_score"),
        _known("days_of_supply"),
        _known("movement_velocity"),
        _known("stock_status"),
        _known("warehouse_name"),
        _known("warehouse_region"),
        "line_number",
        "shipment_id",
        "inventory_id",
    )


def with_risk_score(base: DataFrame) -> DataFrame:
    late_risk = F.lit(LATE_RISK) * F.lit(LATE_WEIGHT)
    late = F.when(F.col("is_late_delivery"), late_risk).otherwise(F.lit(Decimal("0.00")))
    score = F.col("stock_out_risk_score") * F.lit(RISK_WEIGHT) + late
    return base.withColumn("supply_chain_risk_score", score.cast("decimal(6,3)"))


def with_turnover_category(base: DataFrame) -> DataFrame:
    return base.withColumn(
        "inventory_turnover_category", turnover_class(F.col("movement_velocity"))
    )


def with_landed_cost(base: DataFrame) -> DataFrame:
    cost = F.col("order_value") + F.col("shipping_cost")
    return base.withColumn("total_supply_chain_cost", cost.cast("decimal(22,2)"))


def with_calendar(base: DataFrame) -> DataFrame:
    return base.withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_day": F.dayofmonth("order_date"),
        }
    )


def with_derived(base: DataFrame) -> DataFrame:
    """All columns that follow from the line alone, without its history."""
    return (
        base.transform(with_risk_score)
        .transform(with_turnover_category)
        .transform(with_landed_cost)
        .transform(with_calendar)
    )
