"""Derives the nine sources from order/part/supplier tables kept as Parquet.

The tables are region, nation, customer, supplier, part, orders and lineitem. Columns they do not
have (deliveries, stock levels) follow from the keys by integer arithmetic, so that every engine
derives the same values.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotlake.sources.registry import Sources

# Columns of the tables read. Naming them saves a look into the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"
    ),
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double",
}


#: Stock records that one task derives from their parts.
TASK_ROWS = 1_000_000


def retail_sources(spark: SparkSession, folder: str) -> Sources:
    @cache
    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")

    @cache
    def supplier_count() -> int:
        return max(table("supplier").count(), 1)  # answered from the Parquet footers

    @cache
    def part_count() -> int:
        return table("part").count()  # likewise

    def customers() -> DataFrame:
        return table("customer").selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "concat(replace(lower(c_name), '#', '.'), '@example.com') AS customer_email",
        )

    def orders() -> DataFrame:
        return table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(o_orderdate AS DATE) AS order_date",
        )

    @cache
    def nation_count() -> int:
        return max(table("nation").count(), 1)  # likewise

    def order_items() -> DataFrame:
        """Lines at the list price of their part; a line of an unknown part has none."""
        prices = table("part").selectExpr(
            "p_partkey AS l_partkey", "CAST(p_retailprice AS DECIMAL(10,2)) AS price"
        )
        return table("lineitem").join(prices, "l_partkey", "left").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "price",
            "l_linenumber AS line_number",
        )

    def categories() -> DataFrame:
        """The part types, numbered in alphabetical order; a handful of rows."""
        kinds = table("part").select(F.col("p_type").alias("category_name")).distinct()
        number = F.row_number().over(Window.orderBy("category_name"))
        return kinds.select(number.alias("category_id"), "category_name")

    def products() -> DataFrame:
        typed = table("part").join(categories(), F.col("p_type").eqNullSafe(F.col("category_name")))
        return typed.selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "category_id",
            f"p_partkey % {supplier_count()} AS supplier_id",
        )

    def suppliers() -> DataFrame:
        return table("supplier").selectExpr(
            "s_suppkey AS supplier_id",
            "s_name AS supplier_name",
            "'ACTIVE' AS supplier_status",
            "CAST((20 + s_suppkey % 31) * 0.1BD AS DECIMAL(3,2)) AS supplier_rating",
        )

    def warehouses() -> DataFrame:
        places = table("nation").join(
            table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return places.selectExpr(
            "n_nationkey AS warehouse_id",
            "n_name AS warehouse_name",
            "CASE n_nationkey % 3 WHEN 0 THEN 'REGIONAL_HUB' WHEN 1 THEN 'FULFILLMENT'"
            " ELSE 'LOCAL_DEPOT' END AS warehouse_type",
            "r_name AS region",
            "n_name AS city",
        )

    return Sources(
        {
            "customers": customers,
            "orders": orders,
            "order_items": order_items,
            "products": products,
            "categories": categories,
            "suppliers": suppliers,
            "inventory": lambda: _inventory(table("part"), nation_count(), part_count()),
            "shipments": lambda: _shipments(table("orders"), supplier_count(), nation_count()),
            "warehouses": warehouses,
        },
        counted_by={"order_items": lambda: table("lineitem"), "products": lambda: table("part")},
    )


def _inventory(part: DataFrame, warehouses: int, parts: int) -> DataFrame:
    """Nine in ten (part, warehouse) pairs; each part row fans out to its own rows.

    There is a warehouse for each nation, and their keys count from 0. Parts take up little of a
    file, so many are dealt out before they fan out: else one task would make all their rows.
    """
    tasks = -(-parts * warehouses // TASK_ROWS)
    if tasks > 1:
        part = part.select("p_partkey").repartition(tasks)
    stocked = part.select(
        F.col("p_partkey").alias("p"),
        F.explode(F.sequence(F.lit(0), F.lit(warehouses - 1))).alias("n"),
    ).filter("(p + n) % 10 <> 0")
    return stocked.selectExpr(
        f"p * {warehouses} + n AS inventory_id",
        "n AS warehouse_id",
        "p AS product_id",
        "CAST((7 * p + 13 * n) % 250 AS INT) AS current_stock",
        "CAST(20 + p % 60 AS INT) AS reorder_point",
        "CASE WHEN (31 * p + 17 * n) % 111 < 60 THEN 'HEALTHY'"
        " WHEN (31 * p + 17 * n) % 111 < 75 THEN 'LOW' ELSE 'CRITICAL' END AS stock_status",
        "CAST((3 * p + n) % 30 AS INT) AS days_of_supply",
        "CAST((31 * p + 17 * n) % 111 * 0.01BD AS DECIMAL(3,2)) AS stock_out_risk_score",
        "CASE p % 3 WHEN 0 THEN 'FAST' WHEN 1 THEN 'MEDIUM' ELSE 'SLOW' END AS movement_velocity",
    )


def _shipments(orders: DataFrame, supplier_count: int, warehouses: int) -> DataFrame:
    """One shipment for every order that is not pending, 2 to 5 days under way."""
    sent = orders.filter("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey AS k",
        "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 3 AS INT)) AS shipped",
        "CAST(2 + o_orderkey * 7 % 4 AS INT) AS days",
    )
    return sent.selectExpr(
        "k AS shipment_id",
        "k AS order_id",
        f"k % {supplier_count} AS supplier_id",
        f"CAST(k % {warehouses} AS INT) AS warehouse_id",
        "shipped AS shipment_date",
        "date_add(shipped, 3) AS expected_delivery_date",
        "date_add(shipped, days) AS actual_delivery_date",
        "CAST((2500 + k % 6000) * 0.01BD AS DECIMAL(10,2)) AS shipping_cost",
        "days AS delivery_time_days",
        "days > 3 AS is_late",
        "CAST((29 + k % 21) * 0.1BD AS DECIMAL(2,1)) AS quality_rating",
        "CAST((52 + k % 55) * 0.01BD AS DECIMAL(3,2)) AS delivery_performance_score",
    )
