"""Reading source tables from a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import lit

from depotlake.operators.staging import stage
from depotlake.schemas import SOURCES
from depotlake.sources.registry import Sources

FETCH_SIZE = 10_000
PARTITIONS = 8

# Table behind each source, and the indexed number its scan is divided by.
SOURCE_TABLES: dict[str, tuple[str, str]] = {
    "customers": ("Customers", "customer_id"),
    "orders": ("Orders", "order_id"),
    "order_items": ("Order_Items", "order_id"),
    "products": ("Products", "product_id"),
    "categories": ("Categories", "category_id"),
    "suppliers": ("Suppliers", "supplier_id"),
    "inventory": ("Inventory", "inventory_id"),
    "shipments": ("Shipments", "shipment_id"),
    "warehouses": ("Warehouses", "warehouse_id"),
}


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    partitions: int = PARTITIONS,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """Scan ``table``; with a partition column, in ``partitions`` parallel range reads.

    ``options`` holds the caller's ``url``, ``driver`` and credentials. The bounds are worked out
    by the database. They only set the stride: rows outside them, and NULLs, are still read.
    """
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", str(fetch_size))
    whole = reader.option("dbtable", table)
    if partition_column is None:
        return whole.load()
    bounds = f"SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}"
    low, high = reader.option("query", bounds).load().first()
    if low is None or low == high:
        return whole.load()
    return (
        whole.option("partitionColumn", partition_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .load()
    )


def jdbc_sources(
    spark: SparkSession,
    options: Mapping[str, str],
    tables: Mapping[str, tuple[str, str]] = SOURCE_TABLES,
    partitions: int = PARTITIONS,
    copy: bool = True,
) -> Sources:
    """All nine sources over JDBC.

    With ``copy``, each is first written to the shared staging folder: the database is read
    once, and a lost executor re-reads files instead of a table that may have moved on.
    """
    frames = {}
    for name in SOURCES:
        table, column = tables[name]
        scan = read_jdbc(spark, options, table, column, partitions)
        scan = scan.toDF(*[c.lower() for c in scan.columns])
        if name == "order_items" and "line_number" not in scan.columns:
            scan = scan.withColumn("line_number", lit(0))
        frames[name] = stage(scan, name) if copy else scan
    return Sources(frames)
