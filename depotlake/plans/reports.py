"""The fixed reports. Each takes a warehouse table and returns the rows to show.

Rows of equal rank are ordered by the table's key columns, so a report cut at n rows is the same
on every run. ORDER BY with LIMIT keeps the best n rows per task and sorts only these.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions import BANDS, Bands

HIGH_RISK = 0.7
TEAM_KEYS = ("supplier_key", "warehouse_region")
STORE_KEYS = ("product_key", "warehouse_key", "product_name", "category_name")
FINANCE_KEYS = ("supplier_key", "category_name")
# Lines that agree in all of these look the same in the reports.
LINE_KEYS = (
    "order_key",
    "product_key",
    "order_quantity",
    "unit_price",
    "warehouse_key",
    "current_stock_level",
    "stock_out_risk_score",
    "movement_velocity",
    "stock_status",
)


def _period(df: DataFrame, year: int, month: int | None = None) -> DataFrame:
    df = df.filter(F.col("order_year") == year)
    return df if month is None else df.filter(F.col("order_month") == month)


def _top(df: DataFrame, by: str, keys: tuple[str, ...], rows: int, *columns: Column | str):
    """The ``rows`` greatest by ``by``, then by keys and period."""
    ties = [*keys, *[c for c in ("order_year", "order_month") if c in df.columns]]
    return df.orderBy(F.desc(by), *ties).limit(rows).select(*columns)


def _rounded(column: str, digits: int, name: str, factor: int = 1) -> Column:
    value = F.col(column) if factor == 1 else F.col(column) * factor
    return F.round(value, digits).alias(name)


def supplier_grade(bands: Mapping[str, Bands] = BANDS) -> Column:
    return bands["grade"].label(F.round("overall_supplier_score", 6)).alias("supplier_grade")


# -------------------------------------------------------- raw, by year


def delivery_by_supplier(team: DataFrame, year: int, rows: int = 10) -> DataFrame:
    return _top(
        _period(team, year),
        "avg_delivery_time",
        TEAM_KEYS,
        rows,
        "supplier_name",
        "warehouse_region",
        "avg_delivery_time",
        "late_shipment_rate",
        "performance_category",
        "avg_supply_chain_risk",
    )


def inventory_movement(store: DataFrame, year: int, rows: int = 15) -> DataFrame:
    return _top(
        _period(store, year),
        "total_demand",
        STORE_KEYS,
        rows,
        "product_name",
        "warehouse_name",
        "avg_stock_level",
        "avg_stock_out_risk",
        "product_velocity_classification",
        "stock_health_status",
        "total_demand",
        "total_revenue",
    )


def supplier_payment(finance: DataFrame, year: int, rows: int = 10) -> DataFrame:
    return _top(
        _period(finance, year),
        "total_purchase_value",
        FINANCE_KEYS,
        rows,
        "supplier_name",
        "supplier_spend_tier",
        "total_purchase_value",
        "total_shipping_cost",
        "total_supply_chain_cost",
        "cost_efficiency_ratio",
        "avg_payment_cycle_days",
    )


def scorecard_raw(
    scorecard: DataFrame, rows: int = 10, bands: Mapping[str, Bands] = BANDS
) -> DataFrame:
    return _top(
        scorecard,
        "overall_supplier_score",
        ("supplier_key", "supplier_name"),
        rows,
        "supplier_name",
        "delivery_score",
        "quality_score",
        "availability_score",
        "overall_supplier_score",
        supplier_grade(bands),
    )


def _high_risk(fact: DataFrame, rows: int, above: float, *scores: Column | str) -> DataFrame:
    # Compared as doubles, which the stored fact holds: the filter reaches the Parquet scan.
    risky = fact.filter(F.col("supply_chain_risk_score") > F.lit(above))
    return _top(
        risky,
        "supply_chain_risk_score",
        LINE_KEYS,
        rows,
        "product_name",
        "supplier_name",
        "warehouse_name",
        "current_stock_level",
        *scores,
        "movement_velocity",
        "stock_status",
    )


def high_risk_raw(fact: DataFrame, rows: int = 20, above: float = HIGH_RISK) -> DataFrame:
    return _high_risk(
        fact,
        rows,
        above,
        F.col("stock_out_risk_score").cast("double").alias("stock_out_risk_score"),
        F.col("supply_chain_risk_score").cast("double").alias("supply_chain_risk_score"),
    )


# ---------------------------------------------- rounded, by year and month


def supplier_performance(team: DataFrame, year: int, month: int, rows: int = 10) -> DataFrame:
    return _top(
        _period(team, year, month),
        "avg_delivery_time",
        TEAM_KEYS,
        rows,
        "supplier_name",
        "warehouse_region",
        _rounded("avg_delivery_time", 2, "avg_delivery_days"),
        _rounded("late_shipment_rate", 2, "late_shipment_percent", 100),
        "performance_category",
        _rounded("avg_supply_chain_risk", 2, "risk_score_percent", 100),
    )


def stock_health(store: DataFrame, year: int, month: int, rows: int = 15) -> DataFrame:
    return _top(
        _period(store, year, month),
        "total_demand",
        STORE_KEYS,
        rows,
        "product_name",
        "category_name",
        "warehouse_name",
        _rounded("avg_stock_level", 0, "avg_stock"),
        _rounded("avg_stock_out_risk", 2, "stockout_risk_percent", 100),
        "product_velocity_classification",
        "stock_health_status",
        _rounded("total_demand", 0, "total_demand"),
        _rounded("total_revenue", 2, "total_revenue"),
    )


def supplier_spend(finance: DataFrame, year: int, month: int, rows: int = 10) -> DataFrame:
    """Ranked by the spend as shown, that is, rounded."""
    shown = _period(finance, year, month).withColumn(
        "total_spend", F.round("total_purchase_value", 2)
    )
    return _top(
        shown,
        "total_spend",
        FINANCE_KEYS,
        rows,
        "supplier_name",
        "category_name",
        "supplier_spend_tier",
        "total_spend",
        _rounded("total_shipping_cost", 2, "shipping_cost"),
        _rounded("total_supply_chain_cost", 2, "total_cost"),
        _rounded("cost_efficiency_ratio", 2, "cost_efficiency"),
        _rounded("avg_payment_cycle_days", 1, "avg_payment_days"),
    )


def scorecard_graded(
    scorecard: DataFrame, rows: int = 10, bands: Mapping[str, Bands] = BANDS
) -> DataFrame:
    return _top(
        scorecard,
        "overall_supplier_score",
        ("supplier_key", "supplier_name"),
        rows,
        "supplier_name",
        _rounded("delivery_score", 2, "delivery_score", 100),
        _rounded("quality_score", 2, "quality_score", 20),
        _rounded("availability_score", 2, "availability_score", 100),
        _rounded("overall_supplier_score", 2, "overall_score"),
        supplier_grade(bands),
    )


def high_risk(fact: DataFrame, rows: int = 20, above: float = HIGH_RISK) -> DataFrame:
    def percent(column: str, name: str) -> Column:
        return F.round(F.col(column) * 100, 2).cast("double").alias(name)

    return _high_risk(
        fact,
        rows,
        above,
        percent("stock_out_risk_score", "stockout_risk_percent"),
        percent("supply_chain_risk_score", "overall_risk_percent"),
    )
