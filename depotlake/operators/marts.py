"""The three team marts. Each is one hash aggregate of the clean fact, combined map-side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.functions import BANDS, Bands, late_share, mean, ratio
from depotlake.schemas import to_table

PERIOD = ("order_year", "order_month")


def with_cost_efficiency(df: DataFrame) -> DataFrame:
    """Purchase value per unit of landed cost; the added 1 keeps it finite."""
    return df.withColumn(
        "cost_efficiency_ratio",
        ratio(F.col("total_purchase_value"), F.col("total_supply_chain_cost") + 1),
    )


def supply_chain_team_mart(fact: DataFrame, bands: Mapping[str, Bands] = BANDS) -> DataFrame:
    performance = F.col("delivery_performance_score")
    grouped = fact.groupBy("supplier_key", "supplier_name", "warehouse_region", *PERIOD).agg(
        mean("delivery_time_days").alias("avg_delivery_time"),
        late_share("is_late_delivery").alias("late_shipment_rate"),
        mean(performance).alias("avg_delivery_performance"),
        mean("quality_rating").alias("avg_quality_rating"),
        # The cost belongs to the order, so an order of several lines counts it several times.
        F.sum("shipping_cost").alias("total_shipping_cost"),
        mean("supply_chain_risk_score").alias("avg_supply_chain_risk"),
        F.sum(performance).alias("__sum"),
        F.count(performance).alias("__count"),
    )
    label = bands["performance"].label(F.col("__sum"), F.col("__count"))
    return to_table(grouped.withColumn("performance_category", label), "supply_chain_team_metrics")


def store_manager_mart(fact: DataFrame, bands: Mapping[str, Bands] = BANDS) -> DataFrame:
    risk = F.col("stock_out_risk_score")
    grouped = fact.groupBy(
        "product_key", "product_name", "category_name", "warehouse_key", "warehouse_name", *PERIOD
    ).agg(
        mean("current_stock_level").alias("avg_stock_level"),
        mean(risk).alias("avg_stock_out_risk"),
        F.sum("order_quantity").alias("total_demand"),
        mean("days_of_supply").alias("avg_days_of_supply"),
        F.sum("order_value").alias("total_revenue"),
        F.sum(risk).alias("__sum"),
        F.count(risk).alias("__count"),
    )
    labelled = grouped.withColumns(
        {
            "stock_health_status": bands["stock_health"].label(F.col("__sum"), F.col("__count")),
            "product_velocity_classification": bands["velocity"].label(F.col("total_demand")),
        }
    )
    return to_table(labelled, "store_manager_metrics")


def finance_team_mart(fact: DataFrame, bands: Mapping[str, Bands] = BANDS) -> DataFrame:
    grouped = fact.groupBy("supplier_key", "supplier_name", "category_name", *PERIOD).agg(
        F.sum("order_value").alias("total_purchase_value"),
        mean("unit_price").alias("avg_unit_price"),
        F.sum("shipping_cost").alias("total_shipping_cost"),
        F.sum("total_supply_chain_cost").alias("total_supply_chain_cost"),
        # Named for payment, but it is the delivery time.
        mean("delivery_time_days").alias("avg_payment_cycle_days"),
        F.sum("order_quantity").alias("total_units_purchased"),
    )
    tier = bands["spend"].label(F.col("total_purchase_value"))
    labelled = grouped.withColumn("supplier_spend_tier", tier).transform(with_cost_efficiency)
    return to_table(labelled, "finance_team_metrics")
