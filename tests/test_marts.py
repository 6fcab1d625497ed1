from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from retail import ROWS, sources

from depotlake.functions import BANDS
from depotlake.operators import kpis, marts
from depotlake.plans import views
from depotlake.plans.warehouse import plain_fact
from depotlake.schemas import TABLES, columns


@pytest.mark.parametrize(
    "rule, value, label",
    [
        ("performance", "0.90", "EXCELLENT"),
        ("performance", "0.89", "GOOD"),
        ("performance", "0.80", "GOOD"),
        ("performance", "0.70", "FAIR"),
        ("performance", "0.69", "POOR"),
        ("performance", None, "POOR"),
        ("stock_health", "0.30", "HEALTHY"),
        ("stock_health", "0.60", "MODERATE_RISK"),
        ("stock_health", "0.61", "HIGH_RISK"),
        ("stock_health", None, "HIGH_RISK"),
        ("velocity", "100", "FAST_MOVING"),
        ("velocity", "99", "MEDIUM_MOVING"),
        ("velocity", "50", "MEDIUM_MOVING"),
        ("velocity", "49", "SLOW_MOVING"),
        ("spend", "50000", "TIER_1_HIGH_SPEND"),
        ("spend", "20000", "TIER_2_MEDIUM_SPEND"),
        ("spend", "19999.99", "TIER_3_LOW_SPEND"),
        ("grade", "80", "EXCELLENT"),
        ("grade", "70", "GOOD"),
        ("grade", "60", "FAIR"),
        ("grade", "59.9", "NEEDS_IMPROVEMENT"),
    ],
)
def test_band_edges(spark, rule, value, label):
    amount = F.lit(value).cast("decimal(12,2)")
    row = spark.range(1).select(
        BANDS[rule].label(amount).alias("plain"),
        BANDS[rule].label(amount * 7, F.lit(7)).alias("mean"),
    )
    assert tuple(row.first()) == (label, label)


def test_marts_add_up_to_the_fact(spark):
    fact = plain_fact(sources(spark)).cache()
    total = float(fact.agg(F.sum("order_value")).first()[0])
    cost = float(fact.agg(F.sum("shipping_cost")).first()[0])
    store = marts.store_manager_mart(fact)
    assert store.agg(F.sum("total_revenue")).first()[0] == total
    assert marts.finance_team_mart(fact).agg(F.sum("total_purchase_value")).first()[0] == total
    assert marts.supply_chain_team_mart(fact).agg(F.sum("total_shipping_cost")).first()[0] == cost
    assert store.filter("warehouse_key IS NULL").count() == 1


@pytest.mark.parametrize(
    "table, mart",
    [
        ("supply_chain_team_metrics", marts.supply_chain_team_mart),
        ("store_manager_metrics", marts.store_manager_mart),
        ("finance_team_metrics", marts.finance_team_mart),
        ("supplier_scorecard", kpis.supplier_scorecard),
    ],
)
def test_contracts(spark, table, mart):
    assert mart(plain_fact(sources(spark))).dtypes == columns(TABLES[table])


def test_turnover_of_unstocked_category_is_null(spark):
    bare = [(*r[:3], 0, *r[4:]) for r in ROWS["inventory"]]
    row = kpis.inventory_turnover(plain_fact(sources(spark, inventory=bare))).first()
    assert row.inventory_turnover_ratio is None


def test_empty_fact(spark):
    empty = plain_fact(sources(spark, order_items=[]))
    assert kpis.perfect_order_rate(empty).first().perfect_order_rate is None
    assert kpis.run_summary(empty).first().total_records == 0
    assert views.monthly_trend(empty).count() == 0


def test_perfect_lines_are_counted_per_order(spark):
    """Two perfect lines of one order make a rate above 1."""
    perfect = [(2, 12, 8, 5, *ROWS["shipments"][1][4:10], Decimal("4.0"), Decimal("1.00"))]
    items = [(12, 100, 1, Decimal("1.00"), n) for n in (1, 2)]
    row = kpis.perfect_order_rate(plain_fact(sources(spark, shipments=perfect, order_items=items)))
    assert row.first().perfect_order_rate == 2.0


def test_scorecard_averages_what_is_there(spark):
    """A line without scores does not count as a line of score 0."""
    from depotlake.operators.kpis import supplier_scorecard

    rows = [(7, "S", 1.0, 5.0, "HEALTHY"), (7, "S", None, None, "HEALTHY")]
    fact = spark.createDataFrame(
        rows,
        "supplier_key bigint, supplier_name string, delivery_performance_score double,"
        " quality_rating double, stock_status string",
    )
    assert tuple(supplier_scorecard(fact).first())[2:] == (1.0, 5.0, 1.0, 100.0)


def test_bands_of_the_caller(spark):
    from decimal import Decimal

    from depotlake.functions import BANDS, Bands
    from depotlake.operators.marts import finance_team_mart
    from depotlake.plans.warehouse import plain_fact

    mine = {**BANDS, "spend": Bands((("ANY", Decimal("0")),), "NONE")}
    mart = finance_team_mart(plain_fact(sources(spark)), mine)
    assert {r.supplier_spend_tier for r in mart.collect()} == {"ANY"}
